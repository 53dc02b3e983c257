"""Aggregations, statistics and top-k.

Every count is a ``groupBy().agg()``: Catalyst plans a partial aggregate before
the shuffle (map-side combine) and a final one after it, so a key holding a
third of all rows still ships one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmetrics.functions.expressions import histogram_bucket
from scholarmetrics.functions.predicates import keywords_in_field, leading_authors
from scholarmetrics.operators.links import citations_to, lookup_default


def citation_counts(edges: DataFrame) -> DataFrame:
    """A1: ``(paper_id, nb_citations)`` — edges per cited id; uncited papers are
    absent."""
    return edges.groupBy(F.col("cited_id").alias("paper_id")).agg(
        F.count(F.lit(1)).alias("nb_citations")
    )


def papers_with_counts(papers: DataFrame, edges: DataFrame, restrict_edges: bool = True) -> DataFrame:
    """A2: ``papers`` plus ``nb_citations`` (0 for uncited papers).

    With ``restrict_edges`` the edges are first semi-joined to ``papers`` (J2), so
    only citations of the subset are shuffled into the aggregate; the result is
    the same either way.  The aggregate is keyed by the cited id, which is also
    the join key, so the planner reuses its partitioning for the final join.
    """
    e = citations_to(edges, papers) if restrict_edges else edges
    # papers and counts are both unique per paper: no key can be hot
    return lookup_default(papers, citation_counts(e), "paper_id", "nb_citations", 0, skew=False)


def keyword_counts(kw: DataFrame) -> DataFrame:
    """A3: ``(keyword, nb_rows)``."""
    return kw.groupBy("keyword").agg(F.count(F.lit(1)).alias("nb_rows"))


def leading_author_counts(paa: DataFrame) -> DataFrame:
    """A4: ``(author_id, nb_links)`` over non-blank authors in position 1 or 2."""
    return leading_authors(paa).groupBy("author_id").agg(F.count(F.lit(1)).alias("nb_links"))


def papers_in_field(kw: DataFrame, fos_id: str) -> DataFrame:
    """A5: ``(paper_id, nb_keywords)`` — papers with keyword rows in one field."""
    return (
        keywords_in_field(kw, fos_id)
        .groupBy("paper_id")
        .agg(F.count(F.lit(1)).alias("nb_keywords"))
    )


def histogram_edges(lo: int, hi: int, width: int) -> list[int]:
    """Bucket edges ``range(lo, hi, width)`` (``hi`` excluded)."""
    return list(range(lo, hi, width))


def count_histogram(counts: DataFrame, value_col: str, lo: int, hi: int, width: int) -> DataFrame:
    """``(bucket, bucket_lo, bucket_hi, nb)`` for edges ``range(lo, hi, width)``.

    Buckets are ``[a, b)``, the last one closed; values outside are ignored;
    empty buckets are listed with 0.  The per-bucket counts are a normal
    partial/final aggregate; the bucket list itself has ``len(edges) - 1`` rows,
    fixed by the parameters, so joining it is cheap at any data size.
    """
    edges = histogram_edges(lo, hi, width)
    n = len(edges) - 1
    if n < 1:
        raise ValueError("a histogram needs at least two edges")
    spark = counts.sparkSession
    b = histogram_bucket(value_col, lo, width, n)
    per_bucket = (
        counts.select(b.alias("bucket"))
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("nb"))
    )
    buckets = spark.range(n).select(
        F.col("id").cast("int").alias("bucket"),
        (F.lit(lo) + F.col("id") * F.lit(width)).cast("bigint").alias("bucket_lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).cast("bigint").alias("bucket_hi"),
    )
    return lookup_default(buckets, per_bucket, "bucket", "nb", 0, skew=False)


def count_stats(counts: DataFrame, value_col: str) -> DataFrame:
    """One row ``(n, mean, stdev, max, min)``; stdev is the population one
    (what RDD ``stats()`` reports)."""
    v = F.col(value_col)
    return counts.agg(
        F.count(v).alias("n"),
        F.avg(v.cast("double")).alias("mean"),
        F.stddev_pop(v.cast("double")).alias("stdev"),
        F.max(v).alias("max"),
        F.min(v).alias("min"),
    )


def top_k(counts: DataFrame, k: int, count_col: str, key_col: str) -> DataFrame:
    """The ``k`` largest counts, descending, ties broken by key.

    ``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each task
    keeps its own top ``k`` and only those reach the final merge — no full sort.
    """
    return counts.orderBy(F.col(count_col).desc(), F.col(key_col).asc()).limit(k)


def top_authors_named(paa: DataFrame, authors: DataFrame, k: int = 10) -> DataFrame:
    """``(author_id, author_name, nb_links)`` of the ``k`` authors with the
    most leading-author links among those with a name."""
    named = leading_author_counts(paa).join(
        authors.select("author_id", "author_name"), "author_id", "inner"
    )
    return top_k(named, k, "nb_links", "author_id").select("author_id", "author_name", "nb_links")
