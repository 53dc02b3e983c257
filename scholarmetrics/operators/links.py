"""Joins (J1-J7).

The original did every lookup by collecting one side into a driver-side dict
and broadcasting it.  Here each is a declarative join and the planner picks the
strategy: a broadcast hash join when the build side is measured small at run
time (AQE converts a sort-merge join after the shuffle stage has exact sizes),
a sort-merge join otherwise.  Joins of two raw tables (J2, J3, J5, J6) are left
to AQE, whose skew rule splits a hot partition of two fresh shuffles; lookups in
an aggregate go through ``skew_join``, which salts hot keys.  No ``broadcast()``
hint is forced on a table: entity tables such as the authors (93 million in
the full dump) are not bounded.

T2: a dict lookup keeps one value per key, a join multiplies rows when the
build key repeats.  The build sides of J1 and J4 come out of a ``groupBy`` on the
join key and those of J2 and J3 are only tested for presence (semi join); J5, J6,
J7 join the papers table, whose id the dump keeps unique: a repeated paper row
would repeat its edges there, as an inner join does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmetrics.operators.skew import skew_join


def lookup_default(
    probe: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default: object = 0,
    out: str | None = None,
    lookup_key: str | None = None,
    skew: bool = True,
    detect_on: DataFrame | None = None,
    detect_key: str | None = None,
) -> DataFrame:
    """Every probe row kept; ``value`` from ``lookup`` on ``key`` or
    ``default`` when the key is missing.  ``lookup`` must be unique on its key.

    ``skew=True`` salts hot probe keys (``operators.skew``), found on the table
    ``detect_on`` the probe came from; pass ``False`` when the probe is unique on
    the key too (nothing can be hot)."""
    lk = lookup_key or key
    right = lookup.select(F.col(lk).alias(key), F.col(value).alias("__lookup_value"))
    if skew:
        j = skew_join(probe, right, key, "left", detect_on=detect_on, detect_key=detect_key)
    else:
        j = probe.join(right, key, "left")
    filled: Column = F.coalesce(F.col("__lookup_value"), F.lit(default))
    return j.withColumn(out or value, filled).drop("__lookup_value")


def citations_to(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Edges whose cited paper is in ``papers`` (left semi join)."""
    keys = papers.select(F.col("paper_id").alias("cited_id"))
    return edges.join(keys, "cited_id", "left_semi").select("citing_id", "cited_id")


def authorships_of(paa: DataFrame, papers: DataFrame) -> DataFrame:
    """Paper-author-affiliation rows whose paper is in ``papers``."""
    return paa.join(papers.select("paper_id"), "paper_id", "left_semi").select(*paa.columns)


def enrich_names(
    names: DataFrame, counts: DataFrame, count_col: str = "nb_links", default: int = -1
) -> DataFrame:
    """Every named author, with its count or ``default`` when it has none."""
    return lookup_default(
        names.select("author_id", "author_name"), counts, "author_id", count_col, default, skew=False
    ).select("author_id", "author_name", F.col(count_col).cast("bigint").alias(count_col))


def paper_citation_pairs(
    papers: DataFrame, edges: DataFrame, columns: Sequence[str] = ("year", "venue_key")
) -> DataFrame:
    """Each cited paper's row next to each paper citing it (inner join on the
    cited id).  Only ``columns`` of the papers are carried into the shuffle."""
    e = edges.select(F.col("cited_id").alias("paper_id"), "citing_id")
    j = e.join(papers.select("paper_id", *columns), "paper_id", "inner")
    return j.select("paper_id", *columns, "citing_id")


def edges_with_years(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """``(cited_id, cited_year, citing_id, citing_year)`` for edges whose both
    ends are in ``papers`` (two inner joins)."""
    citing = papers.select(F.col("paper_id").alias("citing_id"), F.col("year").alias("citing_year"))
    cited = papers.select(F.col("paper_id").alias("cited_id"), F.col("year").alias("cited_year"))
    with_citing = edges.select("citing_id", "cited_id").join(citing, "citing_id", "inner")
    return with_citing.join(cited, "cited_id", "inner").select("cited_id", "cited_year", "citing_id", "citing_year")


def counts_with_year(counts: DataFrame, papers: DataFrame, count_col: str = "nb_citations") -> DataFrame:
    """``(paper_id, count, year)``, inner join of per-paper counts with the
    publication year."""
    return counts.select("paper_id", count_col).join(
        papers.select("paper_id", "year"), "paper_id", "inner"
    )
