"""Per-paper features.

Every output is keyed by ``paper_id``.  X9 merges tagged rows: the rows of all
features are unioned and grouped by paper once.  X10 is a chain of inner joins; its
per-paper aggregates arrive hash-partitioned by ``paper_id``, so the planner adds no
shuffle for them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmetrics.functions.expressions import position_credit, venue_key
from scholarmetrics.functions.predicates import cited_only, non_blank, positive_weights
from scholarmetrics.operators.links import lookup_default
from scholarmetrics.operators.skew import skew_join

KINDS = ("author", "affiliation", "venue", "field")
FEATURE_COLUMNS = tuple(f"{k}_weight" for k in KINDS)
#: Columns of X9, in its order.
MERGED_COLUMNS = ("paper_id", "field_weight", "venue_weight", "affiliation_weight", "author_weight", "nb_citations")


def _weights(w: DataFrame, key: str, out_key: str | None = None) -> DataFrame:
    return positive_weights(w).select(
        F.col(key).alias(out_key or key), F.col("weight").cast("double").alias("_w")
    )


def _mean_per_paper(
    links: DataFrame, weights: DataFrame, key: str, out: str, detect_on: DataFrame | None = None
) -> DataFrame:
    """Mean of the entity weight over a paper's link rows; a link whose entity
    has no positive weight counts as 0.0 in the mean."""
    j = skew_join(links, weights, key, "left", detect_on=detect_on)
    return j.groupBy("paper_id").agg(F.avg(F.coalesce(F.col("_w"), F.lit(0.0))).alias(out))


def paper_venue_feature(
    papers: DataFrame, vw: DataFrame, venue_col: str = "venue_key", detect_on: DataFrame | None = None
) -> DataFrame:
    """One row per paper, the weight of its lower-cased venue (0.0 when the
    venue has no positive weight)."""
    p = papers.select("paper_id", venue_key(venue_col, True).alias("venue"))
    return lookup_default(
        p, _weights(vw, "venue"), "venue", "_w", 0.0, detect_on=papers if detect_on is None else detect_on,
        detect_key=venue_col,
    ).select(
        "paper_id", F.col("_w").alias("venue_weight")
    )


def paper_author_feature(paa: DataFrame, aw: DataFrame, detect_on: DataFrame | None = None) -> DataFrame:
    """Per paper, mean author weight over its non-blank author links.
    ``detect_on``: the table ``paa`` was taken from, for hot-key detection."""
    links = non_blank(paa, "author_id").select("paper_id", "author_id")
    return _mean_per_paper(links, _weights(aw, "author_id"), "author_id", "author_weight", detect_on)


def paper_affiliation_feature(paa: DataFrame, fw: DataFrame, detect_on: DataFrame | None = None) -> DataFrame:
    """Per paper, mean affiliation weight over its non-blank affiliation links."""
    links = non_blank(paa, "affiliation_id").select("paper_id", "affiliation_id")
    return _mean_per_paper(
        links, _weights(fw, "affiliation_id"), "affiliation_id", "affiliation_weight", detect_on
    )


def paper_field_feature(kw: DataFrame, sw: DataFrame, detect_on: DataFrame | None = None) -> DataFrame:
    """Per paper, mean field weight over its keyword rows."""
    links = kw.select("paper_id", "fos_id")
    return _mean_per_paper(links, _weights(sw, "fos_id"), "fos_id", "field_weight", detect_on)


def merge_tagged(base: DataFrame, rows: dict[str, DataFrame]) -> DataFrame:
    """One-shuffle merge: ``base`` (``paper_id``, ``nb_citations``) with, per entry of
    ``rows``, the mean of the column of that name over its rows of the paper.

    All rows are unioned under one schema, each with a value in its own column only,
    and grouped by paper once: partial sums leave the map side, so a paper with many
    rows ships one row per task.  A paper without rows of an entry keeps NULL there;
    rows of papers that ``base`` lacks are dropped.  ``base`` holds a paper once."""
    names = list(rows)

    def tagged(df: DataFrame, own: str) -> DataFrame:
        null = F.lit(None).cast("double")
        cols = [(F.col(c).cast("double") if c == own else null).alias(c) for c in ["nb_citations", *names]]
        return df.select("paper_id", *cols)

    union = reduce(DataFrame.unionByName, [tagged(base, "nb_citations"), *[tagged(df, c) for c, df in rows.items()]])
    return _per_paper(union, {c: F.col(c) for c in names})


def _per_paper(union: DataFrame, values: dict[str, Column]) -> DataFrame:
    means = [F.avg(v).alias(c) for c, v in values.items()]
    merged = union.groupBy("paper_id").agg(F.max("nb_citations").alias("nb_citations"), *means)
    return merged.filter(F.col("nb_citations").isNotNull())


def merge_features(
    pc: DataFrame,
    author: DataFrame,
    affiliation: DataFrame,
    venue: DataFrame,
    field: DataFrame,
) -> DataFrame:
    """Cited papers of ``pc`` left-joined with the four features.

    Output ``(paper_id, field_weight, venue_weight, affiliation_weight,
    author_weight, nb_citations)``; a paper without link rows keeps NULL.  One
    shuffle (``merge_tagged``) in place of a join per feature.
    """
    base = cited_only(pc).select("paper_id", "nb_citations")
    return merge_tagged(base, dict(zip(FEATURE_COLUMNS, (author, affiliation, venue, field)))).select(*MERGED_COLUMNS)


def cited_links(
    pc: DataFrame, paa: DataFrame, kw: DataFrame, credit: str = "position", venue_col: str = "venue_key"
) -> DataFrame:
    """Every link of the cited papers of ``pc`` as ``(paper_id, kind, entity, credit,
    nb_citations)``: authors (credit ``nb / seq`` or ``nb``), affiliations, keywords'
    fields and the paper's lower-cased venue (credit ``nb``).

    The link table is joined once for authors and affiliations together, the keyword
    table once.  ``nb_citations`` is set in the venue row alone, of which each cited
    paper has one, so the rows also hold the base of the merge."""
    cited = cited_only(pc).select("paper_id", F.col("nb_citations").cast("double").alias("_nb"))
    nothing = F.lit(None).cast("double")
    out = ["paper_id", "kind", "entity", "credit", "nb_citations"]

    links = skew_join(paa.select("paper_id", "author_id", "affiliation_id", "author_seq"), cited, "paper_id", "inner", detect_on=paa)
    share = F.col("_nb") * position_credit("author_seq") if credit == "position" else F.col("_nb")
    pair = F.explode(
        F.array(
            F.struct(F.lit("author").alias("kind"), F.col("author_id").alias("entity"), share.alias("credit")),
            F.struct(F.lit("affiliation").alias("kind"), F.col("affiliation_id").alias("entity"), F.col("_nb").alias("credit")),
        )
    )
    people = non_blank(links.select("paper_id", pair.alias("x")).select("paper_id", "x.*"), "entity")
    fields = skew_join(kw.select("paper_id", "fos_id"), cited, "paper_id", "inner", detect_on=kw)
    venues = cited_only(pc).select("paper_id", venue_key(venue_col, True).alias("entity"), F.col("nb_citations").cast("double").alias("credit"))
    return (
        people.withColumn("nb_citations", nothing).select(*out)
        .unionByName(fields.select("paper_id", F.lit("field").alias("kind"), F.col("fos_id").alias("entity"), F.col("_nb").alias("credit"), nothing.alias("nb_citations")))
        .unionByName(venues.select("paper_id", F.lit("venue").alias("kind"), "entity", "credit", F.col("credit").alias("nb_citations")))
    )


def merge_links(links: DataFrame, hot: dict[str, dict[str, float]]) -> DataFrame:
    """X9 from ``cited_links``: all entities' weights in one aggregate, one lookup of
    every link's weight, one group by paper.

    A weight is the sum of the credits of an entity's links; links whose entity has no
    positive weight count 0.0 (as a blank venue does).  ``hot`` has, per kind, the hot
    entities with their share of the rows: their links are salted in the lookup."""
    named = links.withColumn("key", F.concat_ws(":", "kind", "entity"))
    counted = named.filter(F.col("entity").isNotNull() & ((F.col("kind") != "venue") | (F.col("entity") != "")))
    weights = positive_weights(counted.groupBy("key").agg(F.sum("credit").alias("weight"))).select("key", F.col("weight").alias("_w"))
    keys = {f"{kind}:{k}": share for kind, shares in hot.items() for k, share in shares.items()}
    found = skew_join(named.drop("credit", "entity"), weights, "key", "left", hot=keys)
    value = F.coalesce(F.col("_w"), F.lit(0.0))
    return _per_paper(found, {f"{k}_weight": F.when(F.col("kind") == k, value) for k in KINDS}).select(*MERGED_COLUMNS)


# --- sums of entity weights per paper, with a label (gap-limited variant) ---


def _label(labels: DataFrame, count_col: str = "nb_citations") -> DataFrame:
    return labels.select("paper_id", F.col(count_col).cast("double").alias("nb_citations"))


def paper_author_sum(paa: DataFrame, aw: DataFrame, labels: DataFrame) -> DataFrame:
    """Per paper, Σ weights of its non-blank authors (inner to the weights),
    inner-joined to the labels: ``(paper_id, nb_citations, author_weight)``."""
    links = non_blank(paa, "author_id").select("author_id", "paper_id")
    w = aw.select("author_id", F.col("weight").cast("double").alias("_w"))
    s = skew_join(links, w, "author_id", "inner", detect_on=paa).groupBy("paper_id").agg(F.sum("_w").alias("author_weight"))
    return _label(labels).join(s, "paper_id", "inner")


def paper_affiliation_sum(paa: DataFrame, fw: DataFrame, labels: DataFrame) -> DataFrame:
    """Σ affiliation weights per paper (inner to the weights), then every
    labelled paper with that sum or 0.0."""
    links = non_blank(paa, "affiliation_id").select("affiliation_id", "paper_id")
    w = fw.select("affiliation_id", F.col("weight").cast("double").alias("_w"))
    s = skew_join(links, w, "affiliation_id", "inner", detect_on=paa).groupBy("paper_id").agg(F.sum("_w").alias("_s"))
    return lookup_default(_label(labels), s, "paper_id", "_s", 0.0, out="affiliation_weight", skew=False)


def paper_field_sum(kw: DataFrame, sw: DataFrame, labels: DataFrame) -> DataFrame:
    """Σ field weights per paper over its keyword rows (a field without a
    weight adds 0), then every labelled paper with that sum or 0.0."""
    links = kw.select("fos_id", "paper_id")
    w = sw.select("fos_id", F.col("weight").cast("double").alias("_w"))
    s = (
        lookup_default(links, w, "fos_id", "_w", 0.0, detect_on=kw)
        .groupBy("paper_id")
        .agg(F.sum("_w").alias("_s"))
    )
    return lookup_default(_label(labels), s, "paper_id", "_s", 0.0, out="field_weight", skew=False)


def paper_venue_sum(papers: DataFrame, vw: DataFrame, labels: DataFrame, venue_col: str = "venue_key") -> DataFrame:
    """The raw venue's weight per paper (inner), inner-joined to the labels."""
    p = papers.select(F.col(venue_col).alias("venue"), "paper_id")
    w = vw.select("venue", F.col("weight").cast("double").alias("_w"))
    s = skew_join(p, w, "venue", "inner", detect_on=papers, detect_key=venue_col).groupBy("paper_id").agg(F.sum("_w").alias("venue_weight"))
    return _label(labels).join(s, "paper_id", "inner")


def all_weights(author: DataFrame, affiliation: DataFrame, field: DataFrame, venue: DataFrame) -> DataFrame:
    """Inner join of the four per-paper sums; the label comes from the
    author table.  ``(paper_id, nb_citations, author_weight, affiliation_weight,
    field_weight, venue_weight)``."""
    return (
        author.select("paper_id", "nb_citations", "author_weight")
        .join(affiliation.select("paper_id", "affiliation_weight"), "paper_id", "inner")
        .join(field.select("paper_id", "field_weight"), "paper_id", "inner")
        .join(venue.select("paper_id", "venue_weight"), "paper_id", "inner")
    )


def author_feature_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two author-feature variants side by side (inner join):
    ``(paper_id, nb_citations, author_weight_a, author_weight_b)``."""
    return a.select(
        "paper_id", "nb_citations", F.col("author_weight").alias("author_weight_a")
    ).join(b.select("paper_id", F.col("author_weight").alias("author_weight_b")), "paper_id", "inner")
