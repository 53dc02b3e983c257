"""Citation credit per entity.

Input ``pc`` is a papers-with-counts table ``(paper_id, ..., nb_citations)``.
Link rows are counted as they come: an entity linked twice to a paper is
credited twice (no distinct).

Sum weights (W1-W7) keep every entity of the link table: a link whose paper is
not a cited paper of ``pc`` contributes 0, so entities without citations stay
with weight 0.  Mean weights (W8-W11) join the links to the counts with an
inner join and average.  Where both W8 and W9 are needed they come from one such
join, exploded per kind (``link_mean_weights``), so the link table is shuffled once.

Plan shape of the sum weights: the link rows of *cited* papers are
inner-joined to the per-paper counts.  Entities are kept whole by a union with
a zero-valued projection of all link rows, and one partial + final aggregate
per entity follows.  Only the links of cited papers take part in a join, so
the link table is never shuffled whole by ``paper_id``.  The inner join is
eligible for Spark's runtime bloom filter when the counts cover a small
subset, such as one year.  A paper holding a large share of the link rows is
salted by ``skew_join``; the aggregate absorbs a hot entity.  ``detect_on`` is
always the whole link table, whose hot keys are found once per session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmetrics.functions.expressions import position_credit, venue_key
from scholarmetrics.functions.predicates import cited_only, non_blank
from scholarmetrics.operators.skew import skew_join

CREDITS = ("full", "position")


def _cited(pc: DataFrame, count_col: str = "nb_citations") -> DataFrame:
    return cited_only(pc, count_col).select("paper_id", F.col(count_col).alias("_nb"))


def _credited_sum(
    links: DataFrame, entity: str, pc: DataFrame, value, zero, keep_zero: bool, table: DataFrame
) -> DataFrame:
    """Σ ``value`` per ``entity`` over the links of cited papers of ``pc``;
    entities whose links all miss get the sum of ``zero`` (0).

    ``keep_zero=False`` leaves those entities out.  Use it when the caller
    keeps only positive weights anyway (F8): the table of all links is then
    never read whole."""
    hit = skew_join(links, _cited(pc), "paper_id", "inner", detect_on=table).select(entity, value.alias("_v"))
    if keep_zero:
        hit = hit.unionByName(links.select(entity, zero.alias("_v")))
    return hit.groupBy(entity).agg(F.sum("_v").alias("weight"))


def author_weights(
    pc: DataFrame, paa: DataFrame, credit: str = "position", keep_zero: bool = True
) -> DataFrame:
    """W1 (``credit="full"``): ``Σ nb_citations`` per author, bigint.
    W2 (``credit="position"``): ``Σ nb_citations / author_seq`` per author, double.

    Over every link row with a non-blank author; ``keep_zero=False`` returns
    only authors with a cited link (see ``_credited_sum``).
    """
    if credit not in CREDITS:
        raise ValueError(f"credit must be one of {CREDITS}, got {credit!r}")
    links = non_blank(paa, "author_id").select("paper_id", "author_id", "author_seq")
    if credit == "full":
        return _credited_sum(
            links, "author_id", pc, F.col("_nb").cast("bigint"), F.lit(0).cast("bigint"), keep_zero, paa
        )
    # the zero branch also takes 1/seq, so a position 0 fails on every link
    # row, as the original's credit did (and a NULL position stays NULL)
    credit_col = position_credit("author_seq")
    return _credited_sum(
        links, "author_id", pc, F.col("_nb").cast("double") * credit_col,
        F.when(credit_col.isNotNull(), F.lit(0.0)), keep_zero, paa,
    )


def affiliation_weights(
    pc: DataFrame, paa: DataFrame, require: str = "affiliation", keep_zero: bool = True
) -> DataFrame:
    """W3 (``require="affiliation"``): ``Σ nb_citations`` per affiliation over
    links with a non-blank affiliation.
    W4 (``require="author"``): the same over links with a non-blank *author*, so
    links without an affiliation form a ``''`` group."""
    if require not in ("affiliation", "author"):
        raise ValueError("require must be 'affiliation' or 'author'")
    links = non_blank(paa, f"{require}_id").select("paper_id", "affiliation_id")
    return _credited_sum(
        links, "affiliation_id", pc, F.col("_nb").cast("bigint"), F.lit(0).cast("bigint"), keep_zero, paa
    )


def venue_weights(
    pc: DataFrame, lower: bool = True, drop_blank: bool = True, venue_col: str = "venue_key"
) -> DataFrame:
    """W5 (defaults): ``Σ nb_citations`` of cited papers per lower-cased,
    non-blank venue.  W6 (``lower=False, drop_blank=False``): case-sensitive,
    ``''`` kept.  Venues whose papers are all uncited are absent."""
    v = cited_only(pc).select(venue_key(venue_col, lower).alias("venue"), "nb_citations")
    if drop_blank:
        v = non_blank(v, "venue")
    return v.groupBy("venue").agg(F.sum("nb_citations").cast("bigint").alias("weight"))


def field_weights(pc: DataFrame, kw: DataFrame, keep_zero: bool = True) -> DataFrame:
    """``Σ nb_citations`` per field over all keyword rows (misses 0, so
    fields without citations stay with 0)."""
    links = kw.select("paper_id", "fos_id")
    return _credited_sum(links, "fos_id", pc, F.col("_nb").cast("bigint"), F.lit(0).cast("bigint"), keep_zero, kw)


# --- mean weights over a (gap-limited) count table c3(paper_id, nb_citations) ---


def _counts(c3: DataFrame, count_col: str = "nb_citations") -> DataFrame:
    return c3.select("paper_id", F.col(count_col).cast("double").alias("_nb"))


def link_mean_weights(c3: DataFrame, paa: DataFrame) -> DataFrame:
    """W8 and W9 together: ``(kind, entity, weight)`` with ``kind`` either
    ``author`` or ``affiliation``.  The weight is the mean of
    ``nb / author_seq`` over the entity's non-blank links, inner-joined to
    the counts.

    The link table is joined to the counts once.  Each joined row is then
    exploded into one row per kind, so the blank filters and the per-kind
    selections sit above the generator and are not pushed into the scan.
    W8 and W9 taken from this frame share the join and its shuffle of the
    link table (``ReusedExchange``)."""
    links = paa.select("paper_id", "author_id", "affiliation_id", "author_seq")
    j = skew_join(links, _counts(c3), "paper_id", "inner", detect_on=paa)
    v = position_credit("author_seq") * F.col("_nb")
    pairs = F.explode(
        F.array(
            F.struct(F.lit("author").alias("kind"), F.col("author_id").alias("entity"), v.alias("v")),
            F.struct(F.lit("affiliation").alias("kind"), F.col("affiliation_id").alias("entity"), v.alias("v")),
        )
    )
    e = j.select(pairs.alias("x")).select("x.kind", "x.entity", "x.v")
    return non_blank(e, "entity").groupBy("kind", "entity").agg(F.avg("v").alias("weight"))


def _mean_weights(c3: DataFrame, paa: DataFrame, entity: str) -> DataFrame:
    """Mean of ``nb / author_seq`` per entity over its non-blank links."""
    links = non_blank(paa, entity).select("paper_id", entity, "author_seq")
    j = skew_join(links, _counts(c3), "paper_id", "inner", detect_on=paa)
    return j.groupBy(entity).agg(F.avg(position_credit("author_seq") * F.col("_nb")).alias("weight"))


def author_mean_weights(c3: DataFrame, paa: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """Per author, mean over inner-joined links of ``nb / author_seq``.
    ``shared``: a ``link_mean_weights`` frame to take it from; alone, the blank
    filter reaches the scan and only this entity's column is shuffled."""
    if shared is None:
        return _mean_weights(c3, paa, "author_id")
    return shared.filter(F.col("kind") == "author").select(F.col("entity").alias("author_id"), "weight")


def affiliation_mean_weights(c3: DataFrame, paa: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """Per affiliation, mean of ``nb / author_seq`` over links with a
    non-blank affiliation.  ``shared`` as for ``author_mean_weights``."""
    if shared is None:
        return _mean_weights(c3, paa, "affiliation_id")
    return shared.filter(F.col("kind") == "affiliation").select(F.col("entity").alias("affiliation_id"), "weight")


def field_mean_weights(c3: DataFrame, kw: DataFrame) -> DataFrame:
    """Per field, mean of ``nb`` over keyword rows (inner join)."""
    j = skew_join(kw.select("paper_id", "fos_id"), _counts(c3), "paper_id", "inner", detect_on=kw)
    return j.groupBy("fos_id").agg(F.avg("_nb").alias("weight"))


def venue_mean_weights(c3: DataFrame, papers: DataFrame, venue_col: str = "venue_key") -> DataFrame:
    """Per raw venue (no lower-casing, ``''`` kept), mean of ``nb``."""
    j = _counts(c3).join(papers.select("paper_id", F.col(venue_col).alias("venue")), "paper_id", "inner")
    return j.groupBy("venue").agg(F.avg("_nb").alias("weight"))
