"""Row filters (F1-F9, F13, F14).  Plain ``filter``s: Catalyst pushes them to
the Parquet scan (``PushedFilters``) or below joins where the columns allow."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The author positions counted as leading authors.
LEADING_POSITIONS = (1, 2)


def papers_of_year(papers: DataFrame, year: int) -> DataFrame:
    """papers published in ``year``."""
    return papers.filter(F.col("year") == F.lit(year))


def papers_newer_than(papers: DataFrame, year: int) -> DataFrame:
    """papers published strictly after ``year``."""
    return papers.filter(F.col("year") > F.lit(year))


def non_blank(df: DataFrame, column: str) -> DataFrame:
    """drop rows whose key is the empty string (the dump's missing value)."""
    return df.filter(F.col(column) != F.lit(""))


def leading_authors(paa: DataFrame, positions: Iterable[int] = LEADING_POSITIONS) -> DataFrame:
    """link rows with a non-blank author in one of ``positions``."""
    return paa.filter(
        (F.col("author_id") != F.lit("")) & F.col("author_seq").isin(*list(positions))
    )


def fields_named(fos: DataFrame, phrase: str) -> DataFrame:
    """fields whose name contains ``phrase`` (case-sensitive substring)."""
    return fos.filter(F.col("fos_name").contains(phrase))


def keywords_in_field(kw: DataFrame, fos_id: str) -> DataFrame:
    """keyword rows of one field id."""
    return kw.filter(F.col("fos_id") == F.lit(fos_id))


def cited_only(pc: DataFrame, count_col: str = "nb_citations") -> DataFrame:
    """papers with at least one citation."""
    return pc.filter(F.col(count_col) > F.lit(0))


def positive_weights(weights: DataFrame, weight_col: str = "weight") -> DataFrame:
    """F8: weights above zero (applied before a lookup)."""
    return weights.filter(F.col(weight_col) > F.lit(0))


def min_count(counts: DataFrame, threshold: int, count_col: str) -> DataFrame:
    """rows whose count is strictly above ``threshold`` (a HAVING)."""
    return counts.filter(F.col(count_col) > F.lit(threshold))


def year_gap(edges_with_years: DataFrame, gap: int) -> DataFrame:
    """edges whose citing paper appeared exactly ``gap`` years after the
    cited one (equality, not "within")."""
    return edges_with_years.filter(
        (F.col("citing_year") - F.col("cited_year")) == F.lit(gap)
    )


def below_cap(pc: DataFrame, cap: int, count_col: str = "nb_citations") -> DataFrame:
    """papers with fewer than ``cap`` citations."""
    return pc.filter(F.col(count_col) < F.lit(cap))
