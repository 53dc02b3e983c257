"""Logical tables of the bibliographic data model.

Ids are strings (never parsed as numbers), the year and the author position are
integers.  The raw dump is positional; the column names below are ours.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Full-width schemas of the tab-separated dump (position = field index).
PAPERS = _struct(
    ("paper_id", S), ("c1", S), ("c2", S), ("year", I), ("c4", S), ("c5", S),
    ("c6", S), ("venue_key", S), ("c8", S), ("c9", S), ("c10", S),
)
PAPER_REFERENCES = _struct(("citing_id", S), ("cited_id", S))
PAPER_AUTHORS = _struct(
    ("paper_id", S), ("author_id", S), ("affiliation_id", S), ("c3", S), ("c4", S),
    ("author_seq", I),
)
PAPER_KEYWORDS = _struct(("paper_id", S), ("keyword", S), ("fos_id", S))
FIELDS_OF_STUDY = _struct(("fos_id", S), ("fos_name", S))
AUTHORS = _struct(("author_id", S), ("author_name", S))

SCHEMAS: dict[str, T.StructType] = {
    "papers": PAPERS,
    "paper_references": PAPER_REFERENCES,
    "paper_authors": PAPER_AUTHORS,
    "paper_keywords": PAPER_KEYWORDS,
    "fields_of_study": FIELDS_OF_STUDY,
    "authors": AUTHORS,
}


@dataclass(frozen=True)
class Tables:
    """The six input tables.  Operators only need the columns they name, so a
    narrower table (e.g. papers without c1..c10) works as well."""

    papers: DataFrame
    paper_references: DataFrame
    paper_authors: DataFrame
    paper_keywords: DataFrame
    fields_of_study: DataFrame
    authors: DataFrame
