"""The six tables of a bibliographic dump directory, read with S1.

Each table is one file or a directory of part files, plain, gzip or bz2
(``Papers.tsv``, ``Papers.tsv.bz2``, ``Papers.tsv.gz/part-*``).  A folder that
holds a table twice, say plain and compressed, is an error, since reading both
would count every row twice: the caller names the one to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from scholarmetrics.schemas import SCHEMAS, Tables
from scholarmetrics.sources.tsv import observe_rejects, parse_lines, parse_tagged, rejects_of, rows_of

# File names of the dump, by logical table.
DUMP_FILES = {
    "papers": "Papers.tsv",
    "paper_references": "PaperReferences.tsv",
    "paper_authors": "PaperAuthorAffiliations.tsv",
    "paper_keywords": "PaperKeywords.tsv",
    "fields_of_study": "FieldsOfStudy.tsv",
    "authors": "Authors.tsv",
}

#: Endings of the inputs that Spark's text reader decompresses by itself.
SUFFIXES = ("", ".gz", ".bz2")


def dump_path(spark: SparkSession, data_dir: str, table: str, name: str | None = None) -> str:
    """The one input of ``table``: ``name`` in ``data_dir``, or the only file or
    folder with the table's fixed name.  The names are listed by the folder's own
    Hadoop file system."""
    base = data_dir.rstrip("/")
    if name is not None:
        return f"{base}/{name}"
    known = [DUMP_FILES[table] + s for s in SUFFIXES]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{DUMP_FILES[table]}*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    there = sorted({s.getPath().getName() for s in found} & set(known))
    if len(there) != 1:
        what = "no input" if not there else f"several inputs ({', '.join(there)})"
        raise ValueError(f"{what} for table {table} in {base}; name one of {known}")
    return f"{base}/{there[0]}"


def load_dump(
    spark: SparkSession, data_dir: str, mode: str = "failfast", files: dict[str, str] | None = None
) -> Tables:
    """All six tables of ``data_dir`` as typed DataFrames (full width).  ``files``
    names the input of a table that the folder holds more than once."""
    paths = {n: dump_path(spark, data_dir, n, (files or {}).get(n)) for n in DUMP_FILES}
    return Tables(**{n: parse_lines(spark.read.text(p), SCHEMAS[n], mode) for n, p in paths.items()})


def load_dump_with_rejects(
    spark: SparkSession, data_dir: str, files: dict[str, str] | None = None
) -> tuple[Tables, dict[str, DataFrame]]:
    """The tables (permissive), and per table its short lines and lines with unparsable
    values."""
    tagged = load_dump_tagged(spark, data_dir, files)
    return Tables(**{n: rows_of(df) for n, df in tagged.items()}), {n: rejects_of(df) for n, df in tagged.items()}


def load_dump_tagged(spark: SparkSession, data_dir: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Per table, every line with its ``reject`` (``sources.tsv.parse_tagged``)."""
    paths = {n: dump_path(spark, data_dir, n, (files or {}).get(n)) for n in DUMP_FILES}
    return {n: parse_tagged(spark.read.text(p), SCHEMAS[n]) for n, p in paths.items()}


def load_dump_observed(
    spark: SparkSession, data_dir: str, files: dict[str, str] | None = None
) -> tuple[Tables, dict[str, Observation]]:
    """The tables (permissive) and per table the counts of its rejects, collected by the
    first job that reads the table."""
    seen = {n: observe_rejects(df, f"rejects_{n}") for n, df in load_dump_tagged(spark, data_dir, files).items()}
    return Tables(**{n: rows for n, (rows, _) in seen.items()}), {n: o for n, (_, o) in seen.items()}
