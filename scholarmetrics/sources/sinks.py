"""Write results as tab-separated text.

``write_tsv`` writes ``key<TAB>v1<TAB>v2...`` lines, gzip-compressed by default,
and refuses an existing path (``errorifexists``), which is how the Hadoop text
sink behaved.  ``write_text_dump`` is the same without compression (S4: a plain
dump of counts; we write TSV lines, not Python tuple reprs).

``concat_ws`` silently drops NULLs, which would shift later fields one position
to the left, so every value is coalesced to ``null_value`` first.  Both writes
are distributed: each task writes its own part file; nothing goes through the
driver and nothing is coalesced to one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv_line(df: DataFrame, columns: list[str] | None = None, null_value: str = "") -> Column:
    cols = columns or df.columns
    return F.concat_ws(
        "\t", *[F.coalesce(F.col(c).cast("string"), F.lit(null_value)) for c in cols]
    ).alias("value")


def write_tsv(
    df: DataFrame,
    path: str,
    compression: str | None = "gzip",
    columns: list[str] | None = None,
    null_value: str = "",
    mode: str = "errorifexists",
) -> None:
    w = df.select(tsv_line(df, columns, null_value)).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_text_dump(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    write_tsv(df, path, compression=None, columns=columns)
