"""Read the tab-separated dump (plain, gzip or bz2) into typed columns.

The dump has no header and no quoting: a line is split on every tab, a ``"`` is
data, and trailing empty fields are kept.  ``spark.read.csv`` gets both wrong
(it honours quotes and turns empty fields into NULL), so lines are read with
``spark.read.text`` and split with ``split(value, '\\t', -1)``.  Hadoop's text
input decompresses ``.gz`` and ``.bz2`` by extension; ``.bz2`` stays splittable.

A line is rejected only if it has too few fields.  A value that does not parse
as its column's type becomes NULL and the row stays, because most operators
never use that column: the ones that do decide (a year filter drops NULL, a
position credit of NULL stays NULL).

Modes:

- ``failfast``   a short line raises when the job runs (what the positional
                 reader did).
- ``permissive`` short lines are dropped.

``parse_tagged`` keeps every line and adds ``reject``: NULL for a clean line, else its
text, the reason and whether the row was kept.  Rows and rejects are then one scan:
``count_rejects`` counts both by reason, ``write_with_rejects`` writes both in one job,
and ``observe_rejects`` counts the rejects in the same pass as whatever reads the rows.
``parse_lines`` is the plain reader on any DataFrame of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("failfast", "permissive")
#: Reason of a line with too few fields.
SHORT = "short line"


def _typed(schema: T.StructType) -> tuple[list[Column], list[Column]]:
    """Typed columns from the ``_f`` array, and the name of each column whose text is
    not empty but does not parse (NULL otherwise)."""
    cols: list[Column] = []
    unparsed: list[Column] = []
    for i, f in enumerate(schema.fields):
        raw = F.get(F.col("_f"), i)
        if isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))
            continue
        typed = F.expr(f"try_cast(get(_f, {i}) AS {f.dataType.simpleString()})")
        cols.append(typed.alias(f.name))
        unparsed.append(F.when(typed.isNull() & (raw != ""), F.lit(f.name)))
    return cols, unparsed


def _split(lines: DataFrame) -> DataFrame:
    # A blank line is no record (textFile yields '' for it, split gives ['']);
    # keep it so failfast reports it, drop it in permissive mode below.
    return lines.select(F.split(F.col("value"), "\t", -1).alias("_f"), F.col("value"))


def parse_lines(lines: DataFrame, schema: T.StructType, mode: str = "failfast") -> DataFrame:
    """Rows with ``schema``'s names and types from a DataFrame of lines (``value``)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    cols, _ = _typed(schema)
    whole = F.size("_f") >= F.lit(len(schema.fields))
    if mode == "failfast":
        # raise_error is evaluated per row inside the JVM, so the job fails on
        # the first short line just as an IndexError would
        error = F.raise_error(F.concat(F.lit("malformed TSV line: "), F.col("value")))
        whole = F.when(whole, F.lit(True)).otherwise(error)
    return _split(lines).filter(whole).select(*cols)


def parse_tagged(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Every line, typed, with ``reject`` (``line``, ``reason``, ``kept``): short lines
    (all columns NULL, not kept) and lines with unparsable values (kept)."""
    cols, unparsed = _typed(schema)
    short = F.size("_f") < F.lit(len(schema.fields))
    reason = F.when(short, F.lit(SHORT)).otherwise(F.concat_ws(",", *unparsed) if unparsed else F.lit(""))
    reject = F.struct(F.col("value").alias("line"), reason.alias("reason"), (~short).alias("kept"))
    typed = [F.when(~short, c).alias(f.name) for c, f in zip(cols, schema.fields)]
    return _split(lines).select(*typed, F.when(reason != "", reject).alias("reject"))


def rows_of(tagged: DataFrame) -> DataFrame:
    """The rows that ``parse_lines`` keeps in permissive mode."""
    return tagged.filter(F.col("reject").isNull() | F.col("reject.kept")).drop("reject")


def rejects_of(tagged: DataFrame) -> DataFrame:
    """``(line, reason, kept)`` of short lines and of lines with unparsable values."""
    return tagged.filter(F.col("reject").isNotNull()).select("reject.*")


def count_rejects(tagged: DataFrame) -> DataFrame:
    """``(reason, kept, nb_lines)`` over all lines; clean lines have the reason ``''``."""
    reason, kept = F.coalesce("reject.reason", F.lit("")), F.coalesce("reject.kept", F.lit(True))
    return tagged.groupBy(reason.alias("reason"), kept.alias("kept")).agg(F.count(F.lit(1)).alias("nb_lines"))


def observe_rejects(tagged: DataFrame, name: str = "tsv_rejects") -> tuple[DataFrame, Observation]:
    """The kept rows, and the numbers of lines, short lines and lines with unparsable
    values, which the job that reads the rows collects on its way (``Observation.get``).
    The counters lie below the row filter and in the scan's own stage."""
    seen = Observation(name)
    short = F.col("reject.reason") == SHORT
    counted = tagged.observe(
        seen,
        F.count(F.lit(1)).alias("nb_lines"),
        F.count_if(short).alias("nb_short"),
        F.count_if(F.col("reject").isNotNull() & ~short).alias("nb_unparsed"),
    )
    return rows_of(counted), seen


def write_with_rejects(tagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows and rejects written by one job: ``path/part=rows`` and ``path/part=rejects``
    (a kept line with an unparsable value is in both)."""
    parts = F.when(F.col("reject").isNull(), F.array(F.lit("rows"))).otherwise(
        F.when(F.col("reject.kept"), F.array(F.lit("rows"), F.lit("rejects"))).otherwise(F.array(F.lit("rejects")))
    )
    tagged.withColumn("part", F.explode(parts)).write.mode(mode).partitionBy("part").parquet(path)


def read_tsv_with_rejects(
    spark: SparkSession, paths: str | list[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejects), both lazy views of one tagged frame.  Reading both in
    separate jobs scans twice; the functions above need one scan."""
    tagged = parse_tagged(spark.read.text(paths), schema)
    return rows_of(tagged), rejects_of(tagged)


def read_tsv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    mode: str = "failfast",
) -> DataFrame:
    """Positional TSV -> DataFrame with ``schema``'s names and types."""
    return parse_lines(spark.read.text(paths), schema, mode)
