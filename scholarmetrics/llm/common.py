"""Shared helpers: shared folder, lineage cuts, size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it has been counted and has at most so
#: many narrow rows (a few longs each: at most some tens of MB); otherwise the
#: join shuffles.
BROADCAST_ROWS = 1_000_000


#: Bytes of an Arrow batch between Spark and its Python workers.  Spark's own default is
#: eight times as much, of which an executor would hold several for each core.
ARROW_BYTES, _ARROW_CONF = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Set the session's limit of an Arrow batch, unless the session has one of its own."""
    if spark.conf.get(_ARROW_CONF, None) is None:
        spark.conf.set(_ARROW_CONF, ARROW_BYTES)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_scopes: list[list[str]] = []


def cut(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (``codec``: of the files, if not
    the session's).

    The columnar files take less room than a checkpoint's serialized rows, later
    scans prune columns, and a lost executor loses nothing.  The files stay as long as
    the folder does, unless a ``scratch`` block ends in which they were written.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    if _scopes:
        _scopes[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def cut_by(df: DataFrame, key: str, buckets: int, codec: str | None = None) -> DataFrame:
    """``cut`` in buckets of ``key``, written by the tasks that hold the rows: what groups
    the table by ``key`` later shuffles none of it.  For keys of which a task holds all rows
    (or few tasks some), as each task writes a file for each of its keys' buckets."""
    spark = df.sparkSession
    bound_batches(spark)
    name = f"llm_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    options = {"compression": codec} if codec else {}
    df.write.format("parquet").options(path=path, **options).bucketBy(buckets, key).saveAsTable(name)
    if _scopes:
        _scopes[-1].append(path)
    out = spark.table(name)
    out.schema  # the frame knows its files from here on
    spark.sql(f"DROP TABLE {name}")  # the files stay
    out._cut_path = path
    return out


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


class scratch:
    """Block whose cut tables are deleted at its end, but for those that ``keep`` names.

    Only for tables whose every reader has ended by then: what leaves the block must be
    cut and kept, or read kept tables alone."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> scratch:
        _scopes.append(self.paths)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.remove(df._cut_path)
        if len(_scopes) > 1:  # the block around this one may delete it
            _scopes[-2].append(df._cut_path)
        return df

    def __exit__(self, *error) -> None:
        _scopes.pop()
        for p in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` (already cut or cheap to count) may be broadcast."""
    return df.limit(limit + 1).count() <= limit


def checked_join(big: DataFrame, side: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``side`` broadcast if it has at most ``limit`` rows, else by a shuffle
    (sort-merge, whose large partitions adaptive execution splits)."""
    if small(side, limit):
        return big.join(F.broadcast(side), on, how)
    return big.join(side.hint("merge"), on, how)
