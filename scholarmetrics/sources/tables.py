"""S3: materialise an intermediate table and read it back, plain or bucketed.

Between steps of a multi-job workflow the intermediate is written as Parquet
(splittable, columnar, so later scans prune columns and push filters) instead
of gzip text.  ``materialize`` cuts lineage inside one application: it writes a
reliable checkpoint to the shared folder the cluster names in
``spark.checkpoint.dir`` (never a machine-local folder and never a local
checkpoint, so a lost executor does not lose the data).

``write_bucketed`` lays a table out by a key: the rows of a key lie in one bucket file,
sorted.  Tables with equal bucket counts then join and aggregate on that key without an
exchange, in this session and (``read_bucketed``) in any later one; the one shuffle is
paid when the table is written.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(
    df: DataFrame, path: str, key: str, buckets: int, mode: str = "errorifexists", name: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet in ``buckets`` files by the hash of ``key``, each sorted by
    it, and return the table.

    Rows are dealt to the buckets before the write, so that each bucket is one file
    whatever the number of tasks.  A bucket holds whole keys: take a key whose largest
    group fits a task (a paper's links, not an author's papers)."""
    name = name or f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """A table that ``write_bucketed`` wrote, perhaps in another session.  The files do
    not say how they were dealt, so ``key`` and ``buckets`` must be those of the write."""
    name = name or f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh path in the folder that all executors share.  Only a session with a local
    master may lack that setting; it gets a temporary folder of its own."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="scholarmetrics-")
    return f"{base.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's reliable checkpoint folder, if any is configured.
    ``None`` also where the session has no SparkContext (Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:
        return None
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (runs the plan now).

    Without a folder the plan is returned unchanged, with a warning:
    recomputation from the source files is always correct, only slower.
    """
    spark = spark or df.sparkSession
    if checkpoint_dir(spark) is None:
        warnings.warn("spark.checkpoint.dir is not set: the intermediate table is computed anew by each reader", stacklevel=2)
        return df
    return df.checkpoint(eager=True)


def materialize_files(df: DataFrame) -> DataFrame:
    """``materialize`` as Parquet files in the shared folder.  Unlike a checkpoint, files
    have a size that the planner knows: joins with a small table broadcast it."""
    spark = df.sparkSession
    if checkpoint_dir(spark) is None:
        return materialize(df)
    path = shared_folder(spark, "kept")
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)
