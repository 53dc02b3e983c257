"""Running citation counts over an arriving feed of citation-edge files.

The batch operator A1 (``citation_counts``) is a plain ``groupBy().count()``,
so it runs unchanged on a streaming DataFrame: Structured Streaming keeps one
running count per cited paper in its state store (checkpointed, so a lost
executor or a restarted query resumes where it stopped) and emits the changed
counts each micro-batch (``update`` mode) or the whole table (``complete``).

State size is one row per distinct cited paper; it does not grow with the
number of edges.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scholarmetrics.operators.counts import citation_counts
from scholarmetrics.schemas import PAPER_REFERENCES
from scholarmetrics.sources.tables import checkpoint_dir


def edge_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming ``(citing_id, cited_id)`` rows from files landing in ``path``."""
    r = spark.readStream.format(fmt).schema(PAPER_REFERENCES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("citing_id", "cited_id")


def running_citation_counts(edges: DataFrame) -> DataFrame:
    """A1 on a stream: ``(paper_id, nb_citations)`` as running totals."""
    return citation_counts(edges)


def start_running_counts(
    counts: DataFrame,
    query_name: str,
    sink: str,
    output_mode: str = "update",
    checkpoint_location: str | None = None,
    trigger_available_now: bool = False,
) -> StreamingQuery:
    """Start the query into ``sink`` (the memory sink keeps every count on the
    driver: for tests only).  The checkpoint goes to ``checkpoint_location`` or, by
    default, below the session's shared checkpoint folder."""
    spark = counts.sparkSession
    if checkpoint_location is None:
        base = checkpoint_dir(spark)
        if base is None:
            raise ValueError("no checkpoint location: set spark.checkpoint.dir or pass one")
        checkpoint_location = posixpath.join(base, "streams", query_name)
    w = (
        counts.writeStream.queryName(query_name)
        .format(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint_location)
    )
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()
