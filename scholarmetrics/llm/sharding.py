"""Operator 4 [native]: minimax contiguous partition into shards.

Rows with equal texts form an atomic group.  Groups stand in the order of their
SHA-256 digest, which spreads groups of any size evenly; the shards are contiguous
runs of that order whose largest byte size is the least possible.

- Group sizes are summed before the shuffle (a group may hold any share of rows).
- Prefix sums take two levels: inside each of 4096 digest ranges (a window whose
  partitions hold one row per distinct text), and over the 4096 totals.
- The least feasible capacity is found by binary search, six halvings at a time:
  each pass tests 63 capacities, and the greedy check of all of them needs one
  aggregate over the prefix sums per cut (of the row groups that the bounds leave).
- The cuts are at most ``shards - 1`` digests; each row compares its own with them,
  so rows are not joined with groups.
- Slots count rows inside cells of (shard, row hash), offset by the cells before,
  so no window holds a whole shard.

DataFrame functions only.

Cases: a null text has size 1 and CRC 0, and null texts form one group apart from
empty ones; null or repeated ids are rows like others; groups of equal size keep the
digest order; fewer groups than shards leave the last shards empty; an empty table
gives an empty table; other input columns are kept, those named like an output replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmetrics.llm.common import cut

RANGES = 4096
PROBES = 63
CELLS = 1024


def prefix_sums(sized: DataFrame) -> DataFrame:
    """(digest, bytes, end): groups in digest order with the bytes up to and with each."""
    groups = sized.groupBy("digest").agg(F.sum("size").alias("bytes"))
    first = F.conv(F.substring(F.hex("digest"), 1, 3), 16, 10).cast("int")
    groups = cut(groups.withColumn("range", F.coalesce(first, F.lit(-1))))
    totals = groups.groupBy("range").agg(F.sum("bytes").alias("all"))
    before = totals.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("before"))
    inside = F.sum("bytes").over(Window.partitionBy("range").orderBy("digest"))
    # at most RANGES + 1 rows are broadcast
    ends = groups.repartitionByRange("range").withColumn("inside", inside).join(F.broadcast(before), "range")
    return cut(ends.select("digest", "bytes", (F.col("before") + F.col("inside")).alias("end")))


def greedy(ends: DataFrame, total: int, capacities: list[int], shards: int) -> list[list[int] | None]:
    """For each capacity the ends of all shards but the last, None where they can't hold all."""
    at = [[0] for _ in capacities]
    for _ in range(shards - 1):
        upto = [a[-1] + c for a, c in zip(at, capacities)]
        part = ends.where((F.col("end") > min(a[-1] for a in at)) & (F.col("end") <= max(upto)))
        row = part.agg(*[F.max(F.when(F.col("end") <= u, F.col("end"))).alias(f"e{k}") for k, u in enumerate(upto)]).first()
        for a, e in zip(at, row):
            a.append(max(a[-1], e or 0))
    return [a[1:] if total - a[-1] <= c else None for a, c in zip(at, capacities)]


def smallest_capacity(ends: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity that ``shards`` contiguous shards need, and their ends."""
    total, largest = ends.agg(F.max("end"), F.max("bytes")).first()
    if total is None:
        return 0, []
    low = max(-(-total // shards), largest)
    high = -(-total // shards) + largest  # always enough
    best = None
    while low < high or best is None:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        tried = sorted({min(high, low + step * k) for k in range(PROBES)} | {low} | ({high} if best is None else set()))
        for c, found in zip(tried, greedy(ends, total, tried, shards)):
            if found is not None:
                high, best = c, found
                break
            low = c + 1
    return high, best


def shard(df: DataFrame, shards: int = 8, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Add ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``."""
    body = F.coalesce(F.col(text), F.lit(""))
    sized = df.withColumns(
        {
            "size": F.octet_length(body).cast("long") + 1,
            "text_crc32": F.crc32(F.encode(body, "UTF-8")),
            "__digest": F.coalesce(F.unhex(F.sha2(F.encode(F.col(text), "UTF-8"), 256)), F.unhex(F.lit(""))),
        }
    )
    ends = prefix_sums(sized.select(F.col("__digest").alias("digest"), "size"))
    _, cuts = smallest_capacity(ends, shards)
    last = [r[0] for r in ends.where(F.col("end").isin(sorted(set(cuts)))).select("digest", "end").orderBy("end").collect()] if cuts else []
    by_end = dict(zip(sorted(set(c for c in cuts if c)), last))
    number = F.lit(0)
    for c in cuts:
        number = number + F.when(F.col("__digest") > F.lit(bytes(by_end[c])), 1).otherwise(0)
    placed = sized.withColumn("shard", number).withColumn("__cell", F.pmod(F.xxhash64(row_id, "__digest"), F.lit(CELLS)).cast("int"))
    cells = placed.groupBy("shard", "__cell").agg(F.count("*").alias("n"))
    before = cells.select("shard", "__cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("__cell")) - F.col("n")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("shard", "__cell").orderBy(row_id, "__digest"))
    # at most shards * CELLS rows are broadcast
    out = placed.withColumn("__rank", rank).join(F.broadcast(before), ["shard", "__cell"])
    return out.withColumns(
        {"law": F.lit("bytes"), "slot": F.col("__before") + F.col("__rank") - 1, "grown_shard": F.lit(None).cast("int")}
    ).drop("__digest", "__cell", "__rank", "__before")
