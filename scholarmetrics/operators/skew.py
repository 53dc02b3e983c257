"""Hot-key salting for joins whose probe side may hold a hot key.

A lookup join (probe rows with a build side of one row per key) sends every row
of a key to one task.  If one paper, author, venue or field holds a third of
all link rows, that task does a third of the work.  AQE's skew-join rule splits
such partitions only when both join inputs are fresh shuffles; a build side
that is an aggregate on the join key (the usual case here: weights, counts)
reuses its partitioning and the rule does not apply.  Joins of two raw tables
(J2, J3, J5, J6) are left to AQE; the others salt their hot keys:

1. ``hot_profile`` takes one job per base table, for all its key columns at once:
   a deterministic Bernoulli sample (fixed seed; only the key columns are read)
   is exploded to (column, key) and counted.  A key is hot when its rows would fill
   ``skewedPartitionFactor`` average shuffle partitions, or more bytes than AQE's
   ``skewedPartitionThresholdInBytes``; at most ``MAX_HOT_KEYS`` keys, those with
   most rows (ties by column and key), are taken.  The profile is remembered per
   session and table, and a join may be given its own list (``hot=``).
2. ``skew_join`` gives every probe row of a hot key a salt from a hash of the whole
   row, so that its rows spread over as many tasks as its share calls for (the next
   power of two), and repeats the build rows of that key once per salt.  Both sides
   are read and shuffled once, nothing is broadcast or unioned, the salt of a row is
   the same when a lost task is recomputed, and each probe row meets each build row
   of its key exactly once, also if the build side repeats keys.

Any key list gives exact results, so a stale profile can only cost efficiency.
The plan does not depend on the input's size; only a table without hot keys is
joined plainly.  The session setting ``scholarmetrics.skewSplit`` turns
detection off (``off``); the default is ``auto``.
"""

from __future__ import annotations

from collections import OrderedDict
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

# Sample fraction and seed of the detection, minimum sampled rows
# for a key to count as hot, the longest key list, and the allowance for
# parquet/text decompression when input file sizes stand for shuffled bytes.
SAMPLE_FRACTION = 0.01
SAMPLE_SEED = 20160707
MIN_SAMPLED_ROWS = 20
MAX_HOT_KEYS = 10_000
INPUT_INFLATION = 4

#: Columns that joins use as keys; a profile covers those that its table has.
KEY_COLUMNS = ("paper_id", "author_id", "affiliation_id", "fos_id", "venue", "venue_key", "citing_id", "cited_id")

HOWS = ("left", "inner", "left_semi")
SKEW_SPLIT_CONF = "scholarmetrics.skewSplit"
_MEMO_SIZE = 256
_memo: OrderedDict = OrderedDict()


_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def _byte_string(value: str) -> int:
    """Spark's size strings (``256MB``, ``1k``, ``1048576``) in bytes."""
    v = value.strip().lower().rstrip("b") or "0"
    if v[-1] in _UNITS:
        return int(float(v[:-1]) * _UNITS[v[-1]])
    return int(float(v))


def _conf_bytes(df: DataFrame, name: str, default: str) -> int:
    value = df.sparkSession.conf.get(name, default) or default
    return _byte_string(value)


def input_bytes(df: DataFrame) -> int | None:
    """Sum of the estimated sizes of the plan's leaf relations (file sizes for
    file scans) — no job runs.  ``None`` where the plan's statistics are not
    reachable (a Spark Connect session)."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except Exception:
        return None
    total = 0
    for i in range(leaves.size()):
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def default_min_share(df: DataFrame) -> float:
    """Share of the rows above which a key is hot: by AQE's factor, or by its
    threshold in bytes where that is the smaller share."""
    factor = float(df.sparkSession.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "5.0"))
    share = factor / shuffle_partitions(df)
    size = input_bytes(df)
    if size:
        threshold = _conf_bytes(df, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")
        share = min(share, threshold / (size * INPUT_INFLATION))
    return min(1.0, max(share, 1.0 / MAX_HOT_KEYS))


def hot_profile(
    table: DataFrame,
    keys: list[str] | None = None,
    min_share: float | None = None,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
) -> dict[str, dict[str, float]]:
    """``{column: {key: share of the rows}}`` of the table's hot keys, from one job."""
    cols = [c for c in (keys or KEY_COLUMNS) if c in table.columns]
    if not cols or (table.sparkSession.conf.get(SKEW_SPLIT_CONF, "auto") or "auto").lower() == "off":
        return {c: {} for c in cols}
    share = default_min_share(table) if min_share is None else min_share
    memo_key = (id(table.sparkSession), table.semanticHash(), tuple(cols), share, fraction, seed)
    if memo_key in _memo:
        _memo.move_to_end(memo_key)
        return _memo[memo_key]
    obs = Observation("hot_key_sample")
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("k")) for i, c in enumerate(cols)])
    sample = table.select(*cols).sample(withReplacement=False, fraction=fraction, seed=seed)
    counts = (
        sample.observe(obs, F.count(F.lit(1)).alias("n"))
        .select(F.explode(pairs).alias("x"))
        .groupBy("x.c", "x.k")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # a key in at least MIN_SAMPLED_ROWS sampled rows is rare: the list is short
    wanted = counts.filter((F.col("n") >= MIN_SAMPLED_ROWS) & F.col("k").isNotNull())
    top = wanted.orderBy(F.col("n").desc(), "c", "k").limit(MAX_HOT_KEYS).collect()
    n = obs.get.get("n", 0) if top else 0
    profile: dict[str, dict[str, float]] = {c: {} for c in cols}
    for r in top:
        if r.n >= share * n:
            profile[cols[r.c]][r.k] = r.n / n
    _memo[memo_key] = profile
    while len(_memo) > _MEMO_SIZE:
        _memo.popitem(last=False)
    return profile


def hot_keys(table: DataFrame, key: str, **kw) -> list[str]:
    """The hot keys of one column, most rows first."""
    return list(hot_profile(table, [key], **kw).get(key, {}))


def _salts(key: str, shares: dict[str, float], partitions: int) -> Column:
    """Number of salts of a row's key: the next power of two of the partitions its
    rows would fill, at least 2; 1 for other keys (and NULL)."""
    tiers: dict[int, list[str]] = {}
    for k, share in shares.items():
        tiers.setdefault(2 ** max(1, ceil(log2(max(1.0, share * partitions)))), []).append(k)
    n = F.lit(1)
    for count, keys in sorted(tiers.items()):
        n = F.when(F.col(key).isin(keys), F.lit(count)).otherwise(n)
    return n


def skew_join(
    probe: DataFrame,
    build: DataFrame,
    key: str,
    how: str = "left",
    hot: dict[str, float] | list[str] | None = None,
    detect_on: DataFrame | None = None,
    detect_key: str | None = None,
) -> DataFrame:
    """``probe.join(build, key, how)`` with the probe's hot keys salted.

    ``hot`` names the hot keys (a list, or their shares); ``[]`` disables the
    salting and ``None`` takes the profile of ``detect_on``, the base table that
    the probe was derived from (``detect_key``: its column, if named otherwise), or
    of the probe itself."""
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, got {how!r}")
    if hot is None:
        base, col = (probe, key) if detect_on is None else (detect_on, detect_key or key)
        hot = hot_profile(base).get(col) if col in KEY_COLUMNS else hot_profile(base, [col]).get(col)
    if not hot:
        return probe.join(build, key, how)
    partitions = shuffle_partitions(probe)
    shares = hot if isinstance(hot, dict) else {k: 1.0 / len(hot) for k in hot}
    salts = _salts(key, shares, partitions)
    row_hash = F.xxhash64(*[F.col(c) for c in probe.columns])
    salted = probe.withColumn("__salt", F.pmod(row_hash, salts.cast("bigint")).cast("int"))
    repeated = build.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated, [key, "__salt"], how).drop("__salt")
