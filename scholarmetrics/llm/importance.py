"""Operator 13: importance resampling toward a target distribution.

Features are the runs of 1 to ``orders`` consecutive words, hashed by CRC-32 to
``buckets``.  A text is normalised to its words, joined by one separator, and scanned
once: the running CRC before and after each word is stored.  The CRC of any run of words
follows from two of these prefixes, since CRCs are linear over GF(2): the CRC of the
prefix before the run, shifted by the run's length in zero bytes, cancels from the CRC of
the prefix that ends with it (``Shift``).  So no run is ever hashed by itself.

1. ``bucket_counts`` counts the features of all documents, and those of the target texts;
   each task sums its rows first, and the result has at most ``buckets`` rows.
2. ``weigh`` scans the documents again: a document's weight is the floored mean of its
   features' gains, which are the scaled log ratios of the two smoothed distributions.
3. ``draw`` adds Gumbel noise (from a digest of the id) to the weights and takes the
   largest sums, which draws without replacement in proportion to the exponentials.  Ranks
   come from the counts of equal scores and a window inside each score, so the documents
   are never sorted as a whole.

Long texts are scanned in blocks; the running CRC and the last words are carried over.

Cases: a null or empty text, or one without words, has no features and weight 0; a null id
is hashed as an empty one and stands after all others in ties; rows that repeat an id are
drawn each for itself, in any order among equals; no target or no documents leave counts
of zero, which the smoothing admits; an empty table gives an empty table; other columns
are kept by ``weigh``, those named like an output replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import cut

ORDERS = 2
BUCKETS = 10_000
#: Gains and scores are integers of this scale.
SCALE = 1000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
SEED = 7
#: A block of text that is scanned at a time.
BLOCK = 1 << 20
#: Scores are summed in bands of this width before they are summed over the bands.
BAND = 1024

#: Upper-case ASCII to lower case, bytes outside of words to blanks.
_NORMAL = bytes(32 if textkit.IS_MARK[b] else b + 32 if 65 <= b < 91 else b for b in range(256))


class Shift:
    """The linear map that n zero bytes make of a CRC-32 register."""

    SHORT = 64

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):  # fixed value: the reflected polynomial of CRC-32
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
        #: maps of one zero byte, by the register's four bytes
        one = np.stack([byte, *[np.arange(256, dtype=np.uint32) << np.uint32(8 * k - 8) for k in (1, 2, 3)]])
        same = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        maps = [same]
        while len(maps) < self.SHORT:
            maps.append(self.apply(one, maps[-1]))
        self.short = np.stack(maps)  # by the number of bytes
        self.long = [self.apply(one, maps[-1])]  # by the power of two, from SHORT
        while len(self.long) < 40:
            self.long.append(self.apply(self.long[-1], self.long[-1]))

    @staticmethod
    def apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = table[0][c & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ table[k][(c >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def __call__(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        rest = n & (self.SHORT - 1)
        out = self.short[rest, 0, c & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ self.short[rest, k, (c >> np.uint32(8 * k)) & np.uint32(255)]
        high = n // self.SHORT
        for k in range(int(high.max(initial=0)).bit_length()):
            has = np.flatnonzero((high >> k) & 1)
            out[has] = self.apply(self.long[k], out[has])
        return out


_shift: list[Shift] = []


def shift() -> Shift:
    if not _shift:
        _shift.append(Shift())
    return _shift[0]


class Scan:
    """Running CRCs of the normalised texts of one Arrow batch, block by block.

    ``blocks`` yields arrays over words: row, CRC before and after the word, first byte
    and end in the row's normalised text, and the word's number in the block's rows.  A
    row longer than a block is carried on with its last ``orders - 1`` words repeated."""

    def __init__(self, col: pa.Array, orders: int = ORDERS):
        u8, self.offsets = textkit.flat(col)
        self.data = u8.tobytes().translate(_NORMAL)
        self.orders = orders
        self.n_words = np.zeros(len(col), np.int64)

    def pieces(self, a: int, b: int) -> Iterator[list[bytes]]:
        """The words of one row, in lists that are cut at blanks."""
        while b - a > BLOCK:
            end = self.data.find(b" ", a + BLOCK, b)
            end = b if end < 0 else end
            yield self.data[a:end].split()
            a = end
        yield self.data[a:b].split()

    def blocks(self) -> Iterator[tuple[np.ndarray, ...]]:
        rows: list[int] = []
        counts: list[int] = []
        repeated: list[int] = []
        before: list[int] = []
        after: list[int] = []
        sizes: list[int] = []

        def made() -> tuple[np.ndarray, ...]:
            row = np.repeat(np.array(rows, np.int64), counts)
            old = np.zeros(len(row), bool)  # words that an earlier block has held
            begins = np.cumsum([0, *counts])[:-1]
            for b, k in zip(begins.tolist(), repeated):
                old[b : b + k] = True
            size = np.array(sizes, np.int64)
            out = row, np.array(before, np.uint32), np.array(after, np.uint32), size, old
            for x in (rows, counts, repeated, before, after, sizes):
                x.clear()
            return out

        for i, (a, b) in enumerate(zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())):
            c, held = 0, 0
            for words in self.pieces(a, b):
                if held:  # a further block of the same row
                    tail = min(held, self.orders - 1)
                    keep = before[len(before) - tail :], after[len(after) - tail :], sizes[len(sizes) - tail :]
                    yield made()
                else:
                    tail, keep = 0, ([], [], [])
                before += keep[0]
                after += keep[1]
                sizes += keep[2]
                for w in words:
                    before.append(c)
                    c = crc32(w, c)
                    after.append(c)
                    c = crc32(b" ", c)
                sizes += map(len, words)
                rows.append(i)
                counts.append(tail + len(words))
                repeated.append(tail)
                held = tail + len(words)
                self.n_words[i] += len(words)
            if len(sizes) > BLOCK // 8:
                yield made()
        if rows:
            yield made()

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, CRC-32) of every run of 1 to ``orders`` words."""
        move = shift()
        for row, before, after, size, old in self.blocks():
            for k in range(self.orders):
                n = len(row) - k
                if n <= 0:
                    break
                length = size[:n].copy()  # the run's bytes, separators included
                for j in range(1, k + 1):
                    length += size[j : n + j] + 1
                new = (row[:n] == row[k:]) & ~old[k:]
                first = np.flatnonzero(new)
                yield row[first], after[first + k] ^ move(before[first], length[first])


def bucket_counts(texts: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features in each bucket, over all rows (at most ``buckets`` rows reach
    the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc in Scan(batch.column(0), orders).features():
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = texts.select(text).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():
        out[r.bucket] = r.n
    return out


def gains(of_target: np.ndarray, of_all: np.ndarray) -> np.ndarray:
    """Scaled log ratio of each bucket's smoothed shares, floored."""
    b, t_all, s_all = len(of_all), int(of_target.sum()), int(of_all.sum())
    share = lambda t, s: float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))
    return np.array([math.floor(SCALE * math.log(share(t, s))) for t, s in zip(of_target.tolist(), of_all.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", orders: int = ORDERS) -> DataFrame:
    """Add ``n_words``, ``n_features`` and ``weight`` (the floored mean of the features'
    gains, 0 without any)."""

    @arrow_udf("struct<n_words bigint, n_features bigint, weight bigint>")
    def run(col: pa.Array) -> pa.Array:
        scan, n, total = Scan(col, orders), np.zeros(len(col), np.int64), np.zeros(len(col), np.int64)
        for row, crc in scan.features():
            np.add.at(n, row, 1)
            np.add.at(total, row, gain[crc % np.uint32(len(gain))])
        mean = np.where(n > 0, total // np.maximum(n, 1), 0)
        return pa.StructArray.from_arrays([pa.array(scan.n_words), pa.array(n), pa.array(mean)], ["n_words", "n_features", "weight"])

    names = ("n_words", "n_features", "weight")
    out = docs.withColumn("__weighed", run(F.col(text)))
    return out.withColumns({c: F.col(f"__weighed.{c}") for c in names}).drop("__weighed")


def noise(key: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise of a key, floored: from the first 32 bits of SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(scored: DataFrame, percent: int = 25, least_words: int = LEAST_WORDS, key: str = "doc_id") -> DataFrame:
    """Add ``rank``: 1, 2, 3, ... in the order of falling ``score`` (ties by ``key``) of
    the drawn rows, which are ``percent`` in a hundred of those with enough words, and
    null for all others.  ``scored`` is read several times (a written table).

    Scores are integers: noise spans some 26,000 values and weights less than 100,000, so
    their counts are a small table at any number of rows, fit to be broadcast."""
    able = F.when(F.col("n_words") >= least_words, F.col("score"))
    per = scored.select(able.alias("__able")).where(F.col("__able").isNotNull()).groupBy("__able").agg(F.count("*").alias("n"))
    per = cut(per.withColumn("band", F.floor(F.col("__able") / BAND)))
    all_able = per.agg(F.sum("n")).first()[0] or 0
    drawn = percent * all_able // 100
    bands = per.groupBy("band").agg(F.sum("n").alias("all"))
    above = bands.select("band", (F.sum("all").over(Window.orderBy(F.desc("band"))) - F.col("all")).alias("above"))
    inside = F.sum("n").over(Window.partitionBy("band").orderBy(F.desc("__able"))) - F.col("n")
    before = per.withColumn("inside", inside).join(F.broadcast(above), "band").select("__able", (F.col("above") + F.col("inside")).alias("__before"))
    near = scored.withColumn("__able", able).join(F.broadcast(before.where(F.col("__before") < drawn)), "__able", "left")
    place = F.row_number().over(Window.partitionBy("__able").orderBy(F.col(key).asc_nulls_last())) + F.col("__before")
    inner = near.where(F.col("__before").isNotNull()).withColumn("rank", F.when(place <= drawn, place).cast("bigint"))
    outer = near.where(F.col("__before").isNull()).withColumn("rank", F.lit(None).cast("bigint"))
    return inner.unionByName(outer).drop("__able", "__before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every document."""
    gain = gains(bucket_counts(target, text), bucket_counts(docs, text))
    weighed = weigh(docs.select(key, text), gain, text).drop(text)
    return draw(cut(weighed.withColumn("score", F.col("weight") + noise(F.col(key), seed))), percent, key=key)
