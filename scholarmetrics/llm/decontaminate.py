"""Operator 7: benchmark items inside documents by size-partitioned MinHash containment.

An item is found in a document that holds at least ``threshold`` of the item's
distinct shingles.

Words are runs of letters, digits and non-ASCII characters in lower case, so changed
case or punctuation does not hide an item.

- Items are partitioned by the size of their shingle set.  All shingles are ordered by
  one hash; an item of ``q`` shingles is represented by its ``q - ceil(threshold * q) +
  REPEAT`` smallest values (at most all), so a containing document holds at least
  ``hits`` of them whatever else it contains.  The ratio of document to item size, at
  which a MinHash comparison of whole sets fails, plays no part.
- A document's shingles are looked up in the index of these values; partitions whose
  items are too large for the document's set are left out; items with enough hits are
  verified on their full sets.
- Items shorter than ``width`` words are one shingle of all their words and are sought
  among the documents' runs of that many words.

A benchmark of at most ``ITEM_BYTES`` of distinct text goes to the executors as a broadcast;
each worker builds its index once.  A larger one is taken in slices of about that many bytes,
one pass over the documents and one broadcast each, so no index outgrows a worker and the
driver holds one slice at a time.  Documents are handled row by row: no shuffle, no skew.

Cases: a null text or one without words holds nothing; a null or empty item is found
nowhere; repeated items are found each, repeated documents get equal rows; a very long text is
held by one task, row by row; an empty
benchmark finds nothing; an empty table gives an empty table; a column ``found`` of the
input is replaced, others are kept.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import cut

WIDTH, THRESHOLD = 5, 0.75
#: Hits that a containing document is sure to have.
REPEAT = 3
#: Bytes of distinct items that a broadcast holds; an index takes about ten times as much.
ITEM_BYTES = 16 << 20


def _words(col: pa.Array):
    """Hashes of the folded words of each text; punctuation does not count."""
    return textkit.words(*textkit.flat(pc.utf8_lower(col)), blank=textkit.IS_MARK)


class Index:
    """Partitions of items by set size, each with the inverted index of its sketches."""

    def __init__(self, items: list[tuple[int | None, str | None, int]], width: int, threshold: float):
        self.ids, texts, self.times = zip(*items) if items else ((), (), ())
        h, first = _words(pa.array(texts, pa.string()))
        self.sets = [textkit.shingle_set(h[a:b], width) for a, b in zip(first[:-1], first[1:])]
        lengths = np.minimum(np.diff(first), width)
        self.need = np.array([ceil(threshold * len(s) - 1e-9) for s in self.sets], np.int64)
        entries: dict[tuple[int, int], list[int]] = {}
        for i, s in enumerate(self.sets):
            if len(s):
                entries.setdefault((int(lengths[i]), len(s).bit_length()), []).append(i)
        #: (words per shingle, smallest set that qualifies, values, owners, hits needed by owner)
        self.partitions = []
        self.hits = np.zeros(len(items), np.int64)
        for (n, _), own in sorted(entries.items()):
            sketches = []
            for i in own:
                q, spare = len(self.sets[i]), len(self.sets[i]) - int(self.need[i])
                sketches.append(self.sets[i][: min(q, spare + REPEAT)])
                self.hits[i] = len(sketches[-1]) - spare
            owner = np.repeat(own, [len(s) for s in sketches])
            value = np.concatenate(sketches)
            order = np.argsort(value, kind="stable")
            self.partitions.append((n, int(self.need[own].min()), value[order], owner[order]))
        self.widths = sorted({p[0] for p in self.partitions})

    def find(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of all items that the words of a document contain."""
        out = []
        sets = {n: np.unique(textkit.shingles(words, n)) for n in self.widths}
        for n, least, value, owner in self.partitions:
            s = sets[n]
            if len(s) < least:
                continue
            low, high = np.searchsorted(value, s, "left"), np.searchsorted(value, s, "right")
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            found = np.concatenate([owner[a:b] for a, b in zip(low[hit], high[hit])])
            item, times = np.unique(found, return_counts=True)
            for i in item[times >= self.hits[item]].tolist():
                mine = self.sets[i]
                at = np.minimum(np.searchsorted(s, mine), len(s) - 1)
                shared = int((s[at] == mine).sum())
                if shared >= self.need[i]:
                    out.append((i, shared))
        return sorted(out)


def _index(shared: Broadcast, width: int, threshold: float) -> Index:
    """The index of the items; a worker keeps it with its copy of the broadcast."""
    if not hasattr(shared, "index"):
        shared.index = Index(shared.value, width, threshold)
    return shared.index


def _finder(shared: Broadcast, width: int, threshold: float):
    """A function on a text column that finds the given items (id, text, times)."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("shared", pa.int64()), ("size", pa.int64())]))

    @arrow_udf("array<struct<item_id:bigint,shared:bigint,size:bigint>>")
    def run(col: pa.Array) -> pa.Array:
        index, out = _index(shared, width, threshold), []
        _, off = textkit.flat(col)
        for a, b in textkit.blocks(off):
            h, first = _words(col.slice(a, b - a))
            for i, j in zip(first[:-1], first[1:]):
                hits = index.find(h[i:j])
                out.append([{"item_id": index.ids[x], "shared": n, "size": len(index.sets[x])} for x, n in hits for _ in range(index.times[x])])
        return pa.array(out, kind)

    return run


def find(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    bytes_at_once: int = ITEM_BYTES,
) -> DataFrame:
    """Add ``found``: array of item_id, shared shingles and size of the item's set."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t"))
    items = items.groupBy("i", "t").agg(F.count("*").alias("times"))
    whole = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    slices = max(1, -(-whole // bytes_at_once))
    if slices > 1:
        items = cut(items)
    for k in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == k)
        held = [tuple(r) for r in part.orderBy("i", "t").collect()]  # about bytes_at_once
        found = _finder(df.sparkSession.sparkContext.broadcast(held), width, threshold)(F.col(text))
        if k:  # a pass of its own: functions of one projection would share a worker
            df = cut(df).withColumn("__more", found).withColumn("found", F.concat("found", "__more")).drop("__more")
        else:
            df = df.withColumn("found", found)
    return df
