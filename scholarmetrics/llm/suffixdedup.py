"""Operator 8: removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else, in the same text or another; all copies go.  Suffix sorting a whole corpus
would cost far more than it finds, so the suffix arrays are built only where a
repeat can begin or end:

1. Anchors.  The window of ``length`` bytes at every position is assigned the least
   hash of its ``GRAM``-byte grams; equal windows have equal anchors.  Neighbouring
   windows with one anchor form a run (about ``length`` / 2 of them), named by anchor
   and by a hash of its bytes (the context).
2. Anchors that occur once cannot lie in a repeat.  Where all runs of an anchor have
   the same context, all their windows are repeats.  Both need only hashes.
3. The anchors that are left have different contexts: there a repeat begins or ends.
   The bytes of one run per context (some hundred) are fetched, and blocks of them
   are suffix sorted to the depth ``length`` by prefix doubling.  In suffix order,
   with equal strings by position, the previous smaller position that shares
   ``length`` bytes is the predecessor, the next one the successor; a window with
   either is a repeat.  Equal windows have equal anchors, so blocks of whole anchors
   are complete.
4. An anchor with more than ``HOT`` contexts or ``HOT_BYTES`` bytes of them (a common
   passage in many surroundings, periodic text) is not gathered in one task: its
   windows are counted by hash instead, combined before the shuffle.

Copies of a text add rows of hashes only; whatever is grouped is counted first.

Cases: a null text is empty; texts shorter than ``length`` keep all; overlaps of a
string with itself count; repeated rows are texts of their own, so they repeat each
other; rows are told apart by id and text hash, so repeated or null ids do no harm;
an empty table gives an empty table; other input columns are kept, those named like
an output replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import cut, scratch

LENGTH = 200
GRAM = 40
#: Runs are cut after so many windows (only periodic text has longer ones).
LONGEST = 1024
#: Contexts of one anchor that one task may sort.
HOT = 8000
#: Bytes that one suffix array covers, but for what the last whole anchor has more.
BLOCK = 512 << 10
#: Bytes of one anchor's contexts that one task may sort.
HOT_BYTES = 2 << 20

_RUN = pa.struct([("a", pa.int64()), ("c", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("own", pa.bool_())])


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours."""
    m = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    cells = np.concatenate([x, pad]).reshape(-1, w)
    upto = np.minimum.accumulate(cells, axis=1).ravel()
    since = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:m], upto[w - 1 : w - 1 + m])


def _runs(u8: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Anchor, context, begin (in u8), windows and self-repeat mark of all runs."""
    w = length - gram + 1
    if len(u8) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)
    grams = textkit.rolling(u8, gram)
    least = window_minima(grams, w)
    row = np.searchsorted(off, np.arange(len(least)), "right") - 1
    valid = np.arange(len(least)) + length <= off[row + 1]
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
    s = np.flatnonzero(new)
    # a run ends before the next run, or before the next window that crosses rows
    stop = np.append(s[1:], len(least))
    last_valid = off[row[s] + 1] - length + 1
    e = np.minimum(stop, last_valid)
    if len(s) and (e - s).max() > LONGEST:
        parts = -(-(e - s) // LONGEST)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        s, e = np.repeat(s, parts) + k * LONGEST, np.minimum(np.repeat(s, parts) + (k + 1) * LONGEST, np.repeat(e, parts))
    anchor = least[s]
    own = np.zeros(len(s), bool)
    view = np.lib.stride_tricks.sliding_window_view(grams, w)
    for i in range(0, len(s), 4096):
        a = anchor[i : i + 4096, None]
        first = s[i : i + 4096] + (view[s[i : i + 4096]] == a).argmax(1)
        last = e[i : i + 4096] + w - 2 - (view[e[i : i + 4096] - 1][:, ::-1] == a).argmax(1)
        own[i : i + 4096] = first != last
    context = textkit.span_hashes(u8, s, e + length - 1)
    return anchor.astype(np.int64), context.astype(np.int64), s, e - s, own


def add_runs(df: DataFrame, length: int, gram: int, text: str = "text") -> DataFrame:
    @arrow_udf("array<struct<a:bigint,c:bigint,s:int,n:int,own:boolean>>")
    def run(col: pa.Array) -> pa.Array:
        u8, off = textkit.flat(col)
        out, sizes = [], []
        for i, j in textkit.blocks(off, textkit.PIECE):
            local = off[i : j + 1] - off[i]
            a, c, s, n, own = _runs(u8[off[i] : off[j]], local, length, gram)
            row = np.searchsorted(local, s, "right") - 1
            sizes.append(np.bincount(row, minlength=j - i)[: j - i])
            out.append((a, c, s - local[row], n, own))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 5
        offs = np.append(0, np.cumsum(np.concatenate(sizes))) if sizes else np.zeros(1)
        values = pa.StructArray.from_arrays([pa.array(x.astype(t.type.to_pandas_dtype()), t.type) for x, t in zip(cols, _RUN)], fields=list(_RUN))
        return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), values)

    return df.withColumn("runs", run(F.col(text)))


def _dense_rank(x: np.ndarray) -> np.ndarray:
    order = np.argsort(x)
    value = x[order]
    place = np.zeros(len(x), np.uint32)
    np.cumsum(value[1:] != value[:-1], out=place[1:])
    rank = np.empty(len(x), np.uint32)
    rank[order] = place
    return rank


def depth_classes(u8: np.ndarray, length: int) -> np.ndarray:
    """For each position of ``u8`` the rank of its first ``length`` bytes in suffix order
    (equal strings, equal rank), by prefix doubling; what lies past the end comes first.
    Holds some 40 bytes for each byte of ``u8``."""
    x = np.zeros(len(u8), np.uint64)
    have = 8 if length >= 8 else 1
    padded = np.append(u8, np.zeros(length + 8, np.uint8))
    for j in range(have):
        x <<= np.uint64(8)
        x |= padded[j : j + len(u8)]
    rank = _dense_rank(x)
    while have < length:
        step = min(have, length - have)
        x[:] = rank
        x <<= np.uint64(32)
        x[:-step] |= rank[step:] + np.uint32(1)
        rank = _dense_rank(x)
        have += step
    return rank


def repeated_windows(u8: np.ndarray, begins: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For every window of the contexts that begin at ``begins``, in order, whether its
    longest previous or next factor reaches ``length``."""
    at = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    rank = depth_classes(u8, length)[at]
    order = np.lexsort((at, rank))  # suffix order to the depth, equal strings by position
    same = rank[order][1:] == rank[order][:-1]
    out = np.zeros(len(at), bool)
    out[order[1:][same]] = True  # the previous smaller position shares `length` bytes
    out[order[:-1][same]] = True  # the next one does
    return out


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(d, t, b, e) of the repeats in contexts (a, d, t, s, n, open, body), whole anchors
    to a task."""

    def spans(rows: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(rows)
        u8, off = textkit.flat(t["body"])
        n, s = t["n"].to_numpy().astype(np.int64), t["s"].to_numpy().astype(np.int64)
        hit = repeated_windows(u8, off[:-1], n, length)
        owner = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
        hit &= t["open"].to_numpy(zero_copy_only=False)[owner]
        i = np.flatnonzero(hit)
        new = np.append(True, (np.diff(i) > 1) | (np.diff(owner[i]) > 0)) if len(i) else np.zeros(0, bool)
        b, last = i[new], i[np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)] if len(i) else i
        begin, end = s[owner[b]] + inside[b], s[owner[b]] + inside[last] + length
        take = lambda c: t[c].combine_chunks().take(pa.array(owner[b]))
        return pa.RecordBatch.from_arrays([take("d"), take("t"), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], ["d", "t", "b", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            t = pa.Table.from_batches([batch])
            a, (_, off) = t["a"].to_numpy(), textkit.flat(t["body"])
            edges = np.flatnonzero(a[1:] != a[:-1]) + 1  # rows that begin an anchor
            if held and len(a) and held[-1]["a"][-1].as_py() != a[0]:
                edges = np.append(0, edges)
            done = 0
            for k in edges.tolist():
                if size + off[k] - off[done] >= BLOCK:
                    held.append(t.slice(done, k - done))
                    yield spans(held)
                    held, size, done = [], 0, k
                    textkit.give_back()
            held.append(t.slice(done))
            size += int(off[-1] - off[done])
        if held:
            yield spans(held)
        textkit.give_back()

    whole = contexts.select("a", "d", "t", "s", "n", "open", "body").repartition("a").sortWithinPartitions("a")
    return whole.mapInArrow(run, "d bigint, t bigint, b int, e int")


def _counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many contexts: windows are counted by hash."""

    @arrow_udf("array<bigint>")
    def hashes(col: pa.Array) -> pa.Array:
        out = []
        u8, off = textkit.flat(col)
        for a, b in zip(off[:-1], off[1:]):
            out.append(textkit.rolling(u8[a:b], length).astype(np.int64))
        return textkit.ragged(out, pa.int64())

    windows = contexts.select("a", "d", "t", "s", "open", F.posexplode(hashes(F.col("body"))).alias("k", "h"))
    twice = windows.groupBy("a", "h").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    hit = windows.where("open").join(twice.hint("merge"), ["a", "h"])
    return hit.select("d", "t", (F.col("s") + F.col("k")).cast("int").alias("b"), (F.col("s") + F.col("k") + length).cast("int").alias("e"))


def repeats(df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """(d, t, begins, ends): the maximal repeated runs of each text (keys ``d``, ``t`` of
    ``df`` are its id and text hash)."""
    runs = cut(add_runs(df.select("d", "t", F.col(text)), length, gram).select("d", "t", F.explode("runs").alias("r")).select("d", "t", "r.*"))
    anchors = runs.groupBy("a").agg(F.count("*").alias("times"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("own").alias("any_own"))
    anchors = anchors.where("times > 1 OR any_own").select("a", (F.col("any_own") | F.expr("lo <> hi")).alias("mixed"))
    shared = cut(runs.join(anchors.hint("merge"), "a"))
    span = [F.col("s").alias("b"), (F.col("s") + F.col("n") - 1 + length).alias("e")]
    mixed = shared.where("mixed")
    place = F.min(F.struct("d", "t", "s")).alias("at")
    contexts = mixed.groupBy("a", "c").agg(F.count("*").alias("times"), F.first("n").alias("n"), place, F.max("own").alias("own"))
    contexts = cut(contexts.select("a", "c", "n", "at.*", (F.col("times") == 1).alias("open")))
    per_anchor = contexts.groupBy("a").agg(F.count("*").alias("held"), F.sum(F.col("n") + length - 1).alias("bytes"), F.max("open").alias("any_open"))
    per_anchor = per_anchor.where("any_open").select("a", ((F.col("held") > HOT) | (F.col("bytes") > HOT_BYTES)).alias("hot"))
    known = shared.where("NOT mixed").select("d", "t", *span)
    again = mixed.join(contexts.where("NOT open").select("a", "c").hint("merge"), ["a", "c"]).select("d", "t", *span)
    wanted = contexts.join(per_anchor.hint("merge"), "a").select("d", "t", F.struct("a", "s", "n", "open", "hot").alias("w"))
    wanted = cut(wanted)
    sources = df.select("d", "t", F.encode(F.col(text), "UTF-8").alias("bytes"))
    # what is wanted grows with the corpus: joined by a shuffle at every size
    fetched = sources.join(wanted.hint("merge"), ["d", "t"])
    bodies = cut(fetched.select("d", "t", "w.*", F.expr(f"substring(bytes, w.s + 1, w.n - 1 + {length})").alias("body")).dropDuplicates(["d", "t", "a", "s"]))
    found = known.unionByName(again).unionByName(_sorted_spans(bodies.where("NOT hot"), length)).unionByName(_counted_spans(bodies.where("hot"), length))

    @arrow_udf("struct<begins:array<int>,ends:array<int>>")
    def merged(col: pa.Array) -> pa.Array:
        begins, ends = [], []
        for spans in col.to_pylist():
            at = np.array([(x["b"], x["e"]) for x in spans], np.int64)
            at = at[np.argsort(at[:, 0], kind="stable")]
            reach = np.maximum.accumulate(at[:, 1])
            new = np.append(True, at[1:, 0] > reach[:-1])
            begins.append(at[new, 0].astype(np.int32))
            ends.append(reach[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)].astype(np.int32))
        return pa.StructArray.from_arrays([textkit.ragged(begins, pa.int32()), textkit.ragged(ends, pa.int32())], ["begins", "ends"])

    listed = found.groupBy("d", "t").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    return cut(listed.select("d", "t", merged(F.col("spans")).alias("m")).select("d", "t", "m.*"))


def dedup(df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Add ``kept`` (the remaining bytes), ``begins`` and ``ends`` (the removed runs)."""
    key = {"__d": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)), "__t": F.xxhash64(text)}
    keyed = df.drop("begins", "ends", "kept").withColumns(key)
    with scratch(df.sparkSession) as s:
        spans = s.keep(repeats(keyed.select(F.col("__d").alias("d"), F.col("__t").alias("t"), text), length, gram, text))

    @arrow_udf("binary")
    def remove(col: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for body, bs, es in zip(col, begins, ends):
            if not body.is_valid:
                out.append(None)
                continue
            data, at, parts = body.as_py(), 0, []
            for b, e in zip(bs.as_py(), es.as_py()):
                parts.append(data[at:b])
                at = e
            out.append(b"".join([*parts, data[at:]]))
        return pa.array(out, pa.binary())

    joined = keyed.join(spans.toDF("__d", "__t", "begins", "ends").hint("merge"), ["__d", "__t"], "left")
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    cut_body = remove(F.when(F.col("begins").isNotNull(), body), "begins", "ends")
    return joined.withColumn("kept", F.coalesce(cut_body, body)).drop("__d", "__t")
