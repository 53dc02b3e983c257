"""Operator 9: quality by perplexity under an interpolated modified Kneser-Ney model.

The model is an n-gram model of order ``DEPTH`` over characters (Unicode code points,
as they stand); its vocabulary is that of the texts.  It is trained on all texts that
are labelled good.

- Documents are dealt to blocks of ``BLOCK`` bytes of text and written once, bucketed by
  block, so that no later step shuffles a text.
- A block lists its distinct n-grams with their occurrences in trusted texts, a row for
  each cell (a hash of the n-gram); the n-grams of all blocks are summed by n-gram.
- Continuation counts, counts of counts (for the three discounts of each order),
  context totals and the joins of n-grams with their contexts are grouped sums and
  joins of count tables that are partitioned (sharded) by n-gram or context.
- The distinct n-grams of all documents get their log probabilities order by order, by
  joins with those tables; no table of n-grams passes through the driver.
- Log probabilities meet the blocks' lists by cell and go back to the blocks in the order
  of the lists, four bytes each; there they are joined with the texts' own n-grams and
  summed per document.  A cell holds an n-gram of a block once, so no n-gram is hot.
- One in ``FOLDS`` trusted texts (by a hash of the text, so with all its copies) is held
  out of the counts.  A document is kept unless its perplexity exceeds the ``QUANTILE``
  quantile, with a small allowance, of the held-out texts of its language (exact counts
  per 1/64 of an octave), mixed with those of all languages at the weight of ``PRIOR``
  documents; a language without any takes the quantile of all.

Cases: a null or empty text has no perplexity and is not kept; a null language is a
language of its own; labels may repeat (good if any row says so and none says toxic);
without trusted text the model is uniform, and without held-out text all texts but the
empty are kept; repeated rows get equal rows; a very long text is a block of its own, held
by one task; an empty table gives an empty table; input columns named like an output are
replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import checked_join, cut, cut_by, scratch, shuffle_partitions

#: Order of the model, bytes of text a block, least number of cells of n-grams.
DEPTH, BLOCK, CELLS = 5, 12 << 20, 32
#: n-grams that a task looks up at once.
HELD = 1 << 20
#: One in ``FOLDS`` trusted texts is held out of the counts; thresholds are taken on those.
FOLDS = 5
#: Quantile of the held-out texts, margin above it, weight of all languages' held-out texts
#: in a language's own quantile (in documents).
QUANTILE, ALLOWANCE, PRIOR = 0.999, 1.1, 20


def orders(
    counts: DataFrame,
    order: int,
    last: Callable[[int], Column],
    before: Callable[[int], Column],
) -> list[tuple[DataFrame, DataFrame]]:
    """(code, alpha) and (context, gamma) of each order 1..``order``: the discounted share of
    each n-gram in its context, and the weight that its context leaves to the lower order.
    ``last(n)`` is the code of the last n symbols, ``before(n)`` the context of an n-gram."""
    tables = {order: cut(counts)}
    for n in range(order - 1, 0, -1):
        # lower orders count the distinct symbols before an n-gram
        tables[n] = cut(tables[n + 1].groupBy(last(n).alias("code")).agg(F.count("*").alias("c")))
    out = []
    for n in range(1, order + 1):
        t = tables[n]
        row = t.agg(*[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)]).first()
        n1, n2, n3, n4 = [x or 0 for x in row]
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        # where few n-grams are rare (the low orders) the formula gives less than nothing
        d = [min(k, max(0.0, k - (k + 1) * y * after / now)) if now else 0.0 for k, now, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        d = [x or 0.1 for x in d]
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = before(n).alias("context")
        per = t.groupBy(context).agg(F.sum("c").alias("total"), F.sum(discount).alias("freed"))
        alpha = t.withColumn("context", context).join(per.hint("merge"), "context").select("code", ((F.col("c") - discount) / F.col("total")).alias("alpha"))
        out.append((alpha, per.select("context", (F.col("freed") / F.col("total")).alias("gamma"))))
    return out


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good by some row and toxic by none."""
    per = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("x"))
    return cut(per.where((F.col("q") == 1) & (F.coalesce("x", F.lit(0)) == 0)).select("doc_id"))


def thresholds(scored: DataFrame) -> DataFrame:
    """(lang_key, threshold) from the rows with ``held_out``, and the one of all languages
    under the key null.  A language's quantile is that of its own held-out texts, mixed with
    those of all languages at the weight of ``PRIOR`` documents."""
    # 1/64 of an octave: a few hundred buckets per language at any size
    bucket = F.floor(F.log2("perplexity") * 64)
    counts = cut(scored.where("held_out AND perplexity IS NOT NULL").groupBy("lang_key", bucket.alias("bucket")).agg(F.count("*").cast("double").alias("n")))
    every = counts.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect()  # some 1,300 rows at most
    if not every:
        return counts.select("lang_key", F.col("n").alias("threshold"))
    whole = sum(r.n for r in every)
    pooled = F.explode(F.array(*[F.struct(F.lit(r.bucket).alias("bucket"), F.lit(r.n).alias("n")) for r in every]))
    general = counts.limit(1).select(F.lit(None).cast("string").alias("lang_key"), pooled.alias("x")).select("lang_key", "x.*")
    prior = counts.select("lang_key").distinct().select("lang_key", pooled.alias("x"))
    prior = prior.select("lang_key", "x.bucket", (F.col("x.n") * PRIOR / whole).alias("n"))
    mixed = counts.unionByName(prior).unionByName(general).groupBy("lang_key", "bucket").agg(F.sum("n").alias("n"))
    upto, by = Window.partitionBy("lang_key").orderBy("bucket"), Window.partitionBy("lang_key")
    cum = mixed.select("lang_key", "bucket", F.sum("n").over(upto).alias("cum"), F.sum("n").over(by).alias("all"))
    # sums of parts may fall short of the whole by rounding
    edge = cum.where(F.col("cum") >= QUANTILE * F.col("all") - 1e-6).groupBy("lang_key").agg(F.min("bucket").alias("edge"))
    return edge.select("lang_key", (F.pow(F.lit(2.0), (F.col("edge") + 1) / 64) * ALLOWANCE).alias("threshold"))


def _runs(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of order DEPTH; (n-gram, text, count) with the first two ascending."""
    pad = "\n" * (DEPTH - 1)
    s = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    end = np.arange(len(doc), dtype=np.int64 if len(s) >= 2**31 else np.int32)
    end += (doc + 1) * np.int32(DEPTH - 1)  # place of each n-gram's last character
    seen = np.zeros(int(s.max(initial=0)) + 1, bool)
    seen[s] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    a, rank = len(alphabet), (np.cumsum(seen, dtype=np.int32) - 1)[s]
    code, direct = np.zeros(len(doc), np.int64), a**DEPTH * len(texts) < 2**63
    for back in range(DEPTH - 1, -1, -1):
        code *= a
        code += rank[end - back]
        if not direct:  # many characters: n-grams are numbered symbol by symbol
            _, first, code = np.unique(code, return_index=True, return_inverse=True)
    code *= len(texts)
    code += doc
    del doc, rank
    if direct:
        del s, end
    code.sort()
    at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(code)))
    code = code[at]
    gram = code // len(texts) if texts else code
    doc = code - gram * len(texts)
    fresh = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
    distinct, gram = gram[fresh], np.cumsum(fresh) - 1
    if direct:
        spelled = alphabet[distinct[:, None] // a ** np.arange(DEPTH - 1, -1, -1) % a]
    else:
        spelled = s[end[first][:, None] + np.arange(1 - DEPTH, 1)]
    text = spelled.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + DEPTH] for i in range(0, len(text), DEPTH)], gram, doc, count


def _packed(doc: np.ndarray, count: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Places of n-grams, one binary each; those of the i-th are ``edge[i]:edge[i + 1]``.

    A place is the gap to the n-gram's document before and up to 4 occurrences, as a number
    of 7 bits a byte; more occurrences are further places with a gap of 0."""
    gap = np.diff(doc, prepend=0)
    gap[edge[:-1]] = doc[edge[:-1]]
    reps = (count + 3) // 4
    at = np.append(0, np.cumsum(reps))  # first record of each place
    value = np.full(at[-1], 3)
    value[at[:-1]] += gap * 4
    value[at[1:] - 1] -= 4 * reps - count  # the last one holds the rest
    width = 1 + sum((value >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    start = np.append(0, np.cumsum(width))
    out = np.zeros(start[-1], np.uint8)
    for k in range(int(width.max(initial=0))):
        m = np.flatnonzero(width > k)
        out[start[m] + k] = (value[m] >> 7 * k & 127) | (width[m] > k + 1) << 7
    offsets = start[at[edge]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _unpacked(u8: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, occurrences) of the places in binaries at ``off``."""
    end = np.flatnonzero(u8 < 128)
    start = np.append(0, end[:-1] + 1)[: len(end)]
    width, value = end - start + 1, np.zeros(len(end), np.int64)
    for k in range(int(width.max(initial=0))):
        m = np.flatnonzero(width > k)
        value[m] |= (u8[start[m] + k].astype(np.int64) & 127) << 7 * k
    row = np.searchsorted(off, start, "right") - 1
    upto, first = np.cumsum(value >> 2), np.flatnonzero(np.diff(row, prepend=-1))
    before = np.zeros(len(off), np.int64)
    before[row[first]] = upto[first] - (value[first] >> 2)
    return row, upto - before[row], (value & 3) + 1


def _cell(grams: list[str], cells: int) -> np.ndarray:
    """The cell of each n-gram, from 0 to ``cells`` - 1."""
    s = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, DEPTH)
    h = np.zeros(len(s), np.uint64)
    for k in range(DEPTH):
        h = textkit.mix(h + s[:, k])
    return (h % np.uint64(cells)).astype(np.int32)


def _split(col: pa.ChunkedArray) -> pa.Array:
    """The n-grams of rows that hold them end to end."""
    u8, _ = textkit.flat(col)
    start = np.flatnonzero(u8 & 0xC0 != 0x80)[::DEPTH]
    offsets = np.append(start, len(u8)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(u8)])


def dealt(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__block``: consecutive rows of some ``BLOCK`` bytes of text, or one longer text."""
    schema = StructType(df.schema.fields + [StructField("__block", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, room = TaskContext.get().partitionId() << 33, BLOCK
        for batch in batches:
            blocks = np.zeros(batch.num_rows, np.int64)
            for i, size in enumerate(np.diff(textkit.flat(batch.column(text))[1]).tolist()):
                if size > room and room < BLOCK:
                    block, room = block + 1, BLOCK
                blocks[i], room = block, room - size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks)], schema.names)

    return df.mapInArrow(run, schema)


def lists(docs: DataFrame, cells: int, text: str = "text") -> DataFrame:
    """(__block, cell, codes, cs): a block's distinct n-grams, in ascending order within a
    cell, and their occurrences in documents with ``__train``."""

    def run(part: pa.Table) -> pa.Table:
        grams, gram, doc, count = _runs([t or "" for t in part.column(text).to_pylist()])
        train = part.column("__train").to_numpy().astype(bool)
        c = np.bincount(gram, count * train[doc], len(grams)).astype(np.int64)
        cell = _cell(grams, cells)
        order = np.argsort(cell, kind="stable")
        at = np.flatnonzero(np.diff(cell[order], prepend=-1))
        offsets = np.append(at, len(grams)).astype(np.int32)
        codes = pa.array(grams, pa.string()).take(pa.array(order))
        columns = [
            pa.array(np.full(len(at), part.column("__block")[0].as_py())), pa.array(cell[order][at]),
            pa.ListArray.from_arrays(offsets, codes), pa.ListArray.from_arrays(offsets, c[order]),
        ]
        textkit.give_back()
        return pa.Table.from_arrays(columns, ["__block", "cell", "codes", "cs"])

    narrow = docs.select("__block", "__train", text)
    return narrow.groupBy("__block").applyInArrow(run, "__block bigint, cell int, codes array<string>, cs array<bigint>")


def looked_up(rows: DataFrame, log: DataFrame, cells: int) -> DataFrame:
    """(__block, cell, lls): the log probabilities of each row of ``lists`` in its order, as
    32-bit integers."""

    @arrow_udf("int")
    def cell(code: pa.Array) -> pa.Array:
        return pa.array(_cell(code.to_pylist(), cells))

    def run(lists: pa.Table, known: pa.Table) -> pa.Table:
        value, code = known.column("ll").to_numpy().astype("<i4"), known.column("code").combine_chunks()
        n, lls = lists.column("n").to_numpy(), []
        edge = [*np.flatnonzero(np.diff(np.cumsum(n) // HELD, prepend=-1)).tolist(), len(n)]
        for a, b in zip(edge, edge[1:]):
            ll = value[pc.index_in(_split(lists.column("codes").slice(a, b - a)), value_set=code).to_numpy()]
            lls += [x.tobytes() for x in np.split(ll, np.cumsum(n[a:b])[:-1])]
        columns = [lists.column("__block"), lists.column("cell"), pa.chunked_array([pa.array(lls, pa.binary())])]
        return pa.Table.from_arrays(columns, ["__block", "cell", "lls"])

    joined = rows.select("__block", "cell", F.size("codes").alias("n"), F.array_join("codes", "").alias("codes"))
    known = log.select(cell("code").alias("cell"), "code", "ll")
    return joined.groupBy("cell").cogroup(known.groupBy("cell")).applyInArrow(run, "__block bigint, cell int, lls binary")


def sums(docs: DataFrame, known: DataFrame, cells: int, text: str = "text") -> DataFrame:
    """The rows of ``docs``, without their text, with ``n_symbols`` and ``__ll``, the sum of
    the log probabilities of their characters (``known``: those of ``looked_up``)."""
    rest = [f for f in docs.schema.fields if f.name not in (text, "__train", "__block")]
    schema = StructType(rest + [StructField("n_symbols", LongType()), StructField("__ll", LongType())])

    def run(part: pa.Table, known: pa.Table) -> pa.Table:
        texts = [t or "" for t in part.column(text).to_pylist()]
        grams, gram, doc, count = _runs(texts)
        ll = np.zeros(len(grams))
        if grams:
            ll[np.argsort(_cell(grams, cells), kind="stable")] = np.frombuffer(b"".join(known.sort_by("cell").column("lls").to_pylist()), "<i4")
        total = np.bincount(doc, ll[gram] * count, len(texts)).astype(np.int64)  # whole numbers below 2**53
        own = [pa.array([len(t) for t in texts], pa.int64()), pa.array(total)]
        textkit.give_back()
        return pa.Table.from_arrays([part.column(f.name) for f in rest] + own, schema.names)

    return docs.groupBy("__block").cogroup(known.groupBy("__block")).applyInArrow(run, schema)


def log_probabilities(grams: DataFrame) -> DataFrame:
    """(code, ll): log probability, in 2**-20, of the last character of each n-gram of
    ``grams`` (code, c: occurrences in trusted text, perhaps 0)."""
    last = lambda n: F.substring("code", -n, n)
    before = lambda n: F.substring("code", 1, n - 1)
    asked = {DEPTH: grams.select("code")}
    for n in range(DEPTH - 1, 0, -1):
        asked[n] = cut(asked[n + 1].select(last(n).alias("code")).distinct())
    p, uniform = None, F.lit(1.0 / max(1, asked[1].count()))
    for n, (alpha, gamma) in enumerate(orders(grams.where("c > 0").select("code", "c"), DEPTH, last, before), 1):
        t = asked[n].select("code", before(n).alias("context"), last(n - 1).alias("lower") if n > 1 else F.lit("").alias("lower"))
        t = checked_join(checked_join(t, cut(alpha), "code", "left"), cut(gamma), "context", "left")
        t = t.withColumn("q", uniform) if p is None else checked_join(t, p, "lower")
        q = F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("q")
        p = cut(t.select(F.col("code").alias("lower"), q.alias("q")))
    return cut(p.select(F.col("lower").alias("code"), F.rint(F.log("q") * 2**20).cast("long").alias("ll")))


def score_characters(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by ``n_symbols`` (characters) and ``perplexity`` (null for an empty
    text) under the model of the texts with ``__train``, which is dropped."""
    df = df.drop("n_symbols", "perplexity")
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # blocks and cells both grow with the root of their product
    cells = max(CELLS, int(size**0.5) // 256)
    docs = cut_by(dealt(df, text), "__block", max(shuffle_partitions(df), -(-size // BLOCK)), "zstd")
    rows = cut(lists(docs, cells, text), "zstd")
    each = rows.select(F.explode(F.arrays_zip("codes", "cs")).alias("x"))
    grams = cut(each.groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.cs").alias("c")))
    with scratch(df.sparkSession) as s:
        log = s.keep(log_probabilities(grams))
    scored = sums(docs, looked_up(rows, log, cells), cells, text)
    return scored.withColumn("perplexity", F.when(F.col("n_symbols") > 0, F.exp(F.col("__ll") / -(2.0**20) / F.col("n_symbols")))).drop("__ll")


def classify(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Add ``trusted``, ``held_out``, ``n_symbols``, ``perplexity``, ``threshold`` and
    ``kept``; the text column is dropped."""
    key = F.to_json(F.struct(F.col(lang).alias("lang")))
    with scratch(df.sparkSession) as s:
        good = good_ids(labels).withColumnRenamed("doc_id", "__good")
        flagged = checked_join(df.withColumn("__good", F.col(doc_id)), good.withColumn("__is", F.lit(True)), "__good", "left")
        flagged = flagged.withColumn("trusted", F.coalesce("__is", F.lit(False))).drop("__good", "__is")
        # by text, so that no copy of a held-out text is learned
        flagged = flagged.withColumn("held_out", F.col("trusted") & (F.pmod(F.xxhash64(text), F.lit(FOLDS)) == 0))
        flagged = flagged.withColumn("__train", F.col("trusted") & ~F.col("held_out"))
        scored = s.keep(cut(score_characters(flagged, text).withColumn("lang_key", key)))
        edges = cut(thresholds(scored))
        s.keep(edges)
    rest = edges.where("lang_key IS NULL").first()
    general = F.lit(rest.threshold if rest else float("inf"))
    out = checked_join(scored, edges.where("lang_key IS NOT NULL"), "lang_key", "left").drop("lang_key")
    out = out.withColumn("threshold", F.coalesce("threshold", general))
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
