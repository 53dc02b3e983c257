"""Operator 1: byte-level BPE encoding and decoding by merge replay.

Texts are split by the pre-tokenizer's pattern.  The distinct pieces of an Arrow
batch (thousands of documents) that a worker has not met yet form one corpus.
Over it an inverted index from token pair to positions is built, and the merges
are replayed in rank order: all places of a pair are merged at once and only
their two neighbours are looked up again.  Documents then take the ids of their
pieces from the table of replayed pieces.  Nothing is shuffled or collected, so
skewed sources or groups of copies have no effect.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows
give equal rows; an empty table gives an empty table; ``encode`` and ``decode``
add one column and keep all others (a column of the same name is replaced).
Ranks that form an earlier-ranked token only after a later merge are handled by
replaying that piece alone, step by step, as the reference order demands.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from scholarmetrics.llm import textkit

#: Size of the table of replayed pieces that a worker keeps between batches.
KEPT_BYTES = 48 << 20
#: Bytes of text that ``encode_decode`` takes at a time.
SLICE = 2 << 20

_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Splitter:
    """Pieces of the pattern, found on arrays of code points.

    ``fixed`` is the only pattern whose rules are known here; any other pattern is
    matched by the regex library.
    """

    #: Fixed value: the public pre-tokenizer pattern.
    fixed = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, pattern: str):
        self.pattern = None if pattern == self.fixed else regex.compile(pattern)
        if self.pattern is None:
            # the classes of the pattern as tiktoken's own Unicode tables have them:
            # under a pattern of one class, it keeps just that class's characters
            every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            self.kind = np.zeros(0x110000, np.uint8)  # 0 other, 1 letter, 2 number, 3 white space
            for k, name in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
                only = tiktoken.Encoding(name, pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
                held = bytes(only.encode_ordinary(every)).decode()
                self.kind[np.frombuffer(held.encode("utf-32-le"), np.uint32)] = k

    def __call__(self, u8: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end byte of all pieces of the rows, in order."""
        data = u8.tobytes()
        if not data:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.pattern is not None:
            spans = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                row = data[a:b].decode()
                at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in row])]).astype(np.int64) + a
                spans += [(at[m.start()], at[m.end()]) for m in self.pattern.finditer(row) if m.end() > m.start()]
            begin, end = np.array(spans, np.int64).reshape(-1, 2).T
            return begin, end
        cp = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        where = np.flatnonzero((u8 & 0xC0) != 0x80)  # byte at which each code point begins
        kind = self.kind[cp]
        rows = np.searchsorted(where, offsets)  # code point at which each row begins
        fresh = np.zeros(len(cp) + 1, bool)
        fresh[rows] = True
        cut = fresh.copy()
        cut[1:-1] |= kind[1:] != kind[:-1]
        # the last white space before a run stands alone, or leads it if it is a blank
        run = np.flatnonzero(cut[:-1] & ~fresh[:-1] & (kind != 3))
        run = run[kind[run - 1] == 3]
        cut[run - 1] = True
        cut[run[cp[run - 1] == 32]] = False
        # contractions: a lone apostrophe that no blank leads, and letters after it
        lone = np.flatnonzero((cp == 39) & cut[:-1])
        lone = lone[lone + 1 < len(cp)]
        lone = lone[(kind[lone + 1] == 1) & ~fresh[lone + 1]]
        for i in lone.tolist():
            for tail in _CONTRACTIONS:
                stop = i + 1 + len(tail)
                if stop <= len(cp) and all(cp[i + 1 + k] == ord(c) for k, c in enumerate(tail)) and not fresh[i + 2 : stop].any():
                    cut[i + 1] = False
                    if stop < len(cp):
                        cut[stop] = True
                    break
        cut[-1] = True
        at = np.append(where, len(u8))[np.flatnonzero(cut)]
        return at[:-1], at[1:]


class Merges:
    """Rank file: bytes of each token and the pairs that join to a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, f.read().splitlines()))}
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        self.single = np.zeros(256, np.int64)
        keys, to = [], []
        for t, r in ranks.items():
            self.token[r] = t
            if len(t) == 1:
                self.single[t[0]] = r
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    to.append(r)
        keys, to = np.array(keys, np.int64), np.array(to, np.int64)
        order = np.argsort(keys)
        self.keys, self.to = np.append(keys[order], np.iinfo(np.int64).max), np.append(to[order], -1)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the joined token of each pair, -1 where there is none."""
        key = (a << 32) | b
        i = np.searchsorted(self.keys, key)
        return np.where((self.keys[i] == key) & (a >= 0) & (b >= 0), self.to[i], -1)

    def one_by_one(self, piece: bytes) -> list[int]:
        """The lowest rank first, the leftmost of equals: for single pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, end to end, and the number of ids of each."""
    if not pieces:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(raw)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    tok = np.append(merges.single[raw], -1)  # place n is the end of every piece
    place = np.arange(n)
    last = np.cumsum(sizes) - 1
    nxt, prv = np.append(place + 1, n), np.append(place - 1, n)
    nxt[last[sizes > 0]] = n
    prv[(last - sizes + 1)[sizes > 0]] = n
    pair = np.append(merges.rank(tok[:n], tok[nxt[:n]]), -1)  # rank of the pair that begins at a place
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        """Add places to the inverted index under the rank of their pair."""
        at = at[pair[at] >= 0]
        if not len(at):
            return
        r = pair[at]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        edge = np.flatnonzero(r[1:] != r[:-1]) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(r)]):
            k = int(r[a])
            if k not in index:
                heapq.heappush(heap, k)
            index[k].append(at[a:b])

    odd = np.zeros(len(pieces), bool)
    enter(place)
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        p = np.concatenate(found) if len(found) > 1 else found[0]
        p = np.sort(p[pair[p] == r])
        if not len(p):
            continue
        p = p[np.append(True, p[1:] != p[:-1])]
        # of places that overlap, the first, third, ... in a row are merged
        chained = np.append(False, nxt[p[:-1]] == p[1:])
        if chained.any():
            begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(p))))
            p = p[(np.arange(len(p)) - begin) % 2 == 0]
        q = nxt[p]
        after = nxt[q]
        tok[p], tok[q], pair[q] = r, -1, -1
        nxt[p] = after
        prv[after] = p
        before = prv[p]
        left, right = merges.rank(tok[before], tok[p]), merges.rank(tok[p], tok[after])
        pair[before], pair[p] = left, right
        pair[n] = -1
        early = ((left >= 0) & (left < r)) | ((right >= 0) & (right < r))
        odd[owner[p[early]]] = True
        enter(np.concatenate([before[left >= 0], p]))
    alive = tok[:n] >= 0
    ids, counts = tok[:n][alive].astype(np.int32), np.bincount(owner[alive], minlength=len(pieces))
    if odd.any():
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(odd).tolist():
            parts[i] = np.array(merges.one_by_one(pieces[i]), np.int32)
        ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
    return ids, counts


class Encoder:
    """A worker's splitter, merges and table of replayed pieces (known by a hash of their
    bytes, see ``textkit.span_hashes``), which is emptied beyond ``KEPT_BYTES``."""

    def __init__(self, path: str, pattern: str):
        self.split, self.merges = Splitter(pattern), Merges(path)
        self.clear()

    def clear(self) -> None:
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Replay the merges over new pieces and enter them in the table."""
        ids, counts = replay(pieces, self.merges)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hash, hashes[order])
        self.slot = np.insert(self.slot, at, (len(self.hash) + order).astype(np.int32))
        self.hash = np.insert(self.hash, at, hashes[order])
        self.ids = np.concatenate([self.ids, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])

    def __call__(self, col: pa.Array) -> pa.Array:
        """Ids of a column of texts, whose pieces form one corpus."""
        u8, offsets = textkit.flat(col)
        if self.hash.nbytes + self.slot.nbytes + self.ids.nbytes + self.begin.nbytes > KEPT_BYTES:
            self.clear()
        seen, fresh = [], {}
        for a, b in textkit.blocks(offsets):
            part, rows = u8[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            begin, end = self.split(part, rows)
            distinct, where, inverse = np.unique(textkit.span_hashes(part, begin, end), return_index=True, return_inverse=True)
            i = np.searchsorted(self.hash, distinct)
            new = np.append(self.hash, np.uint64(0))[i] != distinct
            new |= i == len(self.hash)
            for k, x, y in zip(distinct[new].tolist(), begin[where[new]].tolist(), end[where[new]].tolist()):
                if k not in fresh:
                    fresh[k] = part[x:y].tobytes()
            seen.append((distinct, inverse.astype(np.int32), np.searchsorted(begin, rows)))
        self.learn(np.fromiter(fresh, np.uint64, len(fresh)), list(fresh.values()))
        out, per_row = [], []
        for distinct, inverse, rows in seen:
            piece = self.slot[np.searchsorted(self.hash, distinct)][inverse]
            n = self.begin[piece + 1] - self.begin[piece]
            ends = np.append(0, np.cumsum(n))
            out.append(self.ids[np.repeat(self.begin[piece] - ends[:-1], n) + np.arange(ends[-1])])
            per_row.append(np.diff(ends[rows]))
        offs = np.append(0, np.cumsum(np.concatenate(per_row))) if per_row else np.zeros(1)
        values = np.concatenate(out) if out else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values))


def decoded(ids: pa.Array, token: list[bytes]) -> pa.Array:
    """The bytes that each row's ids stand for; none for null."""
    values, sizes = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offs = np.append(0, np.cumsum(sizes))
    return pa.array((b"".join([token[i] for i in values[a:b].tolist()]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())), pa.binary(), size=len(sizes))


_made: dict = {}


def _once(make, *key):
    """One table per worker process and vocabulary."""
    if (make, key) not in _made:
        _made[make, key] = make(*key)
    return _made[make, key]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids (array<int>) of the whole text."""

    @arrow_udf("array<int>")
    def run(col: pa.Array) -> pa.Array:
        return _once(Encoder, path, pattern)(col)

    return df.withColumn(ids, run(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded_to: str = "decoded") -> DataFrame:
    """Add the bytes (binary) that the ids stand for."""

    @arrow_udf("binary")
    def run(col: pa.Array) -> pa.Array:
        return decoded(col, _once(Merges, path).token)

    return df.withColumn(decoded_to, run(F.col(ids)))


def encode_decode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded_to: str = "decoded") -> DataFrame:
    """Replace the text by its token ids and the bytes that these stand for.

    One worker does both, on slices of ``SLICE`` bytes of text, whatever the number of rows
    in an Arrow batch: what it holds and sends back is bounded (a longer text is a slice)."""
    rest = [f for f in df.schema.fields if f.name not in (text, ids, decoded_to)]
    schema = StructType([*rest, StructField(ids, ArrayType(IntegerType())), StructField(decoded_to, BinaryType())])
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(Encoder, path, pattern)
        try:
            yield from made(encoder, batches)
        finally:  # the worker may serve other stages next
            encoder.clear()
            textkit.give_back()

    def made(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(text)
            for a, b in textkit.blocks(textkit.flat(col)[1], SLICE):
                own = encoder(col.slice(a, b - a))
                kept = [batch.column(c).slice(a, b - a) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, own, decoded(own, encoder.merges.token)], schema.names)

    return df.select(*names, text).mapInArrow(run, schema)


def ids_text(ids: str) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")
