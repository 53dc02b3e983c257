"""Operator 5: language of a text by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word forwards and backwards (one GRU each), labels
every position, and a document's probabilities are the mean over all its positions.
States begin anew at each word (a run of ASCII letters and non-ASCII bytes, folded to
lower case), so a word's labels depend on the word alone: each task runs the network once
per distinct word and weighs it by its places, over whole texts.  Runs over ``LONGEST``
bytes (scripts without blanks) are labelled in windows that overlap: pieces of whole
characters, each read with up to ``LONGEST`` bytes of the run on either side.

It is trained in numpy by backpropagation through time on a bounded sample: of each
language, however many there are, about ``SAMPLE_DOCS`` documents, chosen by a hash of
their id, and up to ``SAMPLE_WORDS`` distinct words of each.  The output layer has one
class per language.  The seed and the sample's order are fixed.

Cases: a null text or one without a letter is ``und`` with score 0; rows without a
language are predicted but not learned from; repeated rows get equal predictions;
without labelled rows all are ``und``; equal probabilities give the first language in
alphabetical order; an empty table gives an empty table; input columns named like an
output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import checked_join, cut

SAMPLE_DOCS, SAMPLE_WORDS = 300, 60
LONGEST, HIDDEN, STEPS, BATCH, RATE = 24, 16, 500, 384, 0.02
#: Distinct words that a worker keeps between batches; with more than ``WIDE`` languages
#: tables and blocks of text are smaller by as much.
KEPT_WORDS, WIDE = 1_000_000, 64

_IN_WORD = np.zeros(256, bool)
_IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Forward pass, gradients and training; parameters are plain float32 arrays."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.hidden = hidden
        self.p = {"out": normal(2 * hidden, classes), "bias": np.zeros(classes, np.float32)}
        for way in ("f", "b"):
            # per gate (update, reset, candidate): byte embedding, recurrent weights
            self.p |= {f"e{way}": normal(256, 3 * hidden), f"u{way}": normal(hidden, 3 * hidden)}

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, trace: list | None = None) -> np.ndarray:
        """States (time, row, hidden) of one direction; masked steps keep the state."""
        n, t = x.shape
        h, k = np.zeros((n, self.hidden), np.float32), self.hidden
        e, u = self.p[f"e{way}"], self.p[f"u{way}"]
        out = np.zeros((t, n, k), np.float32)
        for i in range(t) if way == "f" else range(t - 1, -1, -1):
            a = e[x[:, i]]
            zr = _sigmoid(a[:, : 2 * k] + h @ u[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            c = np.tanh(a[:, 2 * k :] + (r * h) @ u[:, 2 * k :])
            m = mask[:, i : i + 1]
            new = h + m * z * (c - h)
            if trace is not None:
                trace.append((i, h, z, r, c, m))
            h = out[i] = new
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(time, row, class) label probabilities of every position."""
        states = np.concatenate([self.run(x, mask, "f"), self.run(x, mask, "b")], axis=2)
        y = states @ self.p["out"] + self.p["bias"]
        y = np.exp(y - y.max(axis=2, keepdims=True))
        return y / y.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over positions and its gradients, back through time."""
        k, traces = self.hidden, {"f": [], "b": []}
        states = np.concatenate([self.run(x, mask, w, traces[w]) for w in ("f", "b")], axis=2)
        y = states @ self.p["out"] + self.p["bias"]
        y = np.exp(y - y.max(axis=2, keepdims=True))
        y /= y.sum(axis=2, keepdims=True)
        w = (mask.T * weight[None, :]).astype(np.float32)
        w /= w.sum()
        loss = -float((w * np.log(y[:, np.arange(len(label)), label] + 1e-9)).sum())
        y[:, np.arange(len(label)), label] -= 1
        dy = y * w[:, :, None]
        g = {"out": np.einsum("tnh,tnc->hc", states, dy), "bias": dy.sum((0, 1))}
        ds = dy @ self.p["out"].T
        for way, at in (("f", 0), ("b", k)):
            u = self.p[f"u{way}"]
            de, du, dh = np.zeros_like(self.p[f"e{way}"]), np.zeros_like(u), np.zeros((len(x), k), np.float32)
            for i, h, z, r, c, m in reversed(traces[way]):
                d = dh + ds[i, :, at : at + k]
                dc = d * m * z * (1 - c * c)
                dz = d * m * (c - h) * z * (1 - z)
                drh = dc @ u[:, 2 * k :].T
                dr = drh * h * r * (1 - r)
                gate = np.concatenate([dz, dr, dc], axis=1)
                np.add.at(de, x[:, i], gate)
                du[:, : 2 * k] += h.T @ gate[:, : 2 * k]
                du[:, 2 * k :] += (r * h).T @ dc
                dh = d * (1 - m * z) + drh * r + gate[:, : 2 * k] @ u[:, : 2 * k].T
            g[f"e{way}"], g[f"u{way}"] = de, du
        return loss, g

    def train(self, words: list[bytes], label: np.ndarray, steps: int = STEPS, seed: int = 2) -> None:
        """Adam on random batches; languages weigh the same whatever their share."""
        rng = np.random.default_rng(seed)
        weight = (1 / np.bincount(label))[label]
        x, mask = padded(words)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(words), min(BATCH, len(words)))
            _, g = self.gradients(x[rows], mask[rows], label[rows], weight[rows])
            rate = RATE * (1 - step / (steps + 1))
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each word in a row, and which of them belong to it."""
    t = max(map(len, words), default=1)
    x = np.frombuffer(b"".join(w.ljust(t, b"\0") for w in words), np.uint8).reshape(-1, t)
    mask = (np.arange(t) < np.array([len(w) for w in words])[:, None]).astype(np.float32)
    return x, mask


def find_words(u8: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words (pieces of long ones) of the rows, the index of each row's
    first."""
    return find_windows(u8, off)[:3]


def find_windows(u8: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words (pieces of long ones) of the rows, the index of each row's
    first, and begin and end of what is read with each: the word, or a piece's window."""
    inside = _IN_WORD[u8]
    fresh = np.zeros(len(u8) + 1, bool)
    fresh[off] = True
    s = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | fresh[:-1])) if len(u8) else np.zeros(0, np.int64)
    e = np.flatnonzero(inside & (np.append(~inside[1:], True) | fresh[1:])) + 1 if len(u8) else np.zeros(0, np.int64)
    parts = -(-(e - s) // LONGEST)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.repeat(s, parts), np.repeat(e, parts)
    s = low + k * LONGEST
    for _ in range(3):  # no cut inside a character
        s -= (k > 0) & (u8[s] & 0xC0 == 0x80)
    e, last = np.append(s, 0)[1:], np.cumsum(parts) - 1
    e[last] = high[last]
    return s, e, np.searchsorted(s, off), _whole(u8, s - LONGEST, low, high), _whole(u8, e + LONGEST, low, high)


def _whole(u8: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``at`` within ``low`` and ``high``, moved back to where a character begins."""
    at = np.clip(at, low, high)
    for _ in range(3):
        inner = (low < at) & (at < high)
        at[inner] -= u8[at[inner]] & 0xC0 == 0x80
    return at


class Labeller:
    """A worker's network and its table of label sums by distinct word."""

    def __init__(self, net: Network):
        self.net = net
        #: What tables of words are to be divided by.
        self.wide = max(1.0, len(net.p["bias"]) / WIDE)
        self.clear()

    def clear(self) -> None:
        self.hash, self.sums = np.zeros(0, np.uint64), np.zeros((0, len(self.net.p["bias"])), np.float32)

    def learn(self, hashes: np.ndarray, words: list[bytes], lead: np.ndarray, inner: np.ndarray) -> None:
        """Run the network over new words, by length; the labels of the ``inner`` bytes after
        the first ``lead`` of each are summed."""
        sums = np.zeros((len(words), self.sums.shape[1]), np.float32)
        size = np.array([len(w) for w in words])
        for t in np.unique(size).tolist():
            at = np.flatnonzero(size == t)
            rows = max(1, int(4096 / self.wide * min(1, LONGEST / t)))
            for i in range(0, len(at), rows):
                part = at[i : i + rows]
                x, mask = padded([words[j] for j in part])
                place = np.arange(t)[:, None] - lead[part]
                own = ((place >= 0) & (place < inner[part]))[:, :, None]
                sums[part] = self.net.probabilities(x, mask).sum(0, where=own)
        every = np.concatenate([self.hash, hashes])
        order = np.argsort(every)
        self.hash, self.sums = every[order], np.concatenate([self.sums, sums])[order]

    def __call__(self, u8: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean label probabilities of each row; not a number without words."""
        if len(self.hash) > KEPT_WORDS / self.wide:
            self.clear()
        u8 = _FOLD[u8]
        s, e, first, low, high = find_windows(u8, off)
        h = textkit.span_hashes(u8, low, high)
        cut = (low < s) | (e < high)
        h[cut] = textkit.mix(h[cut] ^ textkit.mix(((s - low) * 4 * LONGEST + e - s).astype(np.uint64)[cut]))
        distinct, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, distinct)
        new = (np.append(self.hash, np.uint64(0))[at] != distinct) | (at == len(self.hash))
        if new.any():
            fresh = where[new]
            self.learn(distinct[new], [u8[low[i] : high[i]].tobytes() for i in fresh.tolist()], (s - low)[fresh], (e - s)[fresh])
        mine = self.sums[np.searchsorted(self.hash, distinct)]
        out = np.zeros((len(off) - 1, mine.shape[1]))
        # one column at a time: sums over the words of each row
        for c in range(mine.shape[1]):
            total = np.append(0.0, np.cumsum(mine[:, c].astype(np.float64)[inverse]))
            out[:, c] = np.diff(total[first])
        places = np.append(0, np.cumsum(e - s))
        n = np.diff(places[first])
        return np.where(n[:, None] > 0, out / np.maximum(n, 1)[:, None], np.nan)


def sample(labelled: DataFrame, text: str, lang: str, row_id: str) -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, and the words and labels of the bounded training sample."""
    counts = cut(labelled.groupBy(lang).agg(F.count("*").alias("__n")))
    # a row is drawn with the chance that gives its language about SAMPLE_DOCS of them
    place = (F.xxhash64(F.col(row_id), F.lit(17)) / 2.0**64) + 0.5
    chosen = checked_join(labelled, counts, lang).where(place <= F.least(F.lit(1.0), SAMPLE_DOCS / F.col("__n")))

    @arrow_udf("array<binary>")
    def some(col: pa.Array) -> pa.Array:
        out = []
        for t in col.to_pylist():
            u8, off = textkit.flat(pa.array([t], pa.string()))
            u8 = _FOLD[u8]
            s, e, _ = find_words(u8, off)
            words = sorted({u8[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist())})
            out.append(words[:: max(1, -(-len(words) // SAMPLE_WORDS))])
        return pa.array(out, pa.list_(pa.binary()))

    # the draw is about SAMPLE_DOCS a language; the limit holds if ids repeat
    nth = F.row_number().over(Window.partitionBy(lang).orderBy("o", text))
    chosen = chosen.select(lang, text, F.xxhash64(row_id).alias("o")).withColumn("nth", nth).where(F.col("nth") <= 2 * SAMPLE_DOCS)
    taken = chosen.select(lang, some(F.col(text)).alias("w"), "o").orderBy("o", lang).collect()
    langs = sorted({r[0] for r in taken if r.w})
    words = [bytes(w) for r in taken for w in r.w or ()]
    number = {x: i for i, x in enumerate(langs)}
    label = np.array([number[r[0]] for r in taken for _ in r.w or ()], np.int64)
    return langs, words, label


_made: dict = {}


def predict(df: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "doc_id") -> DataFrame:
    """Add ``lang_pred`` and ``score`` from a network that is trained on ``labelled``."""
    langs, words, label = sample(labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()), text, lang, row_id)
    net = Network(max(1, len(langs)))
    if words:
        net.train(words, label)
    key = (tuple(langs), float(net.p["out"].sum()))
    shared = df.sparkSession.sparkContext.broadcast(net.p)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @arrow_udf("struct<lang:string,score:double>")
    def run(col: pa.Array) -> pa.Array:
        if key not in _made:
            mine = Network(max(1, len(langs)))
            mine.p = shared.value
            _made.clear()
            _made[key] = Labeller(mine)
        u8, off = textkit.flat(col)
        names, scores = [], []
        for a, b in textkit.blocks(off, int(2 * textkit.PIECE / _made[key].wide)):
            part, local = u8[off[a] : off[b]], off[a : b + 1] - off[a]
            for i, p in enumerate(_made[key](part, local)):
                body = part[local[i] : local[i + 1]]
                known = bool(langs) and not np.isnan(p[0])
                if known and not ((body < 128) & _IN_WORD[body]).any():  # no ASCII letter: is there another?
                    known = any(c.isalpha() for c in body.tobytes().decode())
                best = int(np.round(p, 9).argmax()) if known else 0
                names.append(langs[best] if known else "und")
                scores.append(float(min(1.0, p[best])) if known else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    return df.withColumn("__lang", run(F.col(text))).withColumns({"lang_pred": F.col("__lang.lang"), "score": F.col("__lang.score")}).drop("__lang")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from documents whose crc32 of the id
    modulo 5 is not 0 (a null id counts as held out)."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    docs = docs.select("doc_id", "text", "lang", held.alias("held_out"))
    return predict(docs.drop("lang"), docs.where("NOT held_out")).drop("text")
