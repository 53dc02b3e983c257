"""Texts that polynomial hashes modulo a power of two cannot tell apart."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from scholarmetrics.llm import bpe, langid, neardup, quality, suffixdedup, textkit


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


TWINS = thue_morse(1024), thue_morse(1024, "b", "a")


def test_hashes_depend_on_the_bytes_alone():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(1, 30))) for _ in range(4000)] + [t.encode() for t in TWINS]
    data = b"".join(texts)
    end = np.cumsum([len(t) for t in texts])
    begin = end - [len(t) for t in texts]
    got = textkit.span_hashes(np.frombuffer(data, np.uint8), begin, end).tolist()
    assert len(set(zip(texts, got))) == len(set(texts)) == len(set(got))


def test_bpe_of_twin_words():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert bpe.Encoder(path, P.PATTERN)(pa.array(TWINS)).to_pylist() == [own.encode_ordinary(t) for t in TWINS]


def test_quality_of_twin_words(spark):
    text = f"x y {TWINS[0]} x y {TWINS[1]}"
    (row,) = quality.add_stats(spark.createDataFrame([(1, text, "en", "a")], "doc_id long, text string, lang string, source string")).collect()
    assert row.n_repeat_words == 0


def test_near_duplicates_of_twin_words(spark):
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{TWINS[0]} {rest}"), (2, f"{rest[:3]}{TWINS[1]} {rest[3:]}"), (3, " ".join([TWINS[0]] * 9)), (4, " ".join([TWINS[1]] * 9))]
    out = neardup.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id for r in out)


def test_language_of_twin_words_is_looked_up_apart():
    u8, off = textkit.flat(pa.array(TWINS))
    s, e, _ = langid.find_words(u8, off)
    h = textkit.span_hashes(u8, s, e)
    words = [u8[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist())]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))


@pytest.mark.parametrize("order", [(0, 1), (1, 0, 0)])
def test_suffix_dedup_of_twin_words(spark, order):
    texts = [f"{i}{TWINS[k]}{i}" for i, k in enumerate(order)]
    seen = {}
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    want = {}
    for i, t in enumerate(texts):
        gone = set()
        for j in range(len(t) - 199):
            if seen[t[j : j + 200]] > 1:
                gone.update(range(j, j + 200))
        want[i] = hashlib.sha256("".join(c for j, c in enumerate(t) if j not in gone).encode()).hexdigest()
    out = suffixdedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in out} == want
