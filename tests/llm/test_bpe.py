import base64
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from scholarmetrics.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library_on_random_texts(reference):
    rng = random.Random(1)
    parts = ["a", "b", "'", "s", "re", " ", "  ", "\n", "\t", "1", "22", "é", "!", "''", "'ll", " 's", "日本", " ", " ", "😀", "aaaa", "'S", "abab", "\x1c", "\x85"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(5000)]
    texts += ["a" * 5000, "ab" * 3000, "", None, "'", " '", "x's y's 'stuff", " " * 300, "\n\n\n a"]
    got = bpe.Encoder(PATH, P.PATTERN)(pa.array(texts)).to_pylist()
    assert got == [reference.encode_ordinary(t or "") for t in texts]


def test_classes_equal_the_library_on_every_character(reference):
    texts = ["a" + chr(c) + "a1" + chr(c) * 2 + " b" for c in [*range(0xD800), *range(0xE000, 0x110000)] if c % 7 == 3]
    got = bpe.Encoder(PATH, P.PATTERN)(pa.array(texts)).to_pylist()
    assert got == [reference.encode_ordinary(t) for t in texts]


def test_other_patterns_and_forgotten_pieces(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 100)
    e = bpe.Encoder(PATH, r"\p{L}+|\P{L}+")
    for text in ("one two, trés", "three four", "one two"):
        ids = e(pa.array([text])).to_pylist()[0]
        assert b"".join(e.merges.token[i] for i in ids).decode() == text


def test_ranks_that_are_out_of_order_are_replayed_alone(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"bcd", b"ab"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    own = tiktoken.Encoding("odd", pat_str=r"[\s\S]+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = ["abc", "abcd", "bcdabc", "abab", "abcabcbcd", "dcba"]
    assert bpe.Encoder(str(path), r"[\s\S]+")(pa.array(texts)).to_pylist() == [own.encode_ordinary(t) for t in texts]


def test_round_trip_on_all_cases(docs, rows, empty, reference):
    out = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH)
    assert "kept" in out.columns
    got = sorted(((r.text or "", tuple(r.ids), bytes(r.decoded)) for r in out.collect()))
    want = sorted((t or "", tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for _, t, *_ in rows)
    assert got == want
    assert bpe.encode(empty, PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("size", [2000, bpe.SLICE])
def test_both_in_one_pass_equal_the_two(spark, docs, rows, empty, reference, monkeypatch, size):
    monkeypatch.setattr(bpe, "SLICE", size)
    more = docs.withColumns({"ids": docs.doc_id, "decoded": docs.text})
    out = bpe.encode_decode(more, PATH, P.PATTERN)
    assert set(out.columns) == {*docs.columns, "ids", "decoded"} - {"text"}
    got = sorted((r.doc_id is not None, r.doc_id or 0, tuple(r.ids), bytes(r.decoded)) for r in out.collect())
    want = sorted((i is not None, i or 0, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in rows)
    assert got == want
    assert bpe.encode_decode(empty, PATH, P.PATTERN).count() == 0


def test_registered_query(spark, docs, rows, reference, tmp_path):
    import hashlib

    from scholarmetrics.llm.registry import QUERIES

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op1_byte_bpe"](spark, str(tmp_path)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted((tuple(r) for r in out), key=order) == sorted(want, key=order)
