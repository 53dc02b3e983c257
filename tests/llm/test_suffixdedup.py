import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from scholarmetrics.llm import suffixdedup


def brute(rows, length):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + length] for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def run(df, length, gram):
    out = suffixdedup.dedup(df, length, gram)
    got = out.select("doc_id", F.coalesce(F.size("begins"), F.lit(0)), "kept").collect()
    return sorted(((r[0], r[1], bytes(r[2])) for r in got), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    rows = []
    for i in range(300):
        t = "".join(rng.choices("abc" if i % 3 else "ab é", k=rng.randint(0, 60)))
        if i % 7 == 0:
            t = "ab" * rng.randint(5, 40)
        if i % 11 == 0:
            t = "a" * rng.randint(0, 50)
        if i > 50 and i % 5 == 0:
            t = rows[rng.randint(0, 49)][1] or ""
        rows.append((i if i % 13 else (None if i % 2 else 5), None if i % 29 == 0 else t))
    return rows


@pytest.mark.parametrize(("length", "gram", "hot"), [(8, 3, 1000), (20, 8, 1000), (8, 3, 3), (20, 8, 3)])
def test_every_path_equals_brute_force(spark, texts, monkeypatch, length, gram, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "BLOCK", 500)
    monkeypatch.setattr(suffixdedup, "LONGEST", 16)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert run(df, length, gram) == brute(texts, length)


def test_production_parameters_on_all_cases(docs, rows):
    assert run(docs, suffixdedup.LENGTH, suffixdedup.GRAM) == brute([(d, t) for d, t, *_ in rows], suffixdedup.LENGTH)


def test_depth_classes_are_the_suffix_order():
    rng = np.random.default_rng(1)
    for length in (1, 5, 8, 13, 40):
        u8 = rng.integers(97, 99, 300).astype(np.uint8)
        key = [bytes(u8[i : i + length]) for i in range(300)]
        rank = suffixdedup.depth_classes(u8, length)
        order = {k: i for i, k in enumerate(sorted(set(key)))}
        assert [order[k] for k in key] == rank.tolist()


def test_a_block_is_sorted_in_little_memory():
    size, length = 300, suffixdedup.LENGTH
    u8 = np.random.default_rng(2).integers(97, 123, suffixdedup.BLOCK // size * size).astype(np.uint8)
    u8[-size:] = u8[:size]
    begins = np.arange(0, len(u8), size)
    tracemalloc.start()
    try:
        hit = suffixdedup.repeated_windows(u8, begins, np.full(len(begins), size - length + 1), length)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert hit.reshape(len(begins), -1).any(axis=1).nonzero()[0].tolist() == [0, len(begins) - 1]
    assert peak < 32 << 20


def test_anchors_of_many_bytes_are_not_sorted_in_one_task(spark, texts, monkeypatch):
    sorted_spans, widest = suffixdedup._sorted_spans, []

    def watched(contexts, length):
        widest.append(contexts.groupBy("a").agg(F.sum(F.length("body")).alias("size")).agg(F.max("size")).first()[0])
        return sorted_spans(contexts, length)

    monkeypatch.setattr(suffixdedup, "_sorted_spans", watched)
    monkeypatch.setattr(suffixdedup, "LONGEST", 16)
    monkeypatch.setattr(suffixdedup, "HOT_BYTES", 100, raising=False)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert run(df, 8, 3) == brute(texts, 8)
    assert 0 < widest[0] <= 100


def test_empty(empty):
    assert suffixdedup.dedup(empty).count() == 0
