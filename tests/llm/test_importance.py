import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from scholarmetrics.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, orders=2):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, orders + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for x in texts for f in runs(x)[1]) for texts in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    out = []
    for i, text in docs:
        words, feats = runs(text)
        weight = sum(gain(bucket(f)) for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = {}
    for k, r in enumerate(able[: percent * len(able) // 100]):
        drawn.setdefault(tuple(r), []).append(k + 1)
    return Counter((r[0], r[2], r[3], r[4], drawn[tuple(r)].pop(0) if drawn.get(tuple(r)) else None) for r in out)


def test_crc_of_any_run_from_two_prefixes():
    rng = random.Random(1)
    move = importance.shift()
    data = bytes(rng.randrange(256) for _ in range(20000))
    a = np.array([rng.randrange(20000) for _ in range(500)])
    b = np.array([min(20000, x + rng.choice([0, 1, 5, 63, 64, 65, 1000, 15000])) for x in a.tolist()])
    before, after = (np.array([zlib.crc32(data[:x]) for x in y.tolist()], np.uint32) for y in (a, b))
    want = [zlib.crc32(data[x:y]) for x, y in zip(a.tolist(), b.tolist())]
    assert (after ^ move(before, b - a)).tolist() == want


@pytest.mark.parametrize("orders", [1, 2, 4])
@pytest.mark.parametrize("block", [64, importance.BLOCK])
def test_features_of_every_row(rows, orders, block, monkeypatch):
    """Also where a row, or one word, is longer than a block."""
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = [r[1] for r in rows if r[0] != 905] + ["w" * 500 + " a b " + "ÄÖ" * 90, "x " * 300, "the the the", "A-B_c1"]
    scan = importance.Scan(pa.array(texts), orders)
    got = [Counter() for _ in texts]
    for row, crc in scan.features():
        for i, c in zip(row.tolist(), crc.tolist()):
            got[i][c] += 1
    assert got == [Counter(zlib.crc32(f.encode()) for f in runs(t, orders)[1]) for t in texts]
    assert scan.n_words.tolist() == [len(runs(t)[0]) for t in texts]


@pytest.mark.parametrize("target", [["alpha beta mit license", "", None, "Alpha the"], []])
def test_resampling_equals_brute_force(spark, rows, docs, target):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    more = docs.withColumns({"weight": F.lit("clash"), "rank": F.lit(1), "score": F.lit(None).cast("string")})
    got = importance.resample(more, bench).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == brute([(r[0], r[1]) for r in rows], target)


def test_weigh_keeps_other_columns(docs):
    out = importance.weigh(docs, np.arange(100))
    assert set(out.columns) == {*docs.columns, "n_features", "weight"} and out.schema["n_words"].dataType.simpleString() == "bigint"


def test_ranks_of_many_equal_scores(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(30).alias("n_words"), (F.col("id") % 3 * 5000).alias("score"))
    got = {r.doc_id: r["rank"] for r in importance.draw(df, 50).collect()}
    order = sorted(range(1000), key=lambda i: (-(i % 3), i))
    assert {i: k + 1 for k, i in enumerate(order[:500])} == {i: k for i, k in got.items() if k is not None} and len(got) == 1000


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(empty, bench).count() == 0


def test_registered_query(spark, rows, docs, tmp_path):
    from scholarmetrics.llm.registry import QUERIES

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "mit license under")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = QUERIES["op13_importance_resampling"](spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, out.collect())) == brute([(r[0], r[1]) for r in rows], ["mit license under"])
