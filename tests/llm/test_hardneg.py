import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from scholarmetrics.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(kind, n, rng):
    if kind == "clustered":  # deep trees
        centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
        return [[x + rng.gauss(0, 0.1 ** rng.randint(1, 3)) for x in rng.choice(centres)] for _ in range(n)]
    if kind == "copies":  # a third of all rows are one vector
        one = [rng.gauss(0, 1) for _ in range(6)]
        return [one if rng.random() < 1 / 3 else [rng.gauss(0, 1) for _ in range(6)] for _ in range(n)]
    if kind == "huge":
        return [[rng.gauss(0, 1e12) for _ in range(3)] for _ in range(n)]
    return [[rng.gauss(0, 0.2) for _ in range(12)] for _ in range(n)]


def brute(rows, every=50):
    """The contract, pair by pair in Python integers."""
    kept = [
        (i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in v])
        for i, v, l in rows
        if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for a, la, va in kept:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v)), i, l == la) for i, l, v in kept if i != a))
        for p, pid, _ in [x for x in scored if x[2]][:5]:
            fits = [(s, i) for s, i, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p]
            out.update((a, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits[:3]))
    return out


def as_float32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]


@pytest.mark.parametrize("kind", ["clustered", "copies", "flat", "huge"])
def test_tree_search_is_exact(kind):
    rng = random.Random(kind)
    vecs = np.floor(np.array(vectors(kind, 500, rng)) * 256)
    ids, labels = np.array(rng.sample(range(900), 500)), np.array([rng.randrange(4) for _ in range(500)])
    tree = hardneg.Tree.load(hardneg.Tree.build(ids, labels, vecs, 6).dump())
    # the radii cover: every point below a node is near enough to its point
    def below(node):
        a, b = tree.child[node]
        return [int(tree.point[node])] + [p for c in range(a, b) for p in below(c)]

    spare = np.sqrt(np.maximum(0, tree.norms.max() ** 2 - tree.norms**2))
    x = np.column_stack([tree.points, spare])
    for node in range(0, len(tree.point), 7):
        away = np.sqrt(((x[below(node)] - x[tree.point[node]]) ** 2).sum(1))
        assert away.max() <= tree.radius[node] * (1 + 1e-9) + 1e-6
    assert sorted({p for p in below(0)}) == list(range(len(tree.points)))
    whole = [[int(a) for a in v] for v in vecs]
    for j in range(0, 500, 5):
        scored = sorted((-sum(a * b for a, b in zip(whole[j], w)), int(i), int(l)) for w, i, l in zip(whole, ids, labels) if i != ids[j])
        cut = lambda s: max(-hardneg._MOST, min(hardneg._MOST, s))
        best = -scored[0][0]
        for same, low, high in ((True, None, None), (False, best // 2, best * 95 // 100), (False, best, best // 2)):
            want = [(cut(-s), i) for s, i, l in scored if (l == labels[j]) == same and (low is None or low <= cut(-s) <= high)]
            want = sorted(want, key=lambda x: (-x[0], x[1]))[:5]
            assert tree.search(vecs[j], int(labels[j]), same, 5, int(ids[j]), low, high) == want


def test_most_nodes_are_skipped_where_vectors_cluster():
    rng = random.Random(5)
    vecs = np.floor(np.array(vectors("clustered", 4000, rng)) * 256)
    tree = hardneg.Tree.build(np.arange(4000), np.zeros(4000, int), vecs, 6)
    seen = []
    scores = tree.scores
    tree.scores = lambda q, at: seen.append(len(at)) or scores(q, at)
    for j in range(0, 4000, 100):
        tree.search(vecs[j], 0, True, 5, j)
    assert sum(seen) < 40 * 4000 / 3


def case_rows():
    rng = random.Random(2)
    rows = [(i, v, rng.randrange(3)) for i, v in enumerate(vectors("clustered", 260, rng) + vectors("copies", 140, rng))]
    rows += [(350, None, 1), (351, [], 1), (352, [1.0, None], 1), (353, [float("nan")] * 6, 1), (354, [float("inf")] * 6, 0), (355, [1.0] * 6, None)]
    rows += [(None, [1.0] * 6, 1), (500, [1.0, 2.0], 1), (501, [0.0] * 6, 2), rows[3], rows[3], rows[51]]
    return as_float32(rows)


@pytest.mark.parametrize("slab", [64, hardneg.SLAB])
def test_mining_equals_brute_force(spark, slab):
    rows = case_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"uid": F.lit("clash"), "score": F.lit(1), "vec": F.lit(2)})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hardneg.mine(hardneg.quantized(df, label_of=label), F.col("id") % 50 == 0, slab=slab)
    assert Counter(map(tuple, out.collect())) == brute(rows)


def test_empty_and_single(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert hardneg.mine(hardneg.quantized(df), F.col("id") % 50 == 0).count() == 0


def test_registered_query(spark, tmp_path):
    from scholarmetrics.llm.registry import QUERIES

    rows = case_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert Counter(map(tuple, out.collect())) == brute(rows)
