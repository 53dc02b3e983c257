import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from scholarmetrics.llm import sharding


def best(sizes, shards):
    """Least capacity, by trying every one."""
    c = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        n, room = 1, c
        for s in sizes:
            if s > room:
                n, room = n + 1, c
            room -= s
        if n <= shards:
            return c
        c += 1


@pytest.mark.parametrize("hot", [0, 60])
def test_shards_are_minimax(spark, hot):
    rng = random.Random(hot)
    rows = [(i, "t" * rng.randint(0, 50) + str(i % 70)) for i in range(150)] + [(1000 + i, "hot" * 9) for i in range(hot)]
    rows += [(5000, None), (5001, ""), (5001, ""), (None, "no id")]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))).collect()
    assert len(out) == len(rows)
    of, slots, total, digest = defaultdict(set), defaultdict(list), defaultdict(int), {}
    for r in out:
        body = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        of[r.text].add(r.shard)
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(8))
    import hashlib

    groups = defaultdict(int)
    for r in out:
        groups[b"" if r.text is None else hashlib.sha256(r.text.encode()).digest()] += r["size"]
    assert max(total.values()) <= best([groups[k] for k in sorted(groups)], 8)


def test_fewer_groups_than_shards_and_empty(spark, empty, docs):
    out = sharding.shard(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")).collect()
    assert {r.shard for r in out} == {0} and sorted(r.slot for r in out) == [0, 1]
    assert sharding.shard(empty).count() == 0
    assert sharding.shard(docs).count() == docs.count()


def test_plan_has_no_python(spark, docs):
    plan = sharding.shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
