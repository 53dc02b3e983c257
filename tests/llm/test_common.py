import os

import numpy as np
import pyarrow as pa
from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import checked_join, cut, scratch


def files(df):
    return os.path.exists(df._cut_path.removeprefix("file:"))


def test_scratch_deletes_what_it_does_not_keep(spark):
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            gone = cut(spark.range(3))
            kept = inner.keep(cut(gone.selectExpr("id + 1 id")))
        assert not files(gone) and files(kept)
        top = outer.keep(cut(kept.selectExpr("id * 2 id")))
    assert not files(kept) and sorted(r.id for r in top.collect()) == [2, 4, 6]


def test_joins_beyond_the_limit_shuffle_and_agree(spark):
    big, side = spark.range(100).selectExpr("id % 7 k", "id"), spark.range(5).selectExpr("id k", "id * 10 v")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plans = [checked_join(big, side, "k", how, limit=n) for n in (5, 4)]
        texts = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
        assert "strategy=broadcast" in texts[0] and "strategy=merge" in texts[1]
        assert sorted(map(repr, plans[0].collect())) == sorted(map(repr, plans[1].collect()))


def test_words_and_shingles_of_rows(monkeypatch):
    texts = ["a b  c", None, "", " x\ty ", "A B C", "é é", "ab", "a" * 300 + " b" * 200]
    for piece in (1 << 20, 16):
        monkeypatch.setattr(textkit, "PIECE", piece)
        textkit._powers.clear()
        h, first = textkit.words(*textkit.flat(pa.array(texts)))
        assert np.diff(first).tolist() == [3, 0, 0, 2, 3, 2, 1, 201]
        assert h[0:3].tolist() == h[first[4] : first[4] + 3].tolist()  # folded
        assert len(set(h.tolist())) == len({w for t in texts if t for w in t.lower().split()})
    textkit._powers.clear()
    assert len(textkit.shingle_set(h[first[4] : first[5]])) == 1 and len(textkit.shingle_set(h[:0])) == 0


def test_arrow_batches_are_bounded_unless_the_session_says_otherwise(spark):
    from scholarmetrics.llm import common

    old = spark.conf.get(common._ARROW_CONF, None)
    try:
        spark.conf.unset(common._ARROW_CONF)
        common.cut(spark.range(3))
        assert spark.conf.get(common._ARROW_CONF) == common.ARROW_BYTES
        spark.conf.set(common._ARROW_CONF, "3m")
        common.cut(spark.range(3))
        assert spark.conf.get(common._ARROW_CONF) == "3m"
    finally:
        spark.conf.unset(common._ARROW_CONF) if old is None else spark.conf.set(common._ARROW_CONF, old)
