"""Each stage against brute force on its own input, and the whole on a small folder."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from scholarmetrics.llm import quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmn", k=rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, item = prose(80), prose(30)
    texts = [prose(rng.randint(60, 150)) for _ in range(300)]
    texts += [t + " end" for t in texts[:20]] + texts[20:30]
    texts += [f"{prose(100)} {passage} {prose(100)}" for _ in range(5)]
    texts += [f"{prose(80)} {item} {prose(80)}"]
    texts += [prose(80).replace(" ", " $$$ ") for _ in range(5)] + ["short one", "", None]
    rows = [(i, t, rng.choice(["en", "fr", None]), "src", len(t or ""), "carried") for i, t in enumerate(texts)]
    rows.append((5, texts[5], "en", "src", 7, "repeated row"))
    d = str(tmp_path_factory.mktemp("data"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(20))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, passage, item


def test_stages_take_effect_and_keep_the_columns(spark, folder):
    d, passage, item = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    before = docs
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, d)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        after = after.cache()
        gone = sorted(set(ids(before)) - set(ids(after)))
        if name == "quality":
            failed = quality.add_stats(before).where("base_failed").select("doc_id").collect()
            assert gone == sorted({*range(336, 341), *(r.doc_id for r in failed)})
        if name == "near_dedup":
            assert gone == list(range(300, 330)) and len(ids(after)) == len(set(ids(after)))
        if name == "suffix_dedup":
            assert gone == [] and ids(after) == ids(before)
            left = after.where("doc_id BETWEEN 330 AND 334").collect()
            assert all(passage[5:-5] not in r.text and r.n_chars == len(r.text) and r.kept == "carried" for r in left)
            assert after.where("doc_id < 300").exceptAll(before.where("doc_id < 300")).count() == 0
        if name == "decontaminate":
            assert gone == [335]
        before = after
    out = corpus_pipeline.STAGES[-1][1](spark, before, d)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect())


def test_run_equals_the_stages(spark, folder):
    d = folder[0]
    out = corpus_pipeline.run(spark, d)
    # the 300 texts and the 5 with the passage; copies, junk, short texts and the item's text went
    assert out.count() == 300 + 5 and out.where("n_tokens <> size(ids)").count() == 0


def test_empty_and_null_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    d = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, schema)
    for docs in (spark.createDataFrame([], schema), nulls):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, d).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, d).count() == docs.count()
