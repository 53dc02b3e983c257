import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from scholarmetrics.llm import perplexity as lm

SF = "/root/testdata/sf0.01"


def test_noise_goes_and_prose_stays(spark, docs, empty):
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choice(["the", "then", "other", "there", "that"]) for _ in range(60))
    rows = [(i, prose() if i % 8 else "".join(rng.choices("xqzj#%&|", k=300)), ["en", "fr", None][i % 3]) for i in range(1200)]
    rows += [(5000, None, "en"), (5001, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1200) if i % 8 and i % 2] + [(1, 1, 0), (2, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in lm.classify(df, labels).collect()}
    assert len(out) == len(rows)
    good = [out[i].kept for i, *_ in rows if i < 5000 and i % 8]
    assert sum(good) >= 0.99 * len(good)
    assert not any(out[i].kept for i, *_ in rows if i >= 5000 or not i % 8)
    assert lm.classify(df, labels.limit(0)).where("kept").count() == 1200  # nothing learned: uniform
    assert lm.classify(empty, labels).count() == 0


def characters_brute(trusted, vocabulary):
    """The same model over characters, written out with dictionaries."""
    grams = Counter()
    for t in trusted:
        s = "\n" * (lm.DEPTH - 1) + t
        grams.update(s[i : i + lm.DEPTH] for i in range(len(t)))
    counts = {lm.DEPTH: grams}
    for n in range(lm.DEPTH - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts, totals, freed = {}, {}, {}
    for n, c in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in c.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d = [min(k, max(0.0, k - (k + 1) * y * b / a)) if a else 0.0 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discounts[n] = [x or 0.1 for x in d]
        totals[n], freed[n] = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            totals[n][g[:-1]] += v
            freed[n][g[:-1]] += discounts[n][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / vocabulary
        n, h = len(g), g[:-1]
        if not totals[n][h]:
            return p(g[1:])
        v = counts[n][g]
        own = (v - discounts[n][min(v, 3) - 1]) / totals[n][h] if v else 0.0
        return own + freed[n][h] / totals[n][h] * p(g[1:])

    return p


def test_character_model_equals_brute_force(spark, docs, rows, empty, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 5000)  # many blocks, also of one long text
    good = [i for i, *_ in rows if i is not None and i % 2 == 0]
    labels = spark.createDataFrame([(i, 1, 0) for i in set(good)], "doc_id long, quality int, toxic int")
    out = lm.classify(docs.withColumn("body", F.col("text")), labels).collect()
    assert len(out) == len(rows)
    texts = [t or "" for _, t, *_ in rows]
    assert Counter(r.trusted for r in out)[True] == sum(i in set(good) for i, *_ in rows)
    assert any(r.held_out for r in out) and all(r.trusted for r in out if r.held_out)
    p = characters_brute([r.body or "" for r in out if r.trusted and not r.held_out], len(set("".join(texts))))
    for r in out:
        body = r.body or ""
        assert r.n_symbols == len(body)
        if body and len(body) < 3000:
            s = "\n" * (lm.DEPTH - 1) + body
            want = math.exp(-sum(math.log(p(s[i : i + lm.DEPTH])) for i in range(len(body))) / len(body))
            assert math.isclose(r.perplexity, want, rel_tol=1e-4)


def test_wrong_characters_of_one_byte_class_are_noise(spark):
    """Texts outside ASCII whose bytes fall into the classes of the trusted ones."""
    rng = random.Random(4)
    some = [chr(0x4E00 + i) for i in range(0, 4000, 100)]
    other = [chr(ord(c) + 1) for c in some]
    words = ["".join(rng.choices(some, k=3)) for _ in range(12)]
    rows = [(i, "".join(rng.choices(words, k=80)) if i % 8 else "".join(rng.choices(other, k=240)), "ja") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400) if i % 8], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in lm.classify(df, labels).collect()}
    assert all(out[i].kept == bool(i % 8) for i in range(400))


def test_many_characters_are_numbered_symbol_by_symbol():
    rng = random.Random(8)
    texts = ["".join(chr(0x3400 + rng.randrange(20000)) for _ in range(3000)) for _ in range(5)] + ["", "\0\0ab\0"]
    grams, gram, doc, count = lm._runs(texts)
    got = Counter({(grams[g], d): c for g, d, c in zip(gram.tolist(), doc.tolist(), count.tolist())})
    want = Counter()
    for d, t in enumerate(texts):
        s = "\n" * (lm.DEPTH - 1) + t
        want.update((s[i : i + lm.DEPTH], d) for i in range(len(t)))
    assert got == want


def test_places_come_back():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 40, 300)
    edge = np.append(0, np.cumsum(size))
    doc = np.concatenate([np.sort(rng.choice(200_000 if k > 20 else 300, k, replace=False)) for k in size])
    count = rng.choice([1, 1, 1, 2, 3, 4, 5, 8, 9, 1000], len(doc))
    packed = lm._packed(doc, count, edge)
    row, at, c = lm._unpacked(*lm.textkit.flat(packed))
    got = Counter()
    for r, d, n in zip(row.tolist(), at.tolist(), c.tolist()):
        got[r, d] += n
    want = {(r, int(doc[i])): int(count[i]) for r in range(len(size)) for i in range(edge[r], edge[r + 1])}
    assert got == want
    empty = lm._packed(np.zeros(0, int), np.zeros(0, int), np.zeros(1, int))
    assert len(empty) == 0 and not len(lm._unpacked(*lm.textkit.flat(empty))[0])
    one = lm._unpacked(*lm.textkit.flat(pa.array([packed[7].as_py()])))
    assert one[1].tolist() == at[row == 7].tolist()


def test_unseen_good_documents_are_kept(spark):
    """Good labels split in two halves: the unlabelled half is judged by the other one."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in lm.good_ids(labels).collect()}
    seen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    used = {r.doc_id for r in seen.collect()}
    kept = {r.doc_id: r.kept for r in lm.classify(documents, seen).select("doc_id", "kept").collect()}
    unseen = [kept[i] for i in good - used]
    assert len(unseen) > 100 and sum(unseen) >= 0.95 * len(unseen)


def bytes_in(*folders):
    return sum(os.path.getsize(os.path.join(at, f)) for d in folders for at, _, files in os.walk(d) for f in files)


def test_no_place_of_an_n_gram_is_written(spark, tmp_path):
    """Disk grows with the text and the blocks' distinct n-grams, not with their places."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(300)]
    spark.createDataFrame([(i, " ".join(rng.choices(words, k=500)), "en") for i in range(2000)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").coalesce(1)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2000) if i % 3], "doc_id long, quality int, toxic int")
    lm.score_characters(docs.limit(1).withColumn("__train", F.lit(True))).collect()  # folders exist
    jvm = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(d) for d in jvm.localDirs()] + [os.path.dirname(spark.sparkContext.getCheckpointDir().removeprefix("file:"))]
    before = bytes_in(*folders)
    flagged = docs.join(labels, "doc_id", "left").withColumn("__train", F.col("quality").isNotNull()).drop("quality", "toxic")
    scored = lm.score_characters(flagged)
    assert scored.where("perplexity > 1").count() == 2000
    used = bytes_in(*folders) - before
    assert used < 1.5 * bytes_in(f"{tmp_path}/docs") + 4e6  # and the tables of n-grams, whatever the number of documents


def test_a_text_is_shuffled_by_no_step_after_it_is_dealt(spark, tmp_path):
    spark.createDataFrame([(i, f"some text {i} " * 9, bool(i % 2)) for i in range(60)], "doc_id long, text string, __train boolean").write.parquet(f"{tmp_path}/docs")
    docs = lm.cut_by(lm.dealt(spark.read.parquet(f"{tmp_path}/docs")), "__block", 8)
    rows = lm.lists(docs, 4)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    known = spark.createDataFrame([], "__block long, cell int, lls binary")
    exchanges = [x for x in lm.sums(docs, known, 4)._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert len(exchanges) == 1


def test_lists_come_back_in_their_order(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab é日😀\0", k=rng.randint(1, 80))) for _ in range(40)] + ["", None, "x"]
    docs = spark.createDataFrame([(i % 5, t, i % 2 == 0) for i, t in enumerate(texts)], "__block long, text string, __train boolean")
    rows = lm.cut(lm.lists(docs, 7))
    got = Counter()
    for r in rows.collect():
        assert r.codes == sorted(set(r.codes)) and all(c == r.cell for c in lm._cell(r.codes, 7).tolist())
        got.update({(r["__block"], g): c for g, c in zip(r.codes, r.cs)})
    grams = {g for _, g in got}
    number = {g: i for i, g in enumerate(sorted(grams))}
    log = spark.createDataFrame([(g, -i) for g, i in number.items()], "code string, ll long")
    back = lm.looked_up(rows, log, 7).collect()
    want = {(r["__block"], r.cell): [-number[g] for g in r.codes] for r in rows.collect()}
    assert {(r["__block"], r.cell): np.frombuffer(r.lls, "<i4").tolist() for r in back} == want
    trained = Counter()
    for i, t in enumerate(texts):
        s = "\n" * (lm.DEPTH - 1) + (t or "")
        trained.update({(i % 5, s[k : k + lm.DEPTH]): 0 for k in range(len(t or ""))})
        trained.update((i % 5, s[k : k + lm.DEPTH]) for k in range(len(t or "")) if i % 2 == 0)
    assert got == trained and set(got) == set(trained)
