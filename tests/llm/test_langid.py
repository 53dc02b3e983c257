import random

import numpy as np
from pyspark.sql import functions as F
from scholarmetrics.llm import langid

SYLLABLES = {"en": ["th", "ing", "er", "and", "wh"], "de": ["sch", "ung", "ich", "ä", "keit"], "es": ["ción", "os", "ñ", "ll", "ar"]}


def make(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_gradients_match_differences():
    net = langid.Network(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = langid.padded([b"abc", b"de", b"f"])
    label, weight = np.array([0, 1, 2]), np.array([1.0, 2.0, 1.0])
    _, g = net.gradients(x, mask.astype(np.float64), label, weight)
    rng = np.random.default_rng(0)
    for name, v in net.p.items():
        at = tuple(rng.integers(0, s) for s in v.shape) if not name.startswith("e") else (97, int(rng.integers(0, v.shape[1])))
        keep, eps = v[at], 1e-4
        v[at] = keep + eps
        up = net.gradients(x, mask, label, weight)[0]
        v[at] = keep - eps
        down = net.gradients(x, mask, label, weight)[0]
        v[at] = keep
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3, name


def test_table_of_words_equals_the_network_on_whole_texts():
    net = langid.Network(3)
    long, wide = "z" * 60, "a" + "日本é" * 12  # read in pieces of whole characters
    text = f"Été deux  x9y {long} {wide}"
    label = langid.Labeller(net)
    got = label(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
    assert np.array_equal(got, label(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0])
    parts = [("Été".encode().lower(), 0, 5), (b"deux", 0, 4), (b"x", 0, 1), (b"y", 0, 1)]
    for run in (long.encode(), wide.encode()):
        floor = lambda i: next(j for j in range(min(max(i, 0), len(run)), -1, -1) if j in (0, len(run)) or run[j] & 0xC0 != 0x80)  # noqa: B023, E731
        edges = [floor(i) for i in range(0, len(run), langid.LONGEST)] + [len(run)]
        for a, b in zip(edges, edges[1:]):
            low, high = floor(a - langid.LONGEST), floor(b + langid.LONGEST)
            run[a:b].decode(), run[low:high].decode()
            parts.append((run[low:high], a - low, b - a))
    total = sum(net.probabilities(*langid.padded([w]))[i : i + n].sum((0, 1)) for w, i, n in parts)
    assert sum(n for _, _, n in parts) == 11 + 60 + 97
    assert np.allclose(got, total / (11 + 60 + 97), atol=1e-5)


def test_held_out_accuracy_and_cases(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 150)
    rng = random.Random(2)
    rows = [(i, make(rng, lang, rng.randint(3, 40)), lang) for i in range(600) for lang in [rng.choice(list(SYLLABLES))]]
    rows += [(9001, None, "en"), (9002, "12 -- !", "en"), (9003, "", None), (9004, "— …", None), (9005, "日本", None), (None, "thing", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit(None).cast("string"))
    out = {r.doc_id: r for r in langid.predict_held_out(df).collect()}
    assert len(out) == len(rows)
    held = [(out[i].lang_pred, lang) for i, _, lang in rows[:600] if out[i].held_out]
    assert len(held) > 60 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (9001, 9002, 9003, 9004))
    assert out[9005].lang_pred != "und" and all(0 <= r.score <= 1 for r in out.values())


def test_without_labels_all_are_undetermined(spark, empty):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.predict_held_out(df).first().lang_pred == "und"
    assert langid.predict_held_out(empty.select("doc_id", "text", "lang")).count() == 0


def test_every_language_is_learned(spark):
    """80 languages of one letter each; the last ten are the rarest."""
    rng = random.Random(7)
    word = lambda k: "".join(rng.choices([chr(0x4E00 + 64 * k + 7), "a"], [3, 1], k=3))
    rows = [(1000 * k + i, " ".join(word(k) for _ in range(8)), f"l{k:02}") for k in range(80) for i in range(12 if k < 70 else 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, words, label = langid.sample(df, "text", "lang", "doc_id")
    assert langs == [f"l{k:02}" for k in range(80)] and set(label) == set(range(80))
    out = langid.predict(df, df).where("doc_id >= 70000").collect()
    assert len(out) == 60 and sum(r.lang_pred == r.lang for r in out) > 40
