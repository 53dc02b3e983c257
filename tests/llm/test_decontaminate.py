import random
import re

from scholarmetrics.llm import decontaminate


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())


def grams(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(text, items):
    w, out = words(text), []
    for i, t in items:
        x = words(t)
        if x:
            n = min(5, len(x))
            s = grams(x, n)
            k = len(s & grams(w, n))
            if k >= 0.75 * len(s) - 1e-9:
                out.append((i, k, len(s)))
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, docs, empty):
    rng = random.Random(4)
    word = lambda: rng.choice(["ä", "b", "cc", "d1", "E", "ff"]) + str(rng.randint(0, 60))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 8, 30, 90])))) for i in range(60)]
    items += [(60, None), (61, " ; "), (7, items[7][1]), (7, items[7][1]), (None, "no id at all but six words")]
    texts = []
    for i in range(300):
        filler = [word() for _ in range(rng.randint(0, 400))]
        x = words(items[rng.randrange(60)][1])
        if rng.random() < 0.3 and len(x) > 10:
            x[rng.randrange(len(x))] = "changed"
        texts.append(" ".join([*filler, *(x if i % 2 else x[: len(x) // 2]), *filler[:5]]).upper())
    texts += [None, "", " ", "no id, at all; but SIX words."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for at_once in (1 << 20, 5000):  # one slice, several
        out = decontaminate.find(df, bench, bytes_at_once=at_once).collect()
        assert len(out) == len(texts)
        for r in out:
            assert sorted(map(tuple, r.found), key=repr) == brute(r.text, items)
    assert sum(1 for r in out if r.found) > 100
    none = bench.limit(0)
    assert decontaminate.find(docs, none).selectExpr("sum(size(found)) n").first().n == 0
    assert decontaminate.find(empty, bench).count() == 0
