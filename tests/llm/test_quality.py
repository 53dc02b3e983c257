import itertools
import random
import re
from collections import Counter

import numpy as np
from scholarmetrics.llm import quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(docs, rows, empty):
    out = quality.add_stats(docs)
    for r in out.collect():
        n, chars, symbols, lines, dup, again = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, dup, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
    assert quality.add_stats(empty).count() == 0


def test_outliers_go_and_normal_rows_stay(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        n = rng.randint(60, 200)
        junk = i % 10 == 0
        text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) + ("$$#" if junk else "") for _ in range(n))
        rows.append((i, text, rng.choice(["en", "fr"]), "hot" if i % 3 else f"s{i % 30}", junk))
    rows += [(-1, None, None, None, True), (-2, "", "en", "hot", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    stats = quality.add_stats(df)
    out = quality.judge(stats, quality.fit(stats))
    assert "x" not in out.columns
    got = out.groupBy("junk", "kept").count().collect()
    assert {(r.junk, r.kept): r["count"] for r in got} == {(False, True): 1350, (True, False): 152}


def test_fit_reaches_a_fixed_point_of_the_concentration_step(spark):
    """One more step by numpy over the whole group gives the same centre."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("w" * int(k) for k in rng.integers(1, 12, 80)), "en", "a") for i in range(600)]
    stats = quality.add_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    of, est = quality.fit(stats)
    r = est.collect()[0]
    x = np.array([q[0] for q in stats.select(quality.F.array(*quality.vector())).collect()])
    d = x - np.array(r.center)
    p = np.array(r.precision[:-1]).reshape(4, 4)
    d2 = np.einsum("ij,jk,ik->i", d, p, d)
    near = d2 <= np.quantile(d2, quality.SUPPORT) * 2 ** (1 / 32)
    assert np.allclose(x[near].mean(0), r.center, atol=0.01)


def test_estimate_equals_the_best_of_all_subsets(spark):
    """Minimum determinant over every subset of the support's size, by numpy."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(14):
        far = i >= 11
        chars = int(600 * (2.5 if far else rng.uniform(0.8, 1.25)))
        symbols = int(chars * (0.3 if far else rng.uniform(0.001, 0.05)))
        rows.append((100, chars, symbols, 50, int(rng.integers(0, 12)) + 20 * far, int(rng.integers(0, 30)), False, "en", "a"))
    names = [*quality._STATS, "base_failed", "lang", "source"]
    stats = spark.createDataFrame(rows, names)
    _, best = quality._estimate(stats, "lang", "source")
    x = np.array([q[0] for q in stats.select(quality.F.array(*quality.vector())).collect()])
    floor, scale = np.diag(np.square(quality.FLOOR)), quality.SUPPORT / quality._chi2_cdf(quality._chi2_quantile(quality.SUPPORT, 4), 6)
    scatter = lambda s: np.cov(x[list(s)].T, bias=True) * scale + floor
    least = min(itertools.combinations(range(14), 11), key=lambda s: np.linalg.slogdet(scatter(s))[1])
    assert set(least) == set(range(11))
    for r in best.collect():  # the pair, its language and the table hold the same rows
        assert np.allclose(r.center, x[list(least)].mean(0))
        assert np.allclose(np.linalg.inv(np.array(r.precision[:-1]).reshape(4, 4)), scatter(least))


def test_few_rows_are_judged_by_all_rows_of_their_language_or_of_the_table(spark):
    rng = random.Random(6)
    words = lambda end: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) + end for _ in range(100))
    rows = [(i, words(""), "en", "hot", True) for i in range(400)]
    rows += [(1000 + i, words("$$#"), "en", "small", False) for i in range(10)]  # alone they would be their own norm
    rows += [(2000 + i, words("$$#"), "xx", "rare", False) for i in range(10)]
    rows += [(3000 + i, words(""), "en", "fine", True) for i in range(10)] + [(4000, words(""), None, None, True)]
    stats = quality.add_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fine boolean"))
    got = quality.judge(stats, quality.fit(stats))
    assert not got.where("kept != fine").count() and got.count() == len(rows)


def test_empty_table(empty):
    stats = quality.add_stats(empty)
    assert quality.judge(stats, quality.fit(stats)).count() == 0
