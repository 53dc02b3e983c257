import random
import re
from collections import Counter, defaultdict

import pytest
from scholarmetrics.llm import neardup


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (set sizes, smallest reachable id), by comparing all pairs that share a shingle."""
    nodes = [(d, shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in nodes if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i, (_, s) in enumerate(nodes):
        for x in s:
            inverted[x].append(i)
    for i, (d, s) in enumerate(nodes):
        for j, k in Counter(j for x in s for j in inverted[x] if j < i).items():
            if 100 * k >= 75 * (len(s) + len(nodes[j][1]) - k) and d is not None and nodes[j][0] is not None:
                a, b = find(d), find(nodes[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), find(d) if d is not None else None) for d, s in nodes), key=repr)


def run(spark, rows):
    out = neardup.group(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)


def test_cases_equal_brute_force(spark, rows):
    pairs = [(d, t) for d, t, *_ in rows]
    assert run(spark, pairs) == brute(pairs)


@pytest.mark.parametrize("growth", [2, 8])
def test_large_groups_chains_and_common_passages(spark, monkeypatch, growth):
    monkeypatch.setattr(neardup, "GROWTH", growth)
    rng = random.Random(growth)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    base = [word() for _ in range(90)]
    for _ in range(80):  # near copies of one text
        w = list(base)
        w[rng.randrange(90)] = word()
        rows.append(" ".join(w))
    chain = [word() for _ in range(60)]
    for _ in range(30):  # each like the one before, unlike the first
        rows.append(" ".join(chain))
        chain = chain[2:] + [word(), word()]
    passage = " ".join(word() for _ in range(60))
    rows += [" ".join([passage, *[word() for _ in range(rng.randint(8, 60))]]) for _ in range(60)]  # one passage in many texts
    rows += [" ".join(rng.choices(base, k=rng.randint(1, 12))) for _ in range(40)]
    rows += rows[:20]
    rng.shuffle(rows)
    pairs = list(enumerate(rows))
    assert run(spark, pairs) == brute(pairs)


@pytest.mark.parametrize("k", [8, 32])
def test_short_sketches_lose_no_link(spark, monkeypatch, k):
    """Sets longer than the sketches take the sampled bounds."""
    monkeypatch.setattr(neardup, "SKETCH", k)
    monkeypatch.setattr(neardup, "SCOUT", min(k, 32))
    rng = random.Random(k)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(5, 200))]
        for _ in range(4):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w[: rng.randint(len(w) * 4 // 5, len(w))]))
    pairs = list(enumerate(rows))
    assert run(spark, pairs) == brute(pairs)


def test_prefixes_cannot_miss_links_of_whole_sets():
    k = neardup.SKETCH
    for n in range(1, k + 1):
        for m in range(n, int(n / 0.75 + 1e-9) + 1):
            shared = max(-(-3 * (n + m) // 7), -(-3 * m // 4))  # least intersection that is linked
            retained = shared - max(0, m - k)
            assert n - neardup.prefix_length(n, k, 0.75) + 1 <= max(1, retained)
            if m <= k:
                assert m - neardup.prefix_length(m, k, 0.75) + 1 <= shared


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(50, 50)]
    got = {r.cid: r.comp for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


def test_empty(empty):
    assert neardup.group(empty).count() == 0
