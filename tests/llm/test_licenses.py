import random
import re

from scholarmetrics.llm import licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    """Each run of each template's length of the whole text, one by one."""
    w = words(text)
    places = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    best = {}
    for label, t in licenses.TEMPLATES:
        t = words(t)
        s = set(t)
        need = (licenses.THRESHOLD if len(s) >= licenses.SHORT else 1) * len(s) - 1e-9
        for i in range(max(1, len(w) - len(t) + 1)):
            shared = len(s.intersection(w[i : i + len(t)]))
            if shared >= need:
                best[label] = max(best.get(label, 0), shared / len(s))
    return len(w), [i for i, _ in places], best


def test_scan_equals_brute_force(docs, rows):
    out = licenses.scan(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        n, places, best = brute(r.text)
        assert r.n_words == n
        assert [p.word for p in r.places] == places
        assert {m.label: m.share for m in r.matches} == best
    found = {r.doc_id: {m.label for m in r.matches} for r in out}
    assert "apache-2" in found[907]
    assert found[908] == {"all-rights-reserved", "gpl-3"}


def test_damaged_notices_equal_brute_force_through_the_query(spark, tmp_path):
    from scholarmetrics.llm import registry

    rng, texts = random.Random(3), []
    for _ in range(150):
        w = words(rng.choice(licenses.TEMPLATES)[1])
        for _ in range(rng.randint(0, len(w) // 4)):  # near the threshold, on both sides
            w[rng.randrange(len(w))] = rng.choice(["other", "the", "license", "software"])
        around = [" ".join(rng.choices(["and", "the", "of", "copy", "plain", "words"], k=rng.choice([0, 3, 90]))) for _ in "ab"]
        texts.append(around[0] + "\n" + " ".join(x + rng.choice(["", "", "\n", ","]) for x in w) + "\n" + around[1])
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in registry.op2_license_scan(spark, str(tmp_path)).collect()}
    kept = 0
    for i, t in enumerate([*texts, None, ""]):
        n, places, best = brute(t)
        base = {label for p, label in licenses.PHRASES.items() if f" {p} " in f" {' '.join(words(t))} "}
        assert (out[i].n_words, out[i].n_base) == (n, len(places))
        assert (out[i].first_word, out[i].last_word) == ((places[0], places[-1]) if places else (None, None))
        assert out[i].base_labels == ",".join(sorted(base))
        assert out[i].labels == ",".join(sorted(base | set(best)))
        assert out[i].score == (1 if places else max(best.values(), default=0))
        kept += bool(best)
    assert 30 < kept < 140


def test_long_texts_and_empty_input(spark, empty):
    long = "x " * 50000 + "this work is licensed under\nthe gnu general public license version 3 " + "y " * 50000
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert [m.label for m in licenses.scan(df).first().matches] == ["gpl-3"]
    assert licenses.scan(empty).count() == 0


def test_notices_are_found_across_line_ends_but_not_across_other_text(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    far = "x " * 70 + "\n"
    df = spark.createDataFrame([(1, bsd), (2, far + bsd.replace(" ", "\n") + far), (3, bsd.replace("\n", "\n" + far))], "doc_id long, text string")
    out = {r.doc_id: {m.label: m.share for m in r.matches} for r in licenses.scan(df).collect()}
    assert out == {1: {"bsd": 1.0}, 2: {"bsd": 1.0}, 3: {}}


def test_filters_lose_nothing():
    """Whatever order the words have, the filters leave what full sets decide."""
    rng = random.Random(8)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in licenses.folded_words(t)})
    for _ in range(20):
        matcher = licenses.Matcher(licenses.TEMPLATES, 0.8, {w: rng.randrange(50) for w in vocabulary})
        for t in matcher.templates:
            for _ in range(20):
                block = t.mask & ~sum(1 << r for r in rng.sample(range(len(vocabulary)), len(vocabulary) // 5))
                block |= sum(1 << r for r in rng.sample(range(len(vocabulary)), 5))
                n = (block & t.mask).bit_count()
                assert t.shared(block) == (n if n >= t.need else 0)


def test_a_license_is_not_taken_for_another(spark):
    texts = {
        "Released under the BSD License": "",
        "Licensed under the Mozilla Public License, Version 2.0": "",
        "Licensed under the Apache License, Version 1.0": "",
        "Licensed under CC BY 4.0": "",
        "Licensed under CC BY-NC-SA 4.0": "",
        "This work is licensed under the GNU Lesser General Public License version 2": "",
        "This work is licensed under the GNU Lesser General Public License version 3": "",
        "This work is licensed under the GNU General Public License, version 2": "",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "This Source Code Form is subject to the terms of the Eclipse Public License": "",
        "This work has been released into the public repository": "",
        "We released it under terms that the license names": "",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software covered by this license": "",
    }
    # every template, and the same wrapped, still gives its own label
    texts |= {f: k for k, x in licenses.TEMPLATES for f in (x, x.replace(" ", "\n", 3).upper())}
    df = spark.createDataFrame(list(texts.items()), "text string, want string")
    for r in licenses.scan(df).collect():
        assert ",".join(m.label for m in r.matches) == r.want, r.text
