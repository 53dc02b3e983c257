"""Operator 2: license scan by an exact set-similarity (containment) join.

Templates are joined with text blocks on their word sets.  The blocks of a template are all
runs of as many words as it has, over the whole text and across line ends (a shorter text
is one block).  A pair qualifies when the block holds at least ``threshold`` of the
template's distinct words; statements of fewer than ``SHORT`` of them must be held whole,
as one word names their license.

- Words are ordered by their frequency in the whole corpus, rarest first (one
  grouped count over all texts, restricted to the templates' vocabulary, so its
  result has at most as many rows as the templates have words).
- Prefix filter: a qualifying block shares one of the template's
  ``size - need + 1`` rarest words, so only these are in the inverted index that
  the words of a text probe, and runs are formed around their places only.
- Length filter: the block has at least ``need`` words of the vocabulary.
- Positional filter: what can still follow the first shared word, in the template and in
  the block, must be enough to reach ``need``.
- Survivors are verified on the full word sets.

The word sets of a run and of a template are bit masks in frequency order; a run's is kept
while it moves on by a word.  The templates are a fixed list (the small side of the join);
the large side is probed where it lies, row by row, so nothing is shuffled but the word
counts, and hot sources or copies have no effect.

Licenses whose notices differ in a word or two only share a label: ``gnu`` is the notice
of the General, Lesser and Affero licenses of any version.

Cases: a null or empty text has no words, places or labels and score 0; a very long text
is taken whole, a run at a time; repeated rows give equal rows; an empty table gives an
empty table; of equal shares the larger score counts, so ties do not matter; input columns
named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit

# Phrases whose every place is reported, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Fixed values: (label, text) of the templates, one-line statements and license notices.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("public-domain", "This work has been released into the public domain"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache-2",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
        " See the License for the specific language governing permissions and limitations under the License",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list"
        " of conditions and the following disclaimer in the documentation and/or other materials provided with the"
        " distribution",
    ),
    (
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license (the Software) to use, reproduce, display,"
        " distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    ),
    (
        "gnu",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at",
    ),
    (
        "public-domain",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software",
    ),
]

#: Share of a template's distinct words that a block must hold, and the number of distinct
#: words below which it must hold all.
THRESHOLD, SHORT = 0.8, 16

_WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: A-Z folded, all bytes outside words blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD_BYTES else 32 for b in range(256))


def folded_words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Template:
    """A template's words as a bit mask in frequency order, rarest lowest."""

    def __init__(self, label: str, words: list[bytes], threshold: float, rank: dict[bytes, int]):
        self.label, self.length = label, len(words)
        ranks = sorted({rank[w] for w in words})
        self.size = len(ranks)
        self.need = ceil((threshold if self.size >= SHORT else 1.0) * self.size - 1e-9)
        self.prefix_ranks = ranks[: self.size - self.need + 1]
        self.mask = sum(1 << r for r in ranks)
        self.prefix = sum(1 << r for r in self.prefix_ranks)

    def shared(self, block: int) -> int:
        """Words shared with a block's mask if the block qualifies, else 0."""
        if block.bit_count() < self.need:  # length
            return 0
        common = block & self.prefix
        if not common:  # prefix
            return 0
        after = (common & -common).bit_length()
        if 1 + min((self.mask >> after).bit_count(), (block >> after).bit_count()) < self.need:  # position
            return 0
        n = (self.mask & block).bit_count()
        return n if n >= self.need else 0


class Matcher:
    """Templates in frequency order, with the inverted index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, frequency: dict[bytes, int]):
        split = [(label, w) for label, t in templates if (w := folded_words(t))]
        vocabulary = {w for _, words in split for w in words}
        ranked = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ranked)}
        self.templates = [Template(label, words, threshold, self.rank) for label, words in split]
        self.index: dict[bytes, list[int]] = {}
        for k, t in enumerate(self.templates):
            for r in t.prefix_ranks:
                self.index.setdefault(ranked[r], []).append(k)

    def match(self, words: list[bytes]) -> dict[str, float]:
        """Largest containment of each label with a qualifying template, over all its runs."""
        near: dict[int, list[list[int]]] = {}
        for j, w in enumerate(words):
            for k in self.index.get(w, ()):
                length = self.templates[k].length
                a, b = max(0, j - length + 1), min(len(words), j + length)
                spans = near.setdefault(k, [])
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        best: dict[str, float] = {}
        for k, spans in near.items():
            t = self.templates[k]
            most = max(self._most(t, words[a:b]) for a, b in spans)
            if most:
                best[t.label] = max(best.get(t.label, 0.0), most / t.size)
        return best

    def _most(self, t: Template, words: list[bytes]) -> int:
        """Largest number of words that a qualifying run shares with the template."""
        ranks = [self.rank.get(w) for w in words]
        count, block, most = [0] * len(self.rank), 0, 0
        for i, r in enumerate(ranks):
            if i >= t.length and (gone := ranks[i - t.length]) is not None:
                count[gone] -= 1
                if not count[gone]:
                    block &= ~(1 << gone)
            if r is not None:
                count[r] += 1
                if count[r] == 1:
                    block |= 1 << r
                    most = max(most, t.shared(block))  # a run gains by new words only
        return most


def _rows(col: pa.Array) -> Iterator[list[bytes]]:
    u8, off = textkit.flat(col)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield u8[a:b].tobytes().translate(_FOLD).split()


def word_frequency(df: DataFrame, templates: list[tuple[str, str]], text: str = "text") -> dict[bytes, int]:
    """Occurrences in all texts of the templates' words (at most that many rows)."""
    vocabulary = sorted({w for _, t in templates for w in folded_words(t)})
    place = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place), np.int64)
        for batch in batches:
            for words in _rows(batch.column(0)):
                total += np.bincount([place[w] for w in words if w in place], minlength=len(place)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary, pa.binary()), pa.array(total)], ["word", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


def scan(
    df: DataFrame,
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add ``n_words``, ``places`` (array of label and first word of each phrase) and
    ``matches`` (array of label and containment of each qualifying template, the largest
    of a label's)."""
    matcher_of = (templates, threshold, word_frequency(df, templates, text))
    kind = "struct<n_words:bigint,places:array<struct<label:string,word:bigint>>,matches:array<struct<label:string,share:double>>>"
    arrow_kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
            ("matches", pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64())]))),
        ]
    )

    @arrow_udf(kind)
    def run(col: pa.Array) -> pa.Array:
        matcher, out = Matcher(*matcher_of), []
        for words in _rows(col):
            line = b" " + b" ".join(words) + b" "
            places = []
            for phrase, label in phrases.items():
                sought = b" " + phrase.encode() + b" "
                at = line.find(sought)
                while at >= 0:
                    places.append({"label": label, "word": line.count(b" ", 0, at + 1) - 1})
                    at = line.find(sought, at + 1)
            matches = [{"label": k, "share": v} for k, v in sorted(matcher.match(words).items())]
            out.append({"n_words": len(words), "places": sorted(places, key=lambda x: x["word"]), "matches": matches})
        return pa.array(out, arrow_kind)

    found = df.withColumn("__scan", run(F.col(text)))
    return found.withColumns({c: F.col(f"__scan.{c}") for c in ("n_words", "places", "matches")}).drop("__scan")
