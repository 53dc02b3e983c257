"""Operator 3: quality rules and robust multivariate outliers (MCD).

Text statistics are taken over whole texts.  Rows that pass the base rules get a
vector of transformed statistics; per (language, source) the minimum-covariance-
determinant estimate of location and scatter is found by concentration steps over
*all* rows of the group, and rows with a large Mahalanobis distance are rejected.

One concentration step is two grouped sums over the narrow statistics table:

1. rows per group and per bucket of the distance under the current estimate, which
   gives the bucket that closes the ``SUPPORT`` share of nearest rows (a bucket is
   1/64 of a doubling of the distance, whatever the number of rows);
2. sums and cross products of the rows within it, which give the next estimate.

Steps start from the median and the quartile spread and are repeated until no
group's determinant falls any more.  Sums are combined before the shuffle, so a
hot language or source is spread over all tasks; estimates are one row per group.
A row feeds three groups: its pair of language and source, its language and the whole
table.  A language's estimate is drawn towards that of the table and a pair's towards its
language's, each at the weight of ``PRIOR`` rows, so a small source is judged mostly by its
language and there is no step at any number of rows.

Cases: a null or empty text has no words and fails the base rules; null language or
source is a group of its own; repeated rows give equal verdicts; an empty table
gives an empty table; a very long text is held by one task, its statistics are one row;
a group whose statistics do not vary has the floor scatter;
input columns named like an output are replaced.
"""

from __future__ import annotations

from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import checked_join, cut, scratch

#: Share of a group's rows that the MCD subset holds.
SUPPORT = 0.75
#: Chance that a row of a normal group is rejected.
TAIL = 1e-9
#: Rows whose weight the language's estimate has in a source's, and the table's in a language's.
PRIOR = 50
#: Least standard deviation of each transformed statistic (see ``vector``).
FLOOR = (0.05, 0.04, 0.12, 0.12)

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_P = len(FLOOR)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _text_stats(u8: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of _STATS per text."""
    h, first = textkit.words(u8, offsets, textkit.BYTE_CODE)
    out = np.zeros((len(offsets) - 1, len(_STATS)), np.int64)
    out[:, 0] = np.diff(first)
    for k, mask in ((1, ~textkit.IS_SPACE[u8] & ((u8 & 0xC0) != 0x80)), (2, _SYMBOLS[u8])):
        sums = np.append(0, np.cumsum(mask, dtype=np.int64))
        out[:, k] = np.diff(sums[offsets])
    data = u8.tobytes()
    for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        lines = [x for x in data[a:b].split(b"\n") if x.strip()]
        out[r, 3], out[r, 4] = len(lines), len(lines) - len(set(lines))
        w = h[first[r] : first[r + 1]]
        if len(w) >= 4:
            three = textkit.shingles(w, 3)
            order = np.argsort(three)
            same = three[order][1:] == three[order][:-1]
            if same.any():
                again = np.zeros(len(three) + 3, np.int64)
                hit = order[np.append(same, False) | np.append(False, same)]
                again[hit] += 1
                np.add.at(again, hit + 3, -1)
                out[r, 5] = int((np.cumsum(again)[: len(w)] > 0).sum())
    return out


def add_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the text statistics (longs) and ``base_failed``."""
    arrow_kind = pa.struct([(n, pa.int64()) for n in _STATS])

    @arrow_udf("struct<" + ",".join(f"{n}:bigint" for n in _STATS) + ">")
    def run(col: pa.Array) -> pa.Array:
        u8, off = textkit.flat(col)
        parts = [_text_stats(u8[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in textkit.blocks(off)]
        rows = np.concatenate(parts) if parts else np.zeros((0, len(_STATS)), np.int64)
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(_STATS))], fields=list(arrow_kind))

    return (
        df.withColumn("__stats", run(F.col(text)))
        .withColumns({n: F.col(f"__stats.{n}") for n in _STATS})
        .drop("__stats")
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    )


def vector() -> list[Column]:
    """Transformed statistics: log mean word length, and square roots of the shares of
    symbols, repeated lines and repeated words."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution for an even number of degrees of freedom."""
    total = term = 1.0
    for k in range(1, p // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, p) < q else (low, mid)
    return high


def cutoff() -> float:
    return _chi2_quantile(1 - TAIL, _P)


def _precision(cov: Column) -> Column:
    """Inverse (row by row) and, last, the log determinant of a covariance matrix given
    by its upper triangle; the floor variances are added first."""

    @arrow_udf("array<double>")
    def run(col: pa.Array) -> pa.Array:
        out = []
        for row in col.to_pylist():
            m = np.zeros((_P, _P))
            for (i, j), v in zip(_PAIRS, row):
                m[i, j] = m[j, i] = v
            m += np.diag(np.square(FLOOR))
            out.append([*np.linalg.inv(m).ravel().tolist(), float(np.linalg.slogdet(m)[1])])
        return pa.array(out, pa.list_(pa.float64()))

    return run(cov)


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from the joined ``center``."""
    d = [F.col("x")[i] - F.col("center")[i] for i in range(_P)]
    total = F.lit(0.0)
    for i in range(_P):
        for j in range(_P):
            total = total + d[i] * d[j] * F.col("precision")[i * _P + j]
    return total


#: Key of the group of all rows.
_ALL = "{}"


def _group_key(*columns: str) -> Column:
    """One string per combination; null differs from every value."""
    return F.to_json(F.struct(F.lit(len(columns)).alias("level"), *columns))


def groups(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """(__pair, lang_group, n, n_lang): each pair of lang and source, and its rows."""
    pair, both = _group_key(F.col(lang).alias("lang"), F.col(source).alias("source")), _group_key(F.col(lang).alias("lang"))
    n = cut(rows.groupBy(pair.alias("__pair"), both.alias("lang_group")).agg(F.count("*").alias("n")))
    return checked_join(n, cut(n.groupBy("lang_group").agg(F.sum("n").alias("n_lang"))), "lang_group")


def _shrunk(fields: Column) -> Column:
    """Centre and precision of a pair from those of the pair, its language and the table."""

    @arrow_udf("struct<center:array<double>,precision:array<double>>")
    def run(col: pa.Array) -> pa.Array:
        out = []
        for r in col.to_pylist():
            center, cov = np.array(r["c0"]), np.linalg.inv(np.array(r["p0"][:-1]).reshape(_P, _P))
            for c, p, n in ((r["c1"], r["p1"], r["n_lang"]), (r["c2"], r["p2"], r["n"])):
                w = n / (n + PRIOR)
                center = w * np.array(c) + (1 - w) * center
                cov = w * np.linalg.inv(np.array(p[:-1]).reshape(_P, _P)) + (1 - w) * cov
            p = np.linalg.inv(cov)
            out.append({"center": center.tolist(), "precision": [*p.ravel().tolist(), float(np.linalg.slogdet(cov)[1])]})
        many = pa.list_(pa.float64())
        return pa.array(out, pa.struct([("center", many), ("precision", many)]))

    return run(fields)


def fit(rows: DataFrame, lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """MCD estimates over rows with the statistics of ``add_stats``.

    Returns (pair of lang and source -> group) and (group -> center, precision).
    """
    with scratch(rows.sparkSession) as s:
        of, best = _estimate(rows, lang, source)
        parts = of.withColumn("__all", F.lit(_ALL))
        for k, key in enumerate(("__all", "lang_group", "__pair")):
            parts = checked_join(parts, best.select(F.col("g").alias(key), F.col("center").alias(f"c{k}"), F.col("precision").alias(f"p{k}")), key)
        names = [f"{x}{k}" for x in "cp" for k in range(3)]
        drawn = parts.select(F.col("__pair").alias("__group"), _shrunk(F.struct("n", "n_lang", *names)).alias("e"))
        estimates = s.keep(cut(drawn.select("__group", "e.center", "e.precision")))
        return s.keep(cut(of.select("__pair", F.col("__pair").alias("__group")))), estimates


def _estimate(rows: DataFrame, lang: str, source: str) -> tuple[DataFrame, DataFrame]:
    """The groups and, by concentration steps, each one's own estimate; both are cut tables."""
    usable = rows.where(~F.col("base_failed"))
    of = cut(groups(usable, lang, source))
    key, by_lang = _group_key(F.col(lang).alias("lang"), F.col(source).alias("source")), _group_key(F.col(lang).alias("lang"))
    points = cut(usable.select(F.explode(F.array(key, by_lang, F.lit(_ALL))).alias("g"), F.array(*vector()).alias("x")))

    quart = [F.percentile_approx(F.col("x")[i], F.array(*map(F.lit, (0.25, 0.5, 0.75))), 10000).alias(f"q{i}") for i in range(_P)]
    spread = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0) for i, j in _PAIRS]
    best = points.groupBy("g").agg(*quart).select("g", F.array(*[F.col(f"q{i}")[1] for i in range(_P)]).alias("center"), F.array(*spread).alias("cov"))
    best = cut(best.select("g", "center", _precision(F.col("cov")).alias("precision"), F.lit(None).cast("double").alias("before")))
    scale = SUPPORT / _chi2_cdf(_chi2_quantile(SUPPORT, _P), _P + 2)  # makes the subset's scatter consistent
    size = F.floor(F.log2(F.greatest(F.col("d2"), F.lit(1e-9))) * 32)
    while True:
        near = checked_join(points, best.select("g", "center", "precision"), "g").select("g", "x", _distance().alias("d2")).withColumn("bucket", size)
        counts = near.groupBy("g", "bucket").agg(F.count("*").alias("n"))
        upto = Window.partitionBy("g").orderBy("bucket")
        whole = Window.partitionBy("g")
        edge = (
            counts.select("g", "bucket", F.sum("n").over(upto).alias("cum"), F.sum("n").over(whole).alias("all"))
            .where(F.col("cum") >= SUPPORT * F.col("all"))
            .groupBy("g")
            .agg(F.min("bucket").alias("edge"))
        )
        inner = checked_join(near, cut(edge), "g").where(F.col("bucket") <= F.col("edge"))
        sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(_P)] + [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i, j in _PAIRS]
        n = F.col("n")
        cov = [F.greatest((F.col(f"s{i}_{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / n / n) * scale, F.lit(0.0)) if i == j else (F.col(f"s{i}_{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / n / n) * scale for i, j in _PAIRS]
        step = inner.groupBy("g").agg(F.count("*").alias("n"), *sums)
        step = step.select("g", F.array(*[F.col(f"s{i}") / n for i in range(_P)]).alias("center"), _precision(F.array(*cov)).alias("precision"))
        old = best.select("g", F.col("precision")[_P * _P].alias("before"), F.col("center").alias("old_center"), F.col("precision").alias("old_precision"), F.col("before").alias("older"))
        # the first step replaces the start; later ones count only if the determinant falls
        better = F.col("older").isNull() | (F.col("precision")[_P * _P] < F.col("before") - 1e-6)
        nxt = step.join(old, "g").select(
            "g",
            F.when(better, F.col("center")).otherwise(F.col("old_center")).alias("center"),
            F.when(better, F.col("precision")).otherwise(F.col("old_precision")).alias("precision"),
            F.when(better, F.col("before")).otherwise(F.col("older")).alias("before"),
            better.alias("moved"),
        )
        best = cut(nxt)
        if not best.where("moved").limit(1).count():
            return of, best


def judge(rows: DataFrame, model: tuple[DataFrame, DataFrame], lang: str = "lang", source: str = "source") -> DataFrame:
    """Add ``distance`` (null for rows that fail the base rules) and ``kept``."""
    of, estimates = model
    both = cut(of.join(estimates, "__group").drop("__group"))
    pair = _group_key(F.col(lang).alias("lang"), F.col(source).alias("source"))
    # rows that fail need no estimate: a null key joins with nothing
    keyed = rows.withColumn("__pair", F.when(~F.col("base_failed"), pair)).withColumn("x", F.array(*vector()))
    judged = checked_join(keyed, both, "__pair", "left").withColumn("distance", F.sqrt(F.greatest(_distance(), F.lit(0.0))))
    kept = ~F.col("base_failed") & (F.coalesce(F.pow("distance", 2), F.lit(0.0)) <= F.lit(cutoff()))
    return judged.withColumn("kept", kept).drop("__pair", "x", "center", "precision")
