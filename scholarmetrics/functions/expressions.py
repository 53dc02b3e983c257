"""Column expressions (all built-in, JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def position_credit(seq: str | Column = "author_seq") -> Column:
    """an author's share by position, ``1 / seq`` as a double.

    Position 0 raises a division-by-zero error under ANSI mode, like the
    original ``1/float(seq)``; a NULL position gives NULL credit.
    """
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.lit(1.0) / s.cast("double")


def venue_key(venue: str | Column = "venue_key", lower: bool = True) -> Column:
    """the venue grouping key, lower-cased by default."""
    v = F.col(venue) if isinstance(venue, str) else venue
    return F.lower(v) if lower else v


def hash_bucket(key: str | Column, seed: int, buckets: int = 10) -> Column:
    """Deterministic bucket of a string key: first 8 hex digits of
    ``md5(key || ':' || seed)`` as an integer, modulo ``buckets``.

    Unlike ``randomSplit`` the bucket does not depend on partitioning or task
    order, so a recomputed partition (lost executor) lands in the same split.
    """
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def l2_normalized(cols: list[str]) -> list[Column]:
    """M2 in column form: ``x_i / sqrt(sum x_j^2)``; a zero vector is unchanged
    (``pyspark.ml.feature.Normalizer(p=2.0)`` semantics)."""
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0)))
    return [
        F.when(norm == 0.0, F.col(c).cast("double")).otherwise(F.col(c) / norm).alias(c)
        for c in cols
    ]


def histogram_bucket(value: str | Column, lo: int, width: int, n_buckets: int) -> Column:
    """Bucket index of ``value`` for the edges ``lo, lo+w, ..., lo+n*w``.

    Buckets are ``[a, b)`` except the last, which is closed; values outside
    ``[lo, lo + n*w]`` give NULL.  (``width_bucket`` puts the upper edge in an
    overflow bucket, so it is not used.)
    """
    v = F.col(value) if isinstance(value, str) else value
    hi = lo + n_buckets * width
    idx = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(n_buckets - 1))
    return F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), idx.cast("int"))
