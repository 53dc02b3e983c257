"""Operator 6: near-duplicate groups from bottom-k sketches of one hash function.

Two documents are linked when the Jaccard similarity of their shingle sets reaches
``threshold``; a group is a connected component of links.

1. Every text gives its set of shingle hashes, and of it the ``SCOUT`` smallest
   values (a bottom-k sketch).  Equal sets become one class, so copies cost one row.
2. Inverted lists of the retained values.  A value that one class alone holds links
   nothing.  Values are ordered rarest first; a linked pair shares at least ``o`` of
   the ``s`` retained values, so it shares one of each side's ``s - o + 1`` rarest.
   Classes without a shared value among these are done (most are).
3. The others (the active classes) get a longer sketch (``SKETCH``), and step 2 is
   repeated on it: the lists that remain hold near copies or little else.
4. Lists are worked off in rounds.  Each list first compares its members with one
   leader, the class with the fewest values of its own; later with growing random sets
   of leaders, always leaving out pairs that are already in one component.  A
   positional filter on the values' places and the sets' sizes drops members that share
   too little whatever follows, and after the first round two classes are paired only in
   the first list that they share.  A round's pairs grow linearly with the lists, and every
   pair that may be linked is in one component or has been compared when they end.
5. A pair's union sketch (the smallest values of both) estimates its similarity;
   pairs far below the threshold are dropped.  The others are verified on full sets.

``o`` is exact for sets that the sketch holds whole, and for longer ones lies so far
below the expected overlap that a link at the very threshold is missed with a chance
below 1e-8 (``lowest_overlap``); the margin of the estimate is as safe.

Components are found by contracting minimum-label trees; links, labels and lists are
tables in the shared folder, nothing of them reaches the driver.

Cases: a null text or one without words has an empty set and is linked with nothing;
fewer words than a shingle make one shingle; repeated ids are one document to link
(each row keeps its own set size); rows with a null id cannot be named, are linked with
nothing and kept; empty tables give empty tables; ``group`` returns its own columns only.
"""

from __future__ import annotations

from math import ceil, comb, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from scholarmetrics.llm import textkit
from scholarmetrics.llm.common import checked_join, cut, scratch

WIDTH = 5
#: What tells the classes of equal sets apart.
KEY = ["set_a", "set_b", "n_shingles"]
#: Values retained of every document, and of each active class.
SCOUT, SKETCH = 32, 256
#: Leaders per list in the first rounds; each later round has this many times more.
GROWTH = 32
#: Chance of missing one link at the threshold.
MISS = 1e-9


def lowest_overlap(k: int, share: float) -> int:
    """Most values that two sketches of ``k`` share, but for a chance of ``MISS``, when
    each of the union's k smallest is in both sets with probability ``share``."""
    total = 0.0
    for o in range(k + 1):
        total += comb(k, o) * share**o * (1 - share) ** (k - o)
        if total > MISS:
            return max(1, o)
    return k


def prefix_length(n: int, k: int, threshold: float) -> int:
    """Rarest retained values of which a linked document shares one, for ``n`` shingles.

    A set of up to k values is retained whole.  A linked set has at most n / threshold
    values and shares at least threshold times the larger size; of these, at most as
    many as it has beyond k are not retained on its side.
    """
    if n > k:
        return k - lowest_overlap(k, threshold) + 1
    least = n
    for m in range(max(1, n), floor(n / threshold + 1e-9) + 1):
        least = min(least, ceil(threshold * m - 1e-9) - max(0, m - k))
    return n - max(1, least) + 1


def _sets(col: pa.Array, width: int):
    """The sorted shingle set of each row."""
    u8, off = textkit.flat(col)
    for a, b in textkit.blocks(off):
        h, first = textkit.words(u8[off[a] : off[b]], off[a : b + 1] - off[a])
        for i, j in zip(first[:-1], first[1:]):
            yield textkit.shingle_set(h[i:j], width)


def add_sketch(df: DataFrame, k: int, text: str = "text", width: int = WIDTH) -> DataFrame:
    """Add ``n_shingles``, two digests of the set (null for the empty set) and the ``k``
    smallest values ``sketch``."""
    kind = pa.struct([("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("sketch", pa.list_(pa.int64()))])

    @arrow_udf("struct<n_shingles:bigint,set_a:bigint,set_b:bigint,sketch:array<bigint>>")
    def run(col: pa.Array) -> pa.Array:
        n, a, b, kept = [], [], [], []
        for s in _sets(col, width):
            n.append(len(s))
            kept.append((s[:k] >> np.uint64(1)).astype(np.int64))  # signed order is hash order
            a.append(int(textkit.mix(s).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None)
            b.append(int(textkit.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else None)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), textkit.ragged(kept, pa.int64())], fields=list(kind))

    return df.withColumn("__s", run(F.col(text))).withColumns({c.name: F.col(f"__s.{c.name}") for c in kind}).drop("__s")


def prefixes(classes: DataFrame, k: int, threshold: float) -> DataFrame:
    """The inverted lists of the rarest shared values of ``classes`` (cid, n_shingles,
    sketch): value, cid, n_shingles, the value's place in the class's order (rarest
    first, from 0), ``common`` (classes that hold the value: with it, the order) and
    ``lone``, the share of its values that no other class holds."""
    entries = classes.select("cid", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    # the values that only one class holds come first in its order; they need no list
    mine = entries.join(shared.hint("merge"), "value").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("held"))
    sizes = F.array(*[F.lit(prefix_length(n, k, threshold)) for n in range(1, k + 2)])
    n = F.col("n_shingles")
    alone = F.least(n, F.lit(k)) - F.size("held")
    length = F.element_at(sizes, F.least(n, F.lit(k + 1)).cast("int")) - alone
    joined = mine.join(classes.select("cid", "n_shingles").hint("merge"), "cid").withColumn("alone", F.greatest(alone, F.lit(0)))
    rarest = joined.where(length > 0).select("cid", "n_shingles", "alone", F.posexplode(F.slice("held", F.lit(1), length.cast("int"))).alias("i", "v"))
    lone = F.col("alone") / F.least(n, F.lit(k))
    return rarest.select(
        F.col("v.value").alias("value"), F.col("v.held").alias("common"), "cid", "n_shingles", (F.col("alone") + F.col("i")).alias("place"), lone.alias("lone")
    )


def enough_left(k: int, threshold: float) -> Column:
    """Positional filter on a pair of list entries (columns of the second with ``lead_``):
    whether the values from their common one on can still make up a linked pair.

    Sets that the sketches hold whole need the least intersection of a link; for longer
    ones its share of the larger set holds for the sketch too, less six deviations."""
    n, m = F.col("n_shingles"), F.col("lead_n")
    larger = F.greatest(n, m)
    least = threshold / (1 + threshold) * (n + m)
    mean = k * least / larger
    sampled = F.floor(mean - 6 * F.sqrt(mean * (1 - least / larger))) - 1
    need = F.greatest(F.when(larger <= k, F.ceil(least - 1e-9)).otherwise(sampled), F.lit(1))
    left = F.least(F.least(n, F.lit(k)) - F.col("place"), F.least(m, F.lit(k)) - F.col("lead_place"))
    return (F.least(n, m) >= threshold * larger - 1e-9) & (left >= need)


def components(links: DataFrame) -> DataFrame:
    """(cid, comp): the smallest reachable id, for all ends of ``links`` (a, b)."""
    edges = cut(links.select("a", "b").where("a <> b").distinct())
    nodes = edges.select(F.col("a").alias("cid")).union(edges.select("b")).distinct()
    labels = cut(nodes.withColumn("comp", F.col("cid")))
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        # one jump along the tree of smallest neighbours
        jump = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = cut(step.join(jump, "to", "left").select("a", F.coalesce("further", "to").alias("to")))
        labels = cut(labels.join(step, labels["comp"] == step["a"], "left").select("cid", F.coalesce("to", "comp").alias("comp")))
        one, two = step.select("a", F.col("to").alias("ta")), step.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        edges = cut(edges.join(one, "a").join(two, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b")).where("a <> b").distinct())
    return labels


def _verify(pairs: DataFrame, active: DataFrame, threshold: float, k: int, width: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold."""
    # estimate on the union's k smallest values first: the margin is six deviations
    margin = threshold - 6 * (threshold * (1 - threshold) / k) ** 0.5
    sides = lambda c, *more: active.select(F.col("cid").alias(c), *[F.col(m).alias(f"{m}_{c}") for m in more])
    sketched = pairs.join(sides("a", "sketch", "n_shingles").hint("merge"), "a").join(sides("b", "sketch", "n_shingles").hint("merge"), "b")
    sketched = sketched.where(F.least("n_shingles_a", "n_shingles_b") >= threshold * F.greatest("n_shingles_a", "n_shingles_b"))
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    likely = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b"))) >= margin * F.size(union)
    likely_pairs = cut(sketched.where(likely).select("a", "b"))

    @arrow_udf("boolean")
    def linked(one: pa.Array, two: pa.Array) -> pa.Array:
        out = []
        for s, t in zip(_sets(one, width), _sets(two, width)):
            both = len(np.intersect1d(s, t, assume_unique=True))
            out.append(both >= threshold * (len(s) + len(t) - both) - 1e-9)
        return pa.array(out, pa.bool_())

    full = likely_pairs.join(sides("a", "text").hint("merge"), "a").join(sides("b", "text").hint("merge"), "b")
    return full.where(linked(F.col("text_a"), F.col("text_b"))).select("a", "b")


def with_earlier(lists: DataFrame) -> DataFrame:
    """Add to each list entry the values that come before it in its class's order (at
    most a sketch's prefix).  Two classes meet for the first time in the list before
    which they share none, and only there a pair of them is made."""
    rest = [c for c in lists.columns if c not in ("cid", "common", "value")]
    mine = lists.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("common", "value", *rest))).alias("mine"))
    entries = mine.select("cid", "mine", F.posexplode("mine").alias("i", "v"))
    return entries.select("cid", "v.*", F.slice(F.col("mine.value"), F.lit(1), F.col("i")).alias("earlier"))


def link_classes(lists: DataFrame, active: DataFrame, threshold: float, k: int, width: int) -> DataFrame | None:
    """(cid, comp) of all classes in ``lists`` that are linked."""
    lists = cut(lists.withColumn("order", F.xxhash64("cid", F.lit(1))))
    # the first leader is the class with the fewest values of its own: of near copies, it
    # is the one that most others are like
    held = lists.groupBy("value").agg(F.count("*").alias("held"), F.min_by("cid", F.struct("lone", "cid")).alias("first"))
    lists = cut(lists.join(held.hint("merge"), "value").drop("lone").withColumn("comp", F.col("cid")))
    # random place in 0..1: the leaders of a round are those up to its share of the list
    place = (F.col("order").cast("double") + 2.0**63) / 2.0**64
    links, comps, leaders = None, None, 0
    is_first = F.col("cid") == F.col("first")
    while lists.limit(1).count():
        if leaders == 0:
            leads, follows = is_first, ~is_first
        else:
            leads = (place <= F.lit(float(leaders)) / F.col("held")) & ~is_first
            if leaders > GROWTH:
                leads = leads & (place > F.lit(float(leaders // GROWTH)) / F.col("held"))
            follows = ~is_first
        entries = cut(with_earlier(lists)) if leaders else lists.withColumn("earlier", F.array().cast("array<bigint>"))
        lead = entries.where(leads).select(
            "value", F.col("earlier").alias("lead_earlier"), F.col("cid").alias("lead"), F.col("order").alias("lead_order"), F.col("comp").alias("lead_comp"), F.col("n_shingles").alias("lead_n"), F.col("place").alias("lead_place")
        )
        later = F.lit(True) if leaders == 0 else F.col("order") > F.col("lead_order")
        pairs = (
            entries.where(follows)
            .join(lead.hint("merge"), "value")
            .where(later & (F.col("comp") != F.col("lead_comp")) & enough_left(k, threshold) & ~F.arrays_overlap("earlier", "lead_earlier"))
            .select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b"))
            .distinct()
        )
        found = cut(_verify(pairs, active, threshold, k, width))
        # lists whose members have all led, or are all in one component, are done
        lists = lists.where(F.col("held") > max(2, leaders))
        if found.limit(1).count():
            links = found if links is None else links.union(found)
            comps = components(links)
            lists = lists.drop("comp").join(comps.hint("merge"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
            mixed = lists.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("value")
            lists = cut(lists.join(mixed.hint("merge"), "value", "left_semi"))
        leaders = GROWTH if leaders == 0 else leaders * GROWTH
    return comps


def _labels(base: DataFrame, rows: DataFrame, threshold: float, width: int) -> DataFrame:
    """(set key, comp) of the classes with several rows or with links."""
    named = rows.where(F.col("n_shingles") > 0).groupBy(*KEY).agg(F.min("doc_id").alias("cid"), F.first("sketch").alias("sketch"), F.count("*").alias("rows"))
    classes = cut(named.where(F.col("cid").isNotNull()))
    scouted = cut(prefixes(classes, SCOUT, threshold).select("cid").distinct())
    texts = checked_join(base.withColumnRenamed("doc_id", "cid"), scouted, "cid", "left_semi")
    # a repeated id has one active row per distinct text
    active = cut(add_sketch(texts, SKETCH, width=width).where(F.col("n_shingles") > 0).select("cid", "n_shingles", "sketch", "text"))
    lists = prefixes(active.select("cid", "n_shingles", "sketch"), SKETCH, threshold)
    comps = link_classes(lists, active, threshold, SKETCH, width)
    labelled = classes.select(*KEY, "cid", "rows")
    if comps is not None:
        labelled = labelled.join(comps.hint("merge"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    else:
        labelled = labelled.withColumn("comp", F.col("cid"))
    # only classes of several rows or with links say more than the row itself
    return cut(labelled.where((F.col("rows") > 1) | (F.col("comp") != F.col("cid"))).select(*KEY, "comp"))


def group(df: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.75, width: int = WIDTH) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept."""
    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with scratch(df.sparkSession) as s:
        rows = cut(add_sketch(base, SCOUT, width=width).drop("text"))
        labelled = s.keep(_labels(base, rows, threshold, width))
        rows = s.keep(rows)
    out = checked_join(rows.drop("sketch"), labelled, KEY, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
