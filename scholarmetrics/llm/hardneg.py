"""Operator 12: hard negatives for labelled vectors by exact search in cover trees.

Candidates are augmented by one coordinate that gives all of them the largest norm, so a
large inner product is a small distance and the triangle inequality holds.  The table is
dealt to slabs of bounded size; each slab's distinct vectors form a cover tree, which is
written as one row of a table.

- Tree (``Tree``): the points of a node lie within its covering radius; its children are a
  greedy net of half that radius, the node's own point first, and a child's radius is the
  largest distance that its own points have.  Copies of a vector are one point, whatever
  their number, of which each label keeps the smallest ids.
- Search (``Tree.search``): a node's point and radius bound the inner products of all its
  points.  Nodes outside the score window, or below the k-th best score found, are
  skipped; the rest are opened best bound first, all children of a node at once, and each
  point is scored exactly, in integers.
- Anchors meet every slab: they are sorted behind the slab's row in its partition and
  stream past its tree in blocks, so a task holds one tree and one block.  Each slab gives
  the best ``k`` per anchor and window, and a ranked window over the anchors (Spark keeps
  the best ``k`` of each task before the shuffle) merges them.

``mine`` searches twice: for each anchor's positives (the best rows of its label), then,
in the windows that the positives' scores span, for the best rows of other labels.

Components are integers by then (``quantized``); inner products are exact in doubles below
2**53 and are taken in Python integers beyond, scores beyond 64 bits being cut to them.
Vectors are compared over their common length.

Cases: rows with a null label, a null id, a null or empty vector, or a null or non-finite
component take no part; rows are told apart by their place in the table, so rows that
repeat an id are candidates (and anchors) of their own, but never partners of an anchor
with that id; equal scores go by id; an anchor without positives has no rows; an empty
table gives an empty table; other columns take no part.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmetrics.llm.common import cut

#: Rows of a slab (a tree is built from at most about so many points at once).
SLAB = 8192
#: A slab is not made smaller than this to occupy more tasks.
LEAST_SLAB = 512
POSITIVES, NEGATIVES = 5, 3
#: Window of negative scores, in percent of the positive's.
LOW, HIGH = 50, 95
ANCHOR_EVERY = 50

#: Centres of a net that are chosen and measured together.
NET = 256
#: Anchors whose scores with a root's children are taken together.
BLOCK = 256

_EXACT = float(2**53)
_MOST = np.iinfo(np.int64).max


def quantized(
    table: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256, label_of: Column | None = None
) -> DataFrame:
    """``(uid, id, label, vec)``: whole rows only, components as floor(scale * x)."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = table.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.size(vector) > 0) & finite)
    return rows.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(key).cast("bigint").alias("id"),
        (F.col(label) if label_of is None else label_of).cast("bigint").alias("label"),
        scaled.cast("array<bigint>").alias("vec"),
    )


def matrix(vecs: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list array as doubles, zeros behind shorter ones."""
    n = vecs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vecs.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(n), max(width, int(n.max(initial=0)))))
    out[np.arange(out.shape[1]) < n[:, None]] = values
    return out


class Tree:
    """Cover tree over the distinct vectors of a slab.

    Nodes are listed parents first; the children of a node are consecutive.  ``point`` is a
    node's vector, ``radius`` its covering radius in the augmented space (0: the point
    alone), ``child`` the range of its children.  ``own`` ranges over the members of a
    point: pairs of label and id, sorted by id, the first ``keep`` of each label."""

    FIELDS = ("points", "norms", "point", "radius", "child", "own", "ids", "labels")

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray, keep: int) -> Tree:
        self = cls()
        points, of = np.unique(vecs, axis=0, return_inverse=True)
        of = of.reshape(-1)
        order = np.lexsort((ids, labels, of))
        of, labels, ids = of[order], labels[order], ids[order]
        fresh = np.append(True, (of[1:] != of[:-1]) | (labels[1:] != labels[:-1])) if len(of) else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(of)), 0))
        few = np.arange(len(of)) - begin < keep
        of, labels, ids = of[few], labels[few], ids[few]
        order = np.lexsort((ids, of))
        self.ids, self.labels = ids[order], labels[order]
        self.own = np.searchsorted(of[order], np.arange(len(points) + 1))
        self.points, self.norms = points, np.sqrt((points**2).sum(1))
        most = self.norms.max(initial=0.0)
        spare = np.sqrt(np.maximum(0.0, most**2 - self.norms**2))
        self._grow(np.column_stack([points, spare]))
        return self

    def _grow(self, x: np.ndarray) -> None:
        """Node by node: a node's points are dealt to a net of half its radius."""
        square = (x**2).sum(1)
        slack = 1e-13 * square.max(initial=0.0)  # rounding: a radius is never too small

        def far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, square[a][:, None] + square[b] - 2.0 * (x[a] @ x[b].T)) + slack)

        point, radius, child = [np.zeros(0, np.int64)], [np.zeros(0)], {}
        todo, made = [], 0
        if len(x):
            d = far(np.arange(len(x)), np.zeros(1, np.int64))[:, 0]
            point.append(np.zeros(1, np.int64))
            radius.append(np.array([d.max() if len(x) > 1 else 0.0]))
            todo, made = [(0, 0, np.arange(len(x)), d)], 1
        while todo:
            node, centre, members, d = todo.pop()
            if len(members) == 1:
                continue
            reach = d.max() / 2
            near = (d <= reach) | (members == centre)
            nets = [(np.array([centre]), members[near], np.zeros(near.sum(), np.int64), d[near])]
            left = members[~near]
            while len(left):
                block = left[:NET]
                apart, covered, chosen = far(block, block) > reach, np.zeros(len(block), bool), []
                for i in range(len(block)):
                    if not covered[i]:
                        chosen.append(i)
                        covered |= ~apart[i]
                away = far(left, block[chosen])
                away[chosen] = np.inf
                away[chosen, np.arange(len(chosen))] = 0.0
                of = (away <= reach).argmax(1)
                own = away[np.arange(len(left)), of]
                has = own <= reach
                nets.append((block[chosen], left[has], of[has], own[has]))
                left = left[~has]
            if len(nets) == 1:  # rounding keeps the points together: each a leaf
                nets = [(members, members, np.arange(len(members)), np.zeros(len(members)))]
            first = made
            for centres, inside, of, away in nets:
                order = np.argsort(of, kind="stable")
                inside, of, away = inside[order], of[order], away[order]
                begin = np.searchsorted(of, np.arange(len(centres) + 1))
                size = np.diff(begin)
                point.append(centres)
                radius.append(np.where(size > 1, np.maximum.reduceat(away, begin[:-1]), 0.0))
                for k in np.flatnonzero(size > 1).tolist():
                    part = slice(begin[k], begin[k + 1])
                    todo.append((made + k, int(centres[k]), inside[part], away[part]))
                made += len(centres)
            child[node] = (first, made)
        self.point, self.radius = np.concatenate(point).astype(np.int64), np.concatenate(radius)
        self.child = np.zeros((made, 2), np.int64)
        for node, span in child.items():
            self.child[node] = span

    def dump(self) -> bytes:
        out = io.BytesIO()
        fields = {f: getattr(self, f) for f in self.FIELDS}
        for kind in (np.int64, np.int32, np.int16):  # whole numbers, as narrow as they fit
            if np.abs(self.points).max(initial=0) < np.iinfo(kind).max:
                fields["points"] = self.points.astype(kind)
        np.savez(out, **fields)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        self = cls()
        with np.load(io.BytesIO(data), allow_pickle=False) as held:
            for f in cls.FIELDS:
                setattr(self, f, held[f])
        self.points = self.points.astype(float)
        return self

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows of ``q`` with the points at ``at``."""
        x = self.points[at]
        width = min(x.shape[1], q.shape[1])
        x, q = x[:, :width], q[:, :width]
        if np.sqrt((q * q).sum(1)).max(initial=0.0) * self.norms.max(initial=0.0) < _EXACT:
            return q @ x.T
        whole = [[int(a) for a in row] for row in x]
        dot = lambda a, b: max(-_MOST, min(_MOST, sum(i * j for i, j in zip(a, b))))
        return np.array([[dot([int(v) for v in row], b) for b in whole] for row in q], object)

    def search(self, q: np.ndarray, label: int, same: bool, k: int, own_id: int, low=None, high=None, top=None) -> list[tuple[int, int]]:
        """The best ``k`` (score, id) of rows with that label (or any other), a score from
        ``low`` to ``high`` and another id: higher scores first, then smaller ids.
        ``top``: the scores of the root's children, if they are known."""
        if not len(self.point):
            return []
        norm = float(np.sqrt((q * q).sum()))
        best: list[tuple] = []  # (score, -id), the worst first

        def offer(score, at: int) -> None:
            taken = 0
            for m in range(self.own[at], self.own[at + 1]):
                if (self.labels[m] == label) == same and self.ids[m] != own_id:
                    entry = (score, -int(self.ids[m]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    taken += 1
                    if taken == k:
                        break

        def visit(nodes: np.ndarray, s: np.ndarray, skip_first: bool) -> None:
            """Offer the nodes' points and queue the nodes that may hold more."""
            fits = np.ones(len(nodes), bool)
            if low is not None:
                fits = (s >= low) & (s <= high)
            if len(best) == k:
                fits &= s >= best[0][0]
            if skip_first:  # a node's own point is its first child's
                fits[0] = False
            fits = np.flatnonzero(fits)
            for i in fits[np.argsort(-s[fits], kind="stable")].tolist():
                if len(best) == k and s[i] < best[0][0]:
                    break
                offer(s[i], int(self.point[nodes[i]]))
            wide = np.flatnonzero(self.radius[nodes] > 0)
            spread = norm * self.radius[nodes[wide]] * (1 + 1e-9) + 1e-6
            bound, least = s[wide] + spread, s[wide] - spread
            for i, upper, lower in zip(wide.tolist(), bound.tolist(), least.tolist()):
                if (low is None or (upper >= low and lower <= high)) and (len(best) < k or upper >= best[0][0]):
                    heapq.heappush(queue, (-upper, int(nodes[i])))

        queue: list[tuple[float, int]] = []
        root = np.zeros(1, np.int64)
        visit(root, self.scores(q[None], self.point[root])[0], False)
        while queue:
            upper, node = heapq.heappop(queue)
            if len(best) == k and -upper < best[0][0]:
                break
            nodes = np.arange(*self.child[node])
            visit(nodes, top if node == 0 and top is not None else self.scores(q[None], self.point[nodes])[0], True)
        return [(int(s), -i) for s, i in sorted(best, reverse=True)]


def forest(rows: DataFrame, keep: int, slab: int = SLAB) -> DataFrame:
    """``(slab, tree)``: every row in one of the slabs' trees (a written table).  Rows are
    dealt by a hash of their place, so slabs are even whatever the rows are."""
    n = rows.count()
    tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, n // LEAST_SLAB))
    slabs = max(-(-n // slab), tasks)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        tree = Tree.build(ids, labels, matrix(table.column("vec").combine_chunks()), keep)
        return pa.table({"slab": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([tree.dump()], pa.binary())})

    dealt = rows.withColumn("slab", F.pmod(F.xxhash64("uid"), F.lit(slabs)))
    return cut(dealt.groupBy("slab").applyInArrow(build, "slab bigint, tree binary"))


_FOUND = "uid bigint, place int, score bigint, id bigint"
_WINDOWS = "array<struct<place:int,positive:bigint>>"


def search(trees: DataFrame, anchors: DataFrame, same: bool, k: int, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(uid, place, score, id, rank)``: for each anchor and window the best ``k`` rows of
    all slabs.

    ``anchors``: ``uid``, ``id``, ``label``, ``vec`` and ``windows``, an array of (``place``,
    ``positive``): scores from ``low`` to ``high`` percent of ``positive``, or any if it is
    null."""
    last = trees.agg(F.max("slab")).first()[0]
    last = -1 if last is None else last
    own = ("uid", "id", "label", "vec", "windows")
    each = anchors.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(last, 0)).cast("bigint"))).alias("slab"), *own)
    tagged = trees.select(
        "slab", F.lit(0).alias("kind"), "tree", *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in own]
    ).unionByName(each.select("slab", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), *own))

    def found(tree: Tree, part: pa.Table) -> Iterator[tuple]:
        """The hits of a block of anchors in one slab."""
        q = matrix(part.column("vec").combine_chunks())
        tops = tree.scores(q, tree.point[np.arange(*tree.child[0])]) if len(tree.point) else [None] * len(q)
        rows = part.drop_columns(["vec"]).to_pylist()
        for row, vec, top in zip(rows, q, tops):
            for w in row["windows"]:
                p = w["positive"]
                span = (None, None) if p is None else (-(-low * p // 100), high * p // 100)
                for score, i in tree.search(vec, row["label"], same, k, row["id"], *span, top):
                    yield row["uid"], w["place"], score, i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, slab = None, None
        for batch in batches:
            out: list[tuple] = []
            table = pa.Table.from_batches([batch])
            slabs, kinds = table.column("slab").to_numpy(), table.column("kind").to_numpy()
            edges = np.flatnonzero(np.append(True, (slabs[1:] != slabs[:-1]) | (kinds[1:] != kinds[:-1]))).tolist()
            for a, b in zip(edges, [*edges[1:], len(slabs)]):
                if kinds[a] == 0:
                    tree, slab = Tree.load(table.column("tree")[a].as_py()), slabs[a]
                elif slabs[a] == slab:  # a slab without rows has no tree
                    for c in range(a, b, BLOCK):
                        out += found(tree, table.select(["uid", "id", "label", "vec", "windows"]).slice(c, min(BLOCK, b - c)))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["uid", "place", "score", "id"])

    hits = tagged.repartition("slab").sortWithinPartitions("slab", "kind").mapInArrow(run, _FOUND)
    order = Window.partitionBy("uid", "place").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, slab: int = SLAB) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from
    ``quantized`` rows.  ``is_anchor`` reads ``id`` and ``label``."""
    rows = cut(rows)
    trees = forest(rows, max(positives, negatives) + 1, slab)
    anchors = rows.where(is_anchor)
    any_score = F.expr(f"CAST(array(named_struct('place', 0, 'positive', NULL)) AS {_WINDOWS})")
    near = cut(search(trees, anchors.withColumn("windows", any_score), True, positives))
    # an anchor has at most `positives` rows in near
    windows = near.groupBy("uid").agg(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("score").alias("positive"))).alias("windows"))
    far = search(trees, anchors.join(windows, "uid"), False, negatives)
    pairs = near.select("uid", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    hits = far.select("uid", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select("uid", F.col("id").alias("anchor_id"))
    return pairs.join(hits, ["uid", "place"]).join(names, "uid").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
