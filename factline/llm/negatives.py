"""Hard-negative mining with cover trees over norm-augmented candidates.

With one more component, sqrt(M^2 - |x|^2), all candidates of a block have norm M, and the distance of a candidate to an anchor (with a
zero there) tells their inner product: d^2 = |q|^2 + M^2 - 2 q.x. A cover tree splits a block's candidates level by level: a node's
children are candidates further apart than the level's radius that cover the node's candidates within it. Each node keeps the
greatest distance to a candidate below it, which bounds all their inner products. A search takes the nodes level by level, leaves those whose bounds lie
outside its window, and visits the remaining leaves best-first, computing their scores exactly, until no bound can better what it has.

Candidates are dealt to blocks of bounded size around pivots (the nearest of a bounded sample of rows), so that a block's tree has small
radii where the data allow it; each block's tree is built once. Anchors, a stated part of the rows, are dealt to batches, and each batch
meets each tree in a task of its own: first for the positives, then for the windows. The best of each task are merged by a ranked window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, with_row_id

#: Components are held to this, so that scores of up to 2^11 components fit 64 bits.
LIMIT = 1 << 26
#: Ratio of the radii of two levels.
BASE = 1.3
_LEAF = 48
_VISIT = 16  # leaves scored at a time


class CoverTree:
    """Candidates of a block in leaf order. ``nodes``: center (place), first child, children, begin, end of its candidates; ``radius`` is the greatest distance to one of them."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.vectors, self.order, self.nodes, self.radius = vectors, order, nodes, radius
        self.squares = (vectors * vectors).sum(axis=1)
        self.top = self.squares.max() if len(vectors) else 0.0

    @classmethod
    def build(cls, vectors: np.ndarray) -> "CoverTree":
        """``vectors``: one row of whole numbers (as doubles) per candidate."""
        squares = (vectors * vectors).sum(axis=1)
        rest = np.sqrt(np.maximum(squares.max() - squares, 0.0))
        points = np.column_stack([vectors, rest])
        norms = (points * points).sum(axis=1)

        def distances(center: int, among: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(norms[among] + norms[center] - 2.0 * (points[among] @ points[center]), 0.0))

        # breadth first, so that the children of a node lie side by side
        everything = np.arange(len(vectors))
        nodes, radius, members = [[0, -1, 0]], [0.0], [everything]
        away = [distances(0, everything)]
        at = 0
        while at < len(nodes):
            among, d = members[at], away[at]
            reach = float(d.max())
            radius[at] = reach
            if len(among) > _LEAF and reach > 0.0:
                level, first = reach / BASE, len(nodes)
                center, left, dist = nodes[at][0], among, d
                while len(left):
                    inside = dist <= level
                    inside |= left == center
                    nodes.append([center, -1, 0])
                    radius.append(0.0)
                    members.append(left[inside])
                    away.append(dist[inside])
                    left = left[~inside]
                    if len(left):
                        center = int(left[0])
                        dist = distances(center, left)
                nodes[at][1:] = [first, len(nodes) - first]
                members[at] = away[at] = None
            at += 1
        # candidates in leaf order, each node's side by side
        order, begin, end = [], [0] * len(nodes), [0] * len(nodes)
        stack, n = [(0, False)], 0
        while stack:
            k, seen = stack.pop()
            if seen:
                end[k] = n
                continue
            begin[k] = n
            stack.append((k, True))
            if nodes[k][2]:
                stack.extend((c, False) for c in range(nodes[k][1] + nodes[k][2] - 1, nodes[k][1] - 1, -1))
            else:
                order.append(members[k])
                n += len(members[k])
        order = np.concatenate(order)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table = np.array([[place[c], f, m, b, e] for (c, f, m), b, e in zip(nodes, begin, end)], np.int64)
        return cls(vectors[order], order, table, np.array(radius))

    def leaves(self, q: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, upper bound) of the leaves that may hold scores in [low, high], best bound first."""
        qq, out, bounds = float(q @ q), [], []
        slack = 1e-9 * (qq + self.top) + 1e-6  # for rounding; scores themselves are whole numbers
        level = np.zeros(1, np.int64)
        while len(level):
            center = self.nodes[level, 0]
            d = np.sqrt(np.maximum(qq + self.top - 2.0 * (self.vectors[center] @ q), 0.0))
            r = self.radius[level]
            upper = (qq + self.top - np.maximum(d - r, 0.0) ** 2) / 2 + slack
            lower = (qq + self.top - (d + r) ** 2) / 2 - slack
            keep = (upper >= low) & (lower <= high)
            level, upper = level[keep], upper[keep]
            inner = self.nodes[level, 2] > 0
            out.append(level[~inner])
            bounds.append(upper[~inner])
            level, n = level[inner], self.nodes[level[inner], 2]
            level = np.repeat(self.nodes[level, 1] - np.cumsum(n) + n, n) + np.arange(n.sum())
        leaf, bound = np.concatenate(out), np.minimum(np.concatenate(bounds), high)
        best = np.argsort(-bound, kind="stable")
        return leaf[best], bound[best]


class Search:
    """Searches of one anchor in one tree; scores of visited leaves are kept for its other windows."""

    def __init__(self, tree: CoverTree, q: np.ndarray):
        # components beyond the candidates' meet zeros
        self.tree, self.q = tree, np.pad(q, (0, max(0, tree.vectors.shape[1] - len(q))))[:tree.vectors.shape[1]]
        self.scores, self.known = np.zeros(len(tree.vectors), np.int64), np.zeros(len(tree.nodes), bool)
        self.small = float(self.q @ self.q) * tree.top < 2.0 ** 100  # then all partial sums are whole in doubles

    def _score(self, at: np.ndarray) -> np.ndarray:
        v = self.tree.vectors[at]
        return (v @ self.q).astype(np.int64) if self.small else v.astype(np.int64) @ self.q.astype(np.int64)

    def best(self, k: int, allowed: np.ndarray, rank: np.ndarray, low: int | None = None, high: int | None = None) -> list[int]:
        """Places of the first ``k`` allowed candidates with scores in [low, high], by score descending and rank ascending."""
        tree = self.tree
        leaf, bound = tree.leaves(self.q, -np.inf if low is None else low, np.inf if high is None else high)
        found, floor = np.zeros(0, np.int64), -np.inf
        for lo in range(0, len(leaf), _VISIT):
            some = leaf[lo:lo + _VISIT][bound[lo:lo + _VISIT] >= floor]
            if not len(some):
                break
            n = tree.nodes[some, 4] - tree.nodes[some, 3]
            at = np.repeat(tree.nodes[some, 3] - np.cumsum(n) + n, n) + np.arange(n.sum())
            new = at[np.repeat(~self.known[some], n)]
            if len(new):
                self.scores[new] = self._score(new)
                self.known[some] = True
            s, take = self.scores[at], allowed[at]
            if low is not None:
                take = take & (s >= low) & (s <= high)
            found = np.concatenate([found, at[take]])
            if len(found) > k:
                found = found[np.lexsort((rank[found], -self.scores[found]))[:k]]
            if len(found) == k:
                floor = self.scores[found].min()
        return found[np.lexsort((rank[found], -self.scores[found]))].tolist()


# ---------------------------------------------------------------- tables

def candidates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(_row, vec_id, label, vector) of the rows that take part: label and vector not null, all components finite.

    Where vec_id is divisible by 7, the label becomes (label + 1) % 10. A component x becomes floor(256 x), held to +-2^26.
    """
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(c.cast("double") * 256), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    label = F.col(label_col).cast("long")
    vec_id = F.col(id_col).cast("long")
    rows = rows.select(vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       F.when(~bad, whole).alias("vector"))
    return with_row_id(rows).filter("label is not null and vector is not null")


def _matrix(vectors, width: int | None = None) -> np.ndarray:
    """Rows of whole numbers as doubles, shorter ones followed by zeros."""
    width = max((len(v) for v in vectors), default=0) if width is None else width
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


_TREE = "block int, rows binary, ids binary, labels binary, width int, vectors binary, nodes binary, radius binary"
_NO_ID = 2**63 - 1  # stands for a null vec_id: the largest


def _plant(pdf: pd.DataFrame) -> pd.DataFrame:
    """The tree of one block."""
    pdf = pdf.sort_values("_row")
    tree = CoverTree.build(_matrix(pdf["vector"].tolist()))
    column = lambda c: pdf[c].to_numpy(np.int64)[tree.order].tobytes()
    return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "rows": [column("_row")], "ids": [column("vec_id")], "labels": [column("label")],
                         "width": [tree.vectors.shape[1]], "vectors": [tree.vectors.astype(np.int32).tobytes()], "nodes": [tree.nodes.tobytes()],
                         "radius": [tree.radius.tobytes()]})


def plant_trees(found: DataFrame, block_rows: int = 8192, pivots: int = 256) -> tuple[DataFrame, int]:
    """(trees, number of blocks): a cover tree per block of about ``block_rows`` of the candidates ``found``.

    At most ``pivots`` rows, picked by a hash, are the pivots; all rows are dealt to the nearest. A pivot with more rows than a block has
    several blocks, dealt by a hash of the row.
    """
    total = found.count()
    picked = found.orderBy(F.xxhash64("vec_id", "vector"), "_row").limit(max(1, min(pivots, -(-total // block_rows)))).collect()
    centers = _matrix([r["vector"] for r in picked])

    def deal(batches):
        half = (centers * centers).sum(axis=1) / 2
        for pdf in batches:
            for lo in range(0, len(pdf), 4096):
                part = pdf.iloc[lo:lo + 4096]
                nearest = _matrix([v[:centers.shape[1]] for v in part["vector"]], centers.shape[1]) @ centers.T - half
                yield part.assign(pivot=nearest.argmax(axis=1).astype(np.int32))

    kind = "_row long, vec_id long, label long, vector array<int>"
    dealt = cut(found.withColumn("vec_id", F.coalesce("vec_id", F.lit(_NO_ID))).mapInPandas(deal, kind + ", pivot int"), "negatives-dealt")
    sizes = sorted((r["pivot"], r["n"]) for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect())  # at most ``pivots`` rows
    parts = [(p, -(-n // block_rows)) for p, n in sizes]
    first = np.cumsum([0] + [n for _, n in parts]).tolist()
    table = F.create_map(*[F.lit(x) for (p, n), f in zip(parts, first) for x in (p, f)]) if parts else None
    split = F.create_map(*[F.lit(x) for p, n in parts for x in (p, n)]) if parts else None
    block = F.element_at(table, F.col("pivot")) + F.pmod(F.xxhash64("_row"), F.element_at(split, F.col("pivot"))) if parts else F.lit(0)
    trees = dealt.withColumn("block", block.cast("int")).groupBy("block").applyInPandas(_plant, _TREE)
    return cut(trees, "negatives-trees"), first[-1]


_BATCH = "batch int, rows binary, ids binary, labels binary, vectors array<array<int>>, scores array<array<long>>"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """The anchors of one batch in one record."""
    column = lambda c: [pdf[c].to_numpy(np.int64).tobytes()]
    return pd.DataFrame({"batch": pdf["batch"].iloc[:1].to_numpy(), "rows": column("_row"), "ids": column("vec_id"), "labels": column("label"),
                         "vectors": [list(pdf["vector"])], "scores": [list(pdf["scores"])]})


def _meet(trees: DataFrame, blocks: int, anchors: DataFrame, batches: int, search, kind: str) -> DataFrame:
    """``search`` of every batch of anchors in every tree, each pair in a group of its own."""
    packed = cut(anchors.withColumn("batch", F.pmod(F.xxhash64("_row", F.lit(1)), F.lit(batches)).cast("int")).groupBy("batch").applyInPandas(_pack, _BATCH), "negatives-anchors")
    left = trees.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    right = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0)))))
    keys = ["block", "batch"]

    def cell(tree: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(tree) and len(batch):
            t, b = tree.iloc[0], batch.iloc[0]
            vectors = np.frombuffer(t["vectors"], np.int32).reshape(-1, t["width"]) if t["width"] else np.zeros((len(t["rows"]) // 8, 0))
            planted = CoverTree(vectors.astype(np.float64), None, np.frombuffer(t["nodes"], np.int64).reshape(-1, 5), np.frombuffer(t["radius"], np.float64))
            rows, ids, labels = (np.frombuffer(t[c], np.int64) for c in ("rows", "ids", "labels"))
            rank = np.argsort(np.lexsort((rows, ids)))
            for row, vec_id, label, q, scores in zip(*(np.frombuffer(b[c], np.int64).tolist() for c in ("rows", "ids", "labels")), b["vectors"], b["scores"]):
                found = Search(planted, np.asarray(q, np.float64))
                for extra, at in search(found, labels == label, rows == row, rank, scores):
                    out += [(row, vec_id, *extra, int(found.scores[k]), int(ids[k]), int(rows[k])) for k in at]
        return pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, kind)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, every: int = 100, block_rows: int = 8192,
         batch_rows: int = 4096, pivots: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose vec_id is divisible by ``every``.

    Rows with a null label, a null vector or any null or non-finite component take no part. A score is the inner product of the whole
    components; a shorter vector counts as followed by zeros, an empty one scores 0 with all; higher scores come first, ties by smaller vec_id (a null one
    last), then by the row's place in the table. A null vec_id is no anchor. Repeated rows are rows like others, anchors each, and each other's positives; an anchor is
    never its own. Negatives are the first of other labels with low * p <= 100 * n <= high * p. Other columns aren't read. An empty table gives
    an empty result.
    """
    found = candidates(rows, id_col, vector_col, label_col)
    trees, blocks = plant_trees(found, block_rows, pivots)
    anchors = cut(found.filter(F.col("vec_id") % every == 0), "negatives-queries")
    batches = max(1, -(-anchors.count() // batch_rows))

    def closest(search: Search, same, own, rank, _):
        yield (), search.best(positives, same & ~own, rank)

    near = _meet(trees, blocks, anchors.withColumn("scores", F.array().cast("array<long>")), batches, closest,
                 "anchor_row long, anchor_id long, score long, id long, row long")
    order = [F.desc("score"), F.col("id"), F.col("row")]
    place = lambda w: F.row_number().over(w.orderBy(*order))
    near = cut(near.withColumn("k", place(Window.partitionBy("anchor_row"))).filter(F.col("k") <= positives), "negatives-positives")

    def hard(search: Search, same, own, rank, scores):
        for p in dict.fromkeys(np.asarray(scores).tolist()):
            yield (p,), search.best(negatives, ~same, rank, -(-low * p // 100), high * p // 100)

    # one search for each score: positives that tie have the same negatives
    asked = near.groupBy(F.col("anchor_row").alias("_row")).agg(F.collect_list("score").alias("scores"))  # at most ``positives``
    far = _meet(trees, blocks, anchors.join(asked, "_row"), batches, hard,
                "anchor_row long, anchor_id long, positive_score long, score long, id long, row long")
    far = far.withColumn("rank", place(Window.partitionBy("anchor_row", "positive_score"))).filter(F.col("rank") <= negatives)
    left = near.select("anchor_row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = lambda c: F.nullif(F.col(c), F.lit(_NO_ID)).alias(c)
    right = far.select("anchor_row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return left.join(right, ["anchor_row", "positive_score"]).select(
        "anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")
