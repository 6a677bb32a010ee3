"""Nearest neighbours by inner product: vantage-point trees per shard, searched in blocks of queries."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import picked, stored

#: Vectors per tree and queries per block, about: what a task holds.
SHARD_ROWS = 8_192
BLOCK_ROWS = 8_192
LEAF_ROWS = 128
#: How far the triangle inequality is relaxed: a subtree is skipped if its bound times this exceeds
#: the distance to beat. One is exact, more is faster.
FACTOR = 1.0
_ROUNDING = 1e-9


def usable(embedding: str) -> Column:
    """Not null, not zero, all components finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(embedding).isNotNull() & fine & F.exists(embedding, lambda x: x != 0)


class Tree:
    """A vantage-point tree over distinct vectors of one length.

    Inner products become distances by one more component, ``sqrt(M^2 - |x|^2)``: with it all
    vectors have length M, and the nearest to ``(q, 0)`` has the largest product. A node keeps the
    distances to its vantage point that occur on either side, which also holds for equal vectors.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        unique, place = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, place.ravel()))
        self.ids, counts = ids[order], np.bincount(place.ravel(), minlength=len(unique))
        self.id_ends = np.cumsum(counts)
        self.vectors = unique.astype(np.float64)
        norms = (self.vectors**2).sum(1)
        self.extra = np.sqrt(np.maximum(norms.max() - norms, 0.0))
        self.norm = float(norms.max())
        self.order, self.nodes = np.arange(len(unique)), []
        self._build(0, len(unique), np.random.default_rng(seed))
        self.vectors, self.extra = self.vectors[self.order], self.extra[self.order]
        del self.norms_

    @property
    def points(self) -> np.ndarray:
        return np.column_stack([self.vectors, self.extra])

    def _build(self, start: int, end: int, rng) -> int:
        """Nodes are (start, end, vantage, near low, near high, far low, far high, near, far)."""
        if not self.nodes:
            self.norms_ = self.points
        me = len(self.nodes)
        self.nodes.append((start, end, -1, 0.0, 0.0, 0.0, 0.0, -1, -1))
        if end - start > LEAF_ROWS:
            part = self.order[start:end]
            vantage = int(part[rng.integers(len(part))])
            away = np.sqrt(((self.norms_[part] - self.norms_[vantage]) ** 2).sum(1))
            ranks = np.argsort(away, kind="stable")
            self.order[start:end], away = part[ranks], away[ranks]
            middle = (end - start) // 2
            near = self._build(start, start + middle, rng)
            far = self._build(start + middle, end, rng)
            self.nodes[me] = (start, end, vantage, away[0], away[middle - 1], away[middle], away[-1], near, far)
        return me

    def __getstate__(self):
        """Vantage points by their new places, so that only the ordered vectors are kept."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        nodes = [(*n[:2], int(place[n[2]]) if n[2] >= 0 else -1, *n[3:]) for n in self.nodes]
        starts = self.id_ends - np.diff(np.concatenate([[0], self.id_ends]))
        return {"vectors": self.vectors.astype(np.float32) if np.all(self.vectors.astype(np.float32) == self.vectors) else self.vectors,
                "extra": self.extra, "nodes": nodes, "ids": self.ids, "starts": starts[self.order], "ends": self.id_ends[self.order], "norm": self.norm}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.vectors = self.vectors.astype(np.float64)

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the ``k`` nearest distinct vectors of each query and all that tie with the last.

        Queries walk down together and part at each node: those inside its ball see the near side first.
        Result rows are padded with -1.
        """
        n = len(queries)
        lengths = (queries**2).sum(1)
        places, scores = np.full((n, k), -1, np.int64), np.full((n, k), -np.inf)
        ties: list[tuple[np.ndarray, np.ndarray]] = []

        def reach(active: np.ndarray) -> np.ndarray:
            """Distance to beat: that of the k-th best product so far, a little more for rounding."""
            worst = scores[active, -1]
            far = np.where(np.isfinite(worst), np.maximum(lengths[active] + self.norm - 2 * worst, 0.0), np.inf)
            return np.sqrt(far) * (1 + _ROUNDING) + _ROUNDING

        def visit(node: int, active: np.ndarray) -> None:
            start, end, vantage, near_low, near_high, far_low, far_high, near, far = self.nodes[node]
            if vantage < 0:
                products = queries[active] @ self.vectors[start:end].T
                slack = _ROUNDING * max(1.0, self.norm)
                tied = np.argwhere(products >= scores[active, -1][:, None] - slack)
                if not len(tied):
                    return
                ties.append((active[tied[:, 0]], start + tied[:, 1]))
                all_scores = np.concatenate([scores[active], products], 1)
                all_places = np.concatenate([places[active], np.broadcast_to(np.arange(start, end), products.shape)], 1)
                best = np.argsort(-all_scores, axis=1, kind="stable")[:, :k]
                scores[active] = np.take_along_axis(all_scores, best, 1)
                places[active] = np.take_along_axis(all_places, best, 1)
                return
            away = np.sqrt(np.maximum(lengths[active] + self.norm - 2 * (queries[active] @ self.vectors[vantage]), 0.0))
            inside = away <= (near_high + far_low) / 2
            for first, second, group in ((near, far, active[inside]), (far, near, active[~inside])):
                for child in (first, second):
                    if not len(group):
                        continue
                    low, high = (near_low, near_high) if child == near else (far_low, far_high)
                    d = away[inside] if first == near else away[~inside]
                    bound = np.maximum(np.maximum(low - d, d - high), 0.0)
                    open_ = group[bound * factor <= reach(group)]
                    if len(open_):
                        visit(child, open_)

        visit(0, np.arange(n))
        rows = np.concatenate([t[0] for t in ties]) if ties else np.zeros(0, np.int64)
        found = np.concatenate([t[1] for t in ties]) if ties else np.zeros(0, np.int64)
        exact = in_order(queries[rows], self.vectors[found])
        kept = exact >= scores[rows, -1] - _ROUNDING * max(1.0, self.norm)
        return np.column_stack([rows, found])[kept], exact[kept]


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1] if len(a) else 0):
        total += a[:, i] * b[:, i]
    return total


def build_index(vectors: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Trees over rows ``(vec_id, embedding)``: a stored row ``(shard, width, tree)`` per shard.

    Rows are dealt out by a hash of id and vector, so shards are even; repeated rows are one.
    Vectors of different lengths get shards of their own.
    """
    rows = vectors.groupBy("width").count().collect()  # one row per length of vectors
    shards = F.lit(1)
    for row in rows:
        shards = F.when(F.col("width") == row.width, -(-row["count"] // shard_rows)).otherwise(shards)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), shards.cast("bigint")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(group["vec_id"].to_numpy(np.int64), np.stack(group["embedding"].to_numpy()))
        return pd.DataFrame({"width": group["width"].iloc[:1], "shard": group["shard"].iloc[:1], "tree": [pickle.dumps(tree)]})

    return stored(dealt.groupBy("width", "shard").applyInPandas(grow, "width int, shard bigint, tree binary"), "vp-trees")


def search(index: DataFrame, queries: DataFrame, k: int, *, factor: float = FACTOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest of every query: ``(query_id, rank, vec_id, score)``.

    Every tree meets every block of queries (a stated query set against all rows, in blocks); a task
    returns at most ``k`` rows per query, and these are ranked per query.
    """
    blocks = max(1, -(-queries.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    packed = stored(queries.withColumn("block", block), "vp-queries")
    spread = index.select("width", "shard", "tree", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    dealt = packed.join(index.select("width", F.col("shard").alias("shard")), "width").select("width", "shard", "block", "vec_id", "embedding")

    def run(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(trees) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree, ids = pickle.loads(trees["tree"].iloc[0]), asked["vec_id"].to_numpy(np.int64)
        matrix = np.stack(asked["embedding"].to_numpy()).astype(np.float64)
        found, scores = tree.search(matrix, k + 1, factor)
        out = ([], [], [])
        order = np.argsort(-scores, kind="stable")
        order = order[np.argsort(found[order, 0], kind="stable")]
        found, scores = found[order], scores[order]
        for q, a, b in zip(*_runs(found[:, 0])):
            names, values = [], []
            for place, score in zip(found[a:b, 1].tolist(), scores[a:b].tolist()):
                own = tree.ids[tree.starts[place] : tree.ends[place]]  # in ascending order
                own = own[own != ids[q]][:k]
                names += own.tolist()
                values += [score] * len(own)
            best = np.lexsort((names, -np.array(values)))[:k]
            out[0].extend([ids[q]] * len(best))
            out[1].extend(np.array(names, np.int64)[best].tolist())
            out[2].extend(np.array(values)[best].tolist())
        return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    pairs = spread.groupBy("width", "shard", "block").cogroup(dealt.groupBy("width", "shard", "block"))
    near = pairs.applyInPandas(run, "query_id bigint, vec_id bigint, score double")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], starts, np.append(starts[1:], len(keys))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, *, id_column: str = "vec_id", vector_column: str = "embedding",
    factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Index all rows and search for those that ``is_query`` (on ``vec_id``) picks; see ``search``.

    Ranks start at 1; equal scores go to the smaller id; a query's own id is no candidate. Vectors
    that are null, zero or hold null or non-finite components, and rows with a null id, take no
    part. Repeated rows count once. Several different vectors of one id share its list: the neighbours
    of each are ranked together, and a row near to more than one of them comes once for each. An empty
    table gives an empty result; other columns are not looked at.
    """
    rows = picked(vectors, vec_id=id_column, embedding=vector_column).where(usable("embedding") & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.size("embedding").alias("width"))
    rows = stored(rows.distinct(), "vp-vectors")
    return search(build_index(rows, shard_rows=shard_rows), rows.where(is_query), k, factor=factor, block_rows=block_rows)

