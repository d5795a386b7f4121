"""Operator 7: approximate nearest neighbours by cosine, hierarchical k-means tree.

1. Equal vectors form one class that keeps its ``NEIGHBOURS + 1`` smallest ids,
   which is all that any result can need of it.
2. A tree of k-means centroids is fitted on the ``SAMPLE`` classes of smallest
   hash (at most ``SAMPLE_BYTES``; the only thing fitted on a sample) on unit
   vectors; every class is then placed in a leaf by descending the tree.
3. A query walks the tree best-bin-first: a priority queue holds the open nodes
   by distance to their centroid, the nearest is expanded, and leaves come out in
   the order in which they are to be visited.
4. Calibration: for up to ``CALIBRATION`` query vectors the exact neighbours are
   found by a pass over all classes; the number of leaves to visit is widened
   until at least ``RECALL`` of those neighbours lie in visited leaves.
5. Queries meet the blocks (at most about ``BLOCK`` classes, so large leaves are
   split) of their leaves; each block returns its best, which are merged.

Scores are the cosine of the original vectors in double precision; only which
vectors are compared is approximate.

Defined cases: rows with a null id, and vectors that are null, empty, zero, hold
null or non-finite components, or differ in length from the most frequent length
(the larger of equals), take no part; rows repeating an id count once per vector;
a query never returns its own id; fewer candidates than ``NEIGHBOURS`` give as
many rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import run_bounds, table, written

# Production parameters.
NEIGHBOURS = 5
SAMPLE, SAMPLE_BYTES = 20_000, 16 << 20
BRANCHES, LEAF_SAMPLE = 8, 64  # children of a node; sampled vectors below which a node is a leaf
CALIBRATION, RECALL = 256, 0.97
BLOCK = 4096
_ROUNDS = 12


def _usable(vector: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(blobs: Iterable[bytes]) -> np.ndarray:
    rows = [np.frombuffer(b, "<f8") for b in blobs]
    return np.stack(rows) if rows else np.empty((0, 0))


class Tree:
    """Nodes in one array: centroid, children, and a leaf number or -1."""

    def __init__(self, points: np.ndarray, seed: int = 7):
        self.centroids: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self._grow(points)
        self.centers = np.stack(self.centroids)

    def _grow(self, points: np.ndarray) -> int:
        node = len(self.centroids)
        self.centroids.append(points.mean(axis=0))
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(points) if len(points) > LEAF_SAMPLE else []
        if len(parts) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
        else:
            self.children[node] = [self._grow(p) for p in parts]
        return node

    def _split(self, points: np.ndarray) -> list[np.ndarray]:
        centers = points[self._rng.choice(len(points), BRANCHES, replace=False)]
        near = None
        for _ in range(_ROUNDS):
            near = ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
            centers = np.stack([points[near == k].mean(axis=0) if (near == k).any() else centers[k] for k in range(BRANCHES)])
        return [points[near == k] for k in range(BRANCHES) if (near == k).any()]

    def place(self, units: np.ndarray) -> np.ndarray:
        """Leaf of each row, by greedy descent."""
        out = np.empty(len(units), np.int64)
        todo = [(0, np.arange(len(units)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            c = self.centers[kids]
            near = ((c**2).sum(axis=1) - 2 * units[rows] @ c.T).argmin(axis=1)
            todo += [(kid, rows[near == k]) for k, kid in enumerate(kids) if (near == k).any()]
        return out

    def visit(self, unit: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order, at most ``most``."""
        distance = ((self.centers - unit) ** 2).sum(axis=1)
        queue, out = [(float(distance[0]), 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (float(distance[kid]), kid))
        return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision, of the original vectors."""
    norms = np.sqrt((queries**2).sum(axis=1))[:, None] * np.sqrt((rows**2).sum(axis=1))[None, :]
    return (queries @ rows.T) / norms


def _best(scores: np.ndarray, ids: list[list[int]], k: int) -> tuple[list[float], list[int], list[int]]:
    """The k best (score, id, row) of one query, ties to the smaller id."""
    if len(scores) > k:
        rows = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        rows = np.arange(len(scores))
    flat = sorted((-float(scores[r]), i, int(r)) for r in rows.tolist() for i in ids[r])[:k]
    return [-s for s, _, _ in flat], [i for _, i, _ in flat], [r for _, _, r in flat]


def vector_classes(vectors: DataFrame, vec_id: str, embedding: str, is_query: Column, k: int) -> DataFrame:
    """``vec`` (doubles as binary), ``ids`` (the k + 1 smallest), ``asked``."""
    usable = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), is_query.alias("asked"))
    usable = usable.filter(F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = usable.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("m")).agg(F.max(F.struct("m", "n")).alias("x"))
    size = sizes.first()["x"]
    usable = usable.filter(F.size("v") == (size["n"] if size else 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, tuple[list[int], bool]] = {}
            offsets = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy() + 0.0  # -0.0 becomes 0.0
            asked = batch.column(2).to_pylist()
            for r, i in enumerate(batch.column(0).to_pylist()):
                key = flat[offsets[r] : offsets[r + 1]].astype("<f8").tobytes()
                ids, any_asked = held.get(key, ([], False))
                if i not in ids:
                    ids = sorted([*ids, i])[: k + 1]
                held[key] = (ids, any_asked or bool(asked[r]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.binary()),
                    pa.array([x for x, _ in held.values()], pa.list_(pa.int64())),
                    pa.array([x for _, x in held.values()], pa.bool_()),
                ],
                names=["vec", "ids", "asked"],
            )

    # A frequent vector leaves one short row per Arrow batch, whatever its count.
    part = usable.mapInArrow(run, "vec binary, ids array<long>, asked boolean")
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    return part.groupBy("vec").agg(merged.alias("ids"), F.max("asked").alias("asked"))


def _placed(classes: DataFrame, tree: Tree) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.place(_unit(_matrix(x.as_py() for x in batch.column(0))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec", "ids", "asked", "leaf"])

    return classes.select("vec", "ids", "asked").mapInArrow(run, "vec binary, ids array<long>, asked boolean, leaf long")


def _calibrated(index: DataFrame, tree: Tree, queries: np.ndarray, k: int) -> int:
    """Leaves to visit so that ``RECALL`` of the exact neighbours of the
    calibration queries are in a visited leaf."""
    if tree.leaves == 1 or len(queries) == 0:
        return tree.leaves

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            scores = _scores(queries, _matrix(x.as_py() for x in batch.column(0)))
            ids, leaf = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            q, s, i, at = [], [], [], []
            for n in range(len(queries)):
                best, own, rows = _best(scores[n], ids, k + 1)
                q += [n] * len(best)
                s += best
                i += own
                at += leaf[rows].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(s), pa.array(i, pa.int64()), pa.array(at, pa.int64())], names=["q", "s", "id", "leaf"])

    every = index.select("vec", "ids", "leaf").mapInArrow(run, "q long, s double, id long, leaf long")
    order = F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), "id", "leaf")))
    near = every.groupBy("q").agg(F.slice(order, 2, k).alias("best")).collect()  # the first is the query's own vector
    ranks = []
    for row in near:
        place = {leaf: n for n, leaf in enumerate(tree.visit(_unit(queries[row["q"]][None])[0], tree.leaves))}
        ranks += [place[x["leaf"]] for x in row["best"]]
    if not ranks:
        return tree.leaves
    return int(np.sort(ranks)[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))))]) + 1


def _asked(index: DataFrame, tree: Tree, visits: int, blocks: dict[int, int]) -> DataFrame:
    """One row per query vector, visited leaf and block of that leaf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                vecs = batch.column(0).slice(k, 64).to_pylist()
                out_v, out_l, out_b = [], [], []
                for v in vecs:
                    for leaf in tree.visit(_unit(np.frombuffer(v, "<f8")[None])[0], visits):
                        for b in range(blocks.get(leaf, 0)):
                            out_v.append(v)
                            out_l.append(leaf)
                            out_b.append(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_l, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out_v, pa.binary())], names=["leaf", "block", "vec"]
                )

    return index.filter("asked").select("vec").mapInArrow(run, "leaf long, block long, vec binary")


def _searched(together: DataFrame, k: int) -> DataFrame:
    """Blocks against their queries: rows are sorted so that a block's classes
    come before its queries; one block is held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[int, int] | None = None
        blobs: list[bytes] = []
        ids: list[list[int]] = []
        rows = None
        for batch in batches:
            leaf, block, kind = (batch.column(c).to_numpy() for c in range(3))
            out_q, out_s, out_i = [], [], []
            for s, e in run_bounds((leaf * (1 << 32) + block) * 2 + kind):
                if (leaf[s], block[s]) != here:
                    here, blobs, ids, rows = (leaf[s], block[s]), [], [], None
                own = batch.column(3).slice(s, e - s).to_pylist()
                if kind[s] == 0:
                    blobs += own
                    ids += batch.column(4).slice(s, e - s).to_pylist()
                    continue
                if not ids:
                    continue
                rows = _matrix(blobs) if rows is None else rows
                for a in range(0, len(own), 256):
                    scores = _scores(_matrix(own[a : a + 256]), rows)
                    for n, v in enumerate(own[a : a + 256]):
                        best, near, _ = _best(scores[n], ids, k + 1)
                        out_q.append(v)
                        out_s.append(best)
                        out_i.append(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_q, pa.binary()), pa.array(out_s, pa.list_(pa.float64())), pa.array(out_i, pa.list_(pa.int64()))],
                names=["vec", "scores", "ids"],
            )

    sorted_ = together.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "kind")
    return sorted_.mapInArrow(run, "vec binary, scores array<double>, ids array<long>")


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of every row that ``is_query`` marks."""
    classes = written(vector_classes(vectors, vec_id, embedding, is_query, k), "tree-classes")
    first = classes.first()
    if first is None:
        none = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return none
    most = min(SAMPLE, SAMPLE_BYTES // len(first["vec"]))
    sample = classes.select("vec", "asked").orderBy(F.xxhash64("vec"), "vec").limit(most).collect()
    tree = Tree(_unit(_matrix(bytes(r["vec"]) for r in sample)))
    index = written(_placed(classes, tree), "tree-index")
    tests = index.filter("asked").orderBy(F.xxhash64("vec"), "vec").limit(CALIBRATION).select("vec").collect()
    visits = _calibrated(index, tree, _matrix(bytes(r["vec"]) for r in tests), k)
    # One count per leaf, of which there are at most as many as sampled vectors.
    counts = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {leaf: -(-n // BLOCK) for leaf, n in counts.items()}
    n_blocks = F.create_map(*[F.lit(x) for leaf, b in blocks.items() if b > 1 for x in (leaf, b)]) if max(blocks.values()) > 1 else None
    block = F.lit(0) if n_blocks is None else F.pmod(F.xxhash64("vec"), F.coalesce(n_blocks[F.col("leaf")], F.lit(1)))
    none = F.lit(None).cast("array<long>")
    together = index.select("leaf", block.cast("long").alias("block"), F.lit(0).alias("kind"), "vec", "ids").unionAll(
        _asked(index, tree, visits, blocks).select("leaf", "block", F.lit(1), "vec", none)
    )
    found = _searched(together, k).select("vec", F.explode(F.arrays_zip("scores", "ids")).alias("x"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("x.scores")).alias("worse"), F.col("x.ids").alias("id")))), 1, k + 1)
    merged = written(found.groupBy("vec").agg(best.alias("best")), "tree-best")

    as_doubles = F.col(embedding).cast("array<double>")
    asked = vectors.filter(is_query).select(F.col(vec_id).cast("long").alias("query_id"), as_doubles.alias("v"))
    asked = asked.filter(F.col("query_id").isNotNull() & _usable(F.col("v"))).distinct()

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = [(np.array(v.as_py(), "<f8") + 0.0).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vecs, pa.binary())], names=["query_id", "vec"])

    keys = asked.mapInArrow(keyed, "query_id long, vec binary")
    mine = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = keys.join(merged, "vec").select("query_id", F.posexplode(mine).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (F.lit(0.0) - F.col("x.worse")).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
