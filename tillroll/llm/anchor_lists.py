"""Operator 13: hard-negative mining over anchor-clustered shared lists.

Inner products are searched exactly, as MAXIMUS does for many queries at once.
Anchors (rows whose id is divisible by ``ANCHOR_STEP``) are clustered by direction.
For a cluster with centre c whose members lie within the angle t of it, no inner
product of a member a with a candidate v exceeds

    |a| * |v| * cos(max(0, angle(v, c) - t)),

so the candidates are sorted by |v| * cos(...) once per cluster, and every member
walks that list from the top.  It stops where |a| times the next bound is below
the last score it still needs (``_certified``): no later row can enter its result.

On the cluster, anchors are numbered by (cluster, id) and cut into chunks, and
candidates are dealt by a hash of their id into shards; a task gets one chunk and
one shard, holds the lists of the chunk's clusters over that shard, and returns
each anchor's first rows within it.  The first rows over all shards are the
result.  So no task holds more than ``CHUNK_ANCHORS`` anchors and about
``SHARD_ROWS`` candidates, and a cluster, label or vector of any share of the rows
is spread like all others.  Anchors are a fixed share of the rows, so the work of an exact
search grows with the square of the table where the bounds do not end the walks.

Two walks: an anchor's positives are its first rows of its own label; for each
positive, its negatives are the first rows of other labels whose score lies
between ``LOWEST`` and ``HIGHEST`` percent of the positive's.

The cluster centres are fitted on a bounded sample of ``SAMPLE`` anchors (the
smallest hashes of their ids).  They decide how soon walks end, never what is found.

Arithmetic: components become floor(256 * x) as doubles; scores are exact integers
while |a| * |v| stays below 2**53, and beyond that they are summed as Python integers
(which must fit 64 bits).

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; rows that repeat an id count once, the one with the
smallest label, then the smallest vector; vectors of different lengths are filled
with zeros; zero vectors take part with scores of zero; ties go to the smaller id;
an anchor without a positive, or a positive without a negative, has no row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import table, written
from tillroll.operators.ranking import row_number_global

# Production parameters.
ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90
SAMPLE = 2048
CLUSTER_ANCHORS = 32
CHUNK_ANCHORS = 1024
SHARD_ROWS = 8192
STRIDE = 256
_EXACT = 2.0**53
_NONE = np.iinfo(np.int64).min


def prepared(rows: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label (changed where the id is divisible by 7)
    and the whole-numbered vector."""
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    whole = F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("double"))
    return (
        rows.filter(usable & finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(label.alias("label"), whole.alias("v")).alias("x"))
        .groupBy("vec_id").agg(F.min("x").alias("x"))
        .select("vec_id", "x.label", "x.v")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows of a matrix, filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(sizes) else np.zeros(0)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _units(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions (zero for a zero vector) and lengths of the rows."""
    norms = np.sqrt((m * m).sum(axis=1))
    return m / np.where(norms > 0, norms, 1.0)[:, None], norms


def _centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from rows spread over the sample."""
    units, _ = _units(sample)
    centres = units[np.linspace(0, len(units) - 1, count).astype(int)]
    for _ in range(rounds):
        near = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        empty = np.bincount(near, minlength=count) == 0
        centres = np.where(empty[:, None], centres, _units(sums)[0])
    return centres


def clustered(anchors: DataFrame) -> DataFrame:
    """Anchors with the cluster of the nearest centre."""
    sample = anchors.select("v", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if sample.num_rows == 0:
        return anchors.withColumn("cluster", F.lit(0))
    m = _matrix(sample.column("v"))
    centres = _centres(m, -(-len(m) // CLUSTER_ANCHORS))
    width = centres.shape[1]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = (_matrix(b.column("v"), width)[:, :width] @ centres.T).argmax(axis=1) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], names=[*b.schema.names, "cluster"])

    return anchors.mapInArrow(assign, f"{_ddl(anchors)}, cluster int")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


class SharedList:
    """A shard's candidates in the order of one cluster's bounds."""

    def __init__(self, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        centre = _units(members)[0].sum(axis=0)
        centre /= np.linalg.norm(centre) or 1.0
        spread = np.arccos(np.clip(_units(members)[0] @ centre, -1, 1)).max()
        units, norms = _units(vectors)
        angle = np.arccos(np.clip(units @ centre, -1, 1))
        bound = norms * np.cos(np.maximum(0, angle - spread))
        order = np.lexsort((ids, -bound))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        # of a negative bound the shortest member has the largest product: zero is never below it
        self.bound = np.maximum(bound[order], 0)
        self.longest = norms.max(initial=0)

    def scores(self, a: np.ndarray, start: int) -> np.ndarray:
        part = self.vectors[start : start + STRIDE]
        if np.linalg.norm(a, axis=1).max(initial=0) * self.longest < _EXACT:
            return np.rint(a @ part.T).astype(np.int64)
        whole = [[int(x) for x in row] for row in part]
        return np.array([[sum(int(x) * y for x, y in zip(m, row, strict=True)) for row in whole] for m in a], np.int64)


class Walk:
    """Each request's first ``k`` rows so far.  A request is an anchor with the
    label that is wanted or excluded and the range its scores may lie in."""

    def __init__(self, anchors: np.ndarray, at: np.ndarray, own: np.ndarray, labels: np.ndarray, same: bool, k: int, positive: np.ndarray | None = None):
        self.anchors, self.at, self.own, self.labels, self.same, self.k = anchors, at, own, labels, same, k
        self.positive = positive
        self.lengths = np.linalg.norm(anchors, axis=1)
        self.ids = np.zeros((len(at), k), np.int64)
        self.best = np.full((len(at), k), _NONE)

    def _certified(self, rows: np.ndarray, bound: float) -> np.ndarray:
        """Requests that no row under the bound can change."""
        top = self.lengths[self.at[rows]] * bound
        top = np.floor(top + 1e-9 * top + 1e-3)
        last = self.best[rows, -1]
        done = (last > _NONE) & (last > top)
        if self.positive is not None:
            done |= (self.positive[rows] < 0) | (100.0 * top < LOWEST * self.positive[rows])
        return done

    def _admitted(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        ok = ((labels == self.labels[rows][:, None]) == self.same) & (ids != self.own[rows][:, None])
        if self.positive is not None:
            p = self.positive[rows][:, None].astype(np.float64)
            ok &= (LOWEST * p <= 100.0 * scores) & (100.0 * scores <= HIGHEST * p)
        return ok & (scores >= self.best[rows, -1][:, None])

    def along(self, shared: SharedList, rows: np.ndarray) -> None:
        """Walk the requests ``rows`` down the list until each is certified."""
        for start in range(0, len(shared.ids), STRIDE):
            rows = rows[~self._certified(rows, shared.bound[start])]
            if len(rows) == 0:
                return
            members, which = np.unique(self.at[rows], return_inverse=True)
            scores = shared.scores(self.anchors[members], start)[which]
            ids = shared.ids[start : start + STRIDE]
            ok = self._admitted(rows, scores, ids, shared.labels[start : start + STRIDE])
            for j in np.flatnonzero(ok.any(axis=1)):
                r = rows[j]
                s = np.concatenate([self.best[r], scores[j, ok[j]]])
                i = np.concatenate([self.ids[r], ids[ok[j]]])
                # an empty place has the least score of all
                first = np.lexsort((i, -s.astype(np.float64) if abs(s[s > _NONE]).max(initial=0) < _EXACT else -s.astype(object)))[: self.k]
                self.best[r], self.ids[r] = s[first], i[first]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(request, row id, score)"""
        r, c = np.nonzero(self.best > _NONE)
        return r, self.ids[r, c], self.best[r, c]


def _walked(anchors: pa.Table, rows: pa.Table, make) -> Walk:
    """A chunk of anchors against a shard: one list per cluster.  ``make`` gives the
    walk over the anchors' vectors."""
    width = max(int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in (anchors.column("v"), rows.column("v")))
    a, v = _matrix(anchors.column("v"), width), _matrix(rows.column("v"), width)
    ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
    clusters = anchors.column("cluster").to_numpy()
    walk = make(a)
    for c in np.unique(clusters):
        members = np.flatnonzero(clusters == c)
        requests = np.flatnonzero(np.isin(walk.at, members))
        if not walk.same:
            walk.along(SharedList(a[members], ids, labels, v), requests)
            continue
        for label in np.unique(walk.labels[requests]):  # rows of other labels cannot be positives
            mine = requests[walk.labels[requests] == label]
            alike = labels == label
            walk.along(SharedList(a[members], ids[alike], labels[alike], v[alike]), mine)
    return walk


def _first_positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
        walk = _walked(anchors, rows, lambda a: Walk(a, np.arange(len(own)), own, labels, True, k))
        r, ids, scores = walk.found()
        return pa.table({"anchor_id": own[r], "positive_id": ids, "positive_score": scores})

    return run


def _first_negatives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        lists = anchors.column("positives").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        positive, score = flat.field("positive_id").to_numpy(), flat.field("positive_score").to_numpy()
        at = np.repeat(np.arange(len(sizes)), sizes)
        own, labels = anchors.column("vec_id").to_numpy()[at], anchors.column("label").to_numpy()[at]
        walk = _walked(anchors, rows, lambda a: Walk(a, at, own, labels, False, k, score))
        r, ids, scores = walk.found()
        return pa.table({
            "anchor_id": own[r], "positive_id": positive[r], "positive_score": score[r], "negative_id": ids, "negative_score": scores,
        })

    return run


def _paired(anchors: DataFrame, rows: DataFrame, chunks: int, shards: int, run, schema: str) -> DataFrame:
    """``run`` on each pair of a chunk of anchors and a shard of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.select("*", every(shards).alias("shard"))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    r = rows.select("*", shard.alias("shard"), every(chunks).alias("chunk"))
    return a.groupBy("chunk", "shard").cogroup(r.groupBy("chunk", "shard")).applyInArrow(_both(run, schema), schema)


def _both(run, schema: str):
    names = [x.split()[0] for x in schema.split(",")]

    def on_pair(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if anchors.num_rows == 0 or rows.num_rows == 0:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return run(anchors, rows)

    return on_pair


def _first(df: DataFrame, group: list[str], score: str, tie: str, k: int) -> DataFrame:
    """The first ``k`` rows of each (small) group with their ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    rows = written(prepared(rows), "negatives-rows")
    anchors = clustered(rows.filter(F.col("vec_id") % ANCHOR_STEP == 0))
    numbered, n = row_number_global(written(anchors, "negatives-anchors"), ["cluster", "vec_id"], "place")
    chunk = F.call_function("div", F.col("place") - 1, F.lit(CHUNK_ANCHORS)).cast("int")
    anchors = numbered.select("vec_id", "label", "v", "cluster", chunk.alias("chunk"))
    chunks, shards = max(1, -(-n // CHUNK_ANCHORS)), max(1, -(-rows.count() // SHARD_ROWS))

    near = _paired(anchors, rows, chunks, shards, _first_positives(positives), "anchor_id long, positive_id long, positive_score long")
    near = written(_first(near, ["anchor_id"], "positive_score", "positive_id", positives), "negatives-positives")
    of_anchor = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    hard = _paired(
        anchors.join(of_anchor, "vec_id"), rows, chunks, shards, _first_negatives(negatives),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    hard = _first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH usable AS (
    SELECT vec_id, min(row(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT,
                           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
), v AS (
    SELECT vec_id, x[1] AS label, x[2] AS v FROM usable
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
           list_inner_product(a.v, r.v)::BIGINT AS score
    FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % {ANCHOR_STEP} = 0
), positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
