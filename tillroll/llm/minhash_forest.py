"""Operator 1: MinHash near-duplicates with an LSH forest.

1. Every document's set of distinct word shingles gives a count, a 128-bit
   digest and ``TREES * DEPTH`` MinHash values of 16 bits.  Documents with equal
   sets collapse into one class, so copies never meet as pairs.
2. The signature is read as ``TREES`` keys; sorting the classes by a key gives
   one signature order of the forest.  Neighbours with a long common prefix are
   candidates: classes that share the first ``DEPTHS[0]`` values form a run, and
   wherever a run holds more than ``RUN`` classes (a dense region) the prefix is
   extended -- ``DEPTHS``, in the end the whole signature read cyclically -- until
   runs are small.  What is equal over the whole signature is dealt into salted
   runs that share one delegate.  Every class is in exactly one run per order.
3. Within a run the signatures estimate all similarities; classes whose estimate
   reaches ``MAYBE`` form a candidate graph, and a maximum spanning forest of it
   (fewer edges than classes) goes to the exact test on full shingle sets.
4. Confirmed edges are joined into components.  Runs whose candidate graph has
   more edges than its forest are then looked at again: wherever their classes
   still lie in different components, *all* pairs across components are tested
   exactly, block by block, with the sets themselves.  So no candidate pair is
   left untested unless its ends are already connected.
5. A longer prefix separates some pairs of a dense region.  Its classes are
   therefore also sorted in the orders that start at each of the signature's
   values, with prefixes of one value, or two where the run of one is too large
   (``STARTS``): a value that two classes share against the rest of their region
   makes a short run at once.  Such runs that span several components are tested
   like those of step 4; what all share makes longer ones, which the orders of
   step 2 go through.  Classes whose runs are too large even so make groups, compared
   all with all in bounded blocks; runs inside one group are left out then.

Random documents at similarity 0.8 share the base prefix in none of the 24
orders with probability 3e-6, and the estimate of such a pair falls below
``MAYBE`` with probability 1.2e-5.  In a dense region where any two documents have
similarity s by what all share, a pair at 0.8 shares none of its own values with
probability 4e-9 (s = 0.6), 4e-4 (0.71) or 2e-2 (0.75), and is then found if it shares
a prefix of step 2, like a pair outside of such regions.

Defined cases: words split at ASCII blanks, A-Z lower-cased; a text with fewer
words than a shingle is one shingle; null, empty or blank texts have no set and
link with nothing; a null id links with nothing and is kept; repeated rows have
equal sets and one id, and different texts under one id are one node; ties go to
the smallest id; an empty table gives an empty result; long texts are hashed in
blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import components, run_bounds, table, whole_groups, written

# Production parameters.
SHINGLE_WORDS = 5
PERCENT = 80  # Jaccard similarity from which documents are linked, in percent
TREES, DEPTH = 24, 6
DEPTHS = (4, 5, 6, 9, 18, TREES * DEPTH)  # prefix lengths that dense regions go through
STARTS = (1, 2)  # prefix lengths of the dense regions' orders from every value
RUN = 256  # classes in a run before the prefix is extended
MAYBE = 0.65  # estimate from which a pair is a candidate
_VALUES = TREES * DEPTH

_mix = np.random.default_rng(20240607)
_XOR = _mix.integers(0, 1 << 32, _VALUES, dtype=np.uint32)[:, None]
_MUL = (_mix.integers(0, 1 << 32, _VALUES, dtype=np.uint32) | np.uint32(1))[:, None]
_WORD_MUL = [int(x) | 1 for x in _mix.integers(0, 1 << 63, 64, dtype=np.uint64)]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    s = np.zeros(n, np.uint64)
    for k in range(size):
        s = s * np.uint64(_WORD_MUL[0]) + (h[k : k + n] ^ np.uint64(_WORD_MUL[k + 1]))
        s ^= s >> np.uint64(29)
    return np.unique(s)


def signature(shingles: np.ndarray) -> bytes:
    """``TREES * DEPTH`` MinHash values, 16 bits each, big-endian."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(_VALUES, np.uint32(0xFFFFFFFF))
    for k in range(0, len(low), 1024):
        x = (low[None, k : k + 1024] ^ _XOR) * _MUL
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(best, x.min(axis=1), out=best)
    return best.astype(">u2").tobytes()


def signatures(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, sig`` (digest and sig null without a set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                n, digest, sig = [], [], []
                for t in part.column(1):
                    s = shingle_set(t.as_py(), size)
                    n.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sig.append(signature(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "sig"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, sig binary")


def _forest_runs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``run, reps``: the different runs of two and more classes over all orders, and
    ``rep``: the classes that lie in a dense region of some order."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    own = F.substring("sig", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTHS[0]))
    orders = classes.select("rep", "sig", tree).withColumn("p", own)

    base = orders.groupBy("tree", "p").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > RUN)
    base = written(base, "forest-dense")
    runs = orders.join(base, ["tree", "p"], "left_anti").select(F.xxhash64("tree", "p").alias("run"), "rep")
    # Only the dense regions go on, with the whole signature from their tree on.
    key = F.substring(F.concat("sig", "sig"), F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * _VALUES))
    rows = written(orders.join(base, ["tree", "p"], "left_semi").select("rep", "tree", key.alias("key")), "forest-region")
    region = rows.select("rep").distinct()
    if not base.isEmpty():
        # All depths are counted in one pass; a class settles at the first that is not dense.
        prefix = {d: F.xxhash64(F.lit(d), "tree", F.substring("key", 1, 2 * d)) for d in DEPTHS}
        counts = rows.select("rep", F.explode(F.array(*prefix.values())).alias("p"))
        counts = counts.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first")).filter(F.col("n") > RUN)
        big = written(counts, "forest-dense-deeper")
        steps = [F.struct(prefix[a].alias("above"), prefix[b].alias("run")) for a, b in zip(DEPTHS, DEPTHS[1:])]
        steps = rows.select("rep", F.explode(F.array(*steps)).alias("x")).select("rep", "x.above", "x.run")
        steps = steps.join(big.select(F.col("p").alias("above")), "above", "left_semi")
        runs = runs.unionAll(steps.join(big.select(F.col("p").alias("run")), "run", "left_anti").select("run", "rep"))
        # What is dense over the whole signature.
        same = rows.select("rep", prefix[DEPTHS[-1]].alias("p")).join(big, "p")
        salt = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / RUN)).alias("salt")
        salted = same.select("rep", "first", F.xxhash64(F.lit(-1), "p", salt).alias("run"))
        runs = runs.unionAll(salted.select("run", "rep")).unionAll(salted.select("run", F.col("first").alias("rep")))
    members = runs.groupBy("run").agg(F.array_sort(F.collect_set("rep")).alias("reps"))
    # Copies of a text meet in most orders: equal runs are looked at once.
    return members.filter(F.size("reps") > 1).select("reps").distinct().select(F.xxhash64("reps").alias("run"), "reps"), region


def _block_runs(groups: DataFrame) -> DataFrame:
    """``run, rep``: every two classes of a group that are not connected yet are in a run
    (``rep, root, grp``; ``root`` is a class's component).  A group is dealt into blocks of
    some ``RUN`` classes, those of a large component into blocks of their own, and every
    two blocks that are not of one component make a run: runs are bounded however large
    the group is."""
    sizes = groups.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("n"))
    small = F.sum(F.when(F.col("n") <= RUN, F.col("n"))).over(Window.partitionBy("grp"))
    own = F.when(F.col("n") > RUN, F.col("root"))
    dealt = F.coalesce(F.when(F.col("n") > RUN, F.col("n")), F.col("small"))
    placed = groups.join(sizes.withColumn("small", small), ["grp", "root"])
    salt = F.pmod(F.xxhash64(F.when(F.col("n") > RUN, F.col("rep")).otherwise(F.col("root"))), F.ceil(dealt / RUN))
    placed = placed.select("grp", "rep", own.alias("own"), F.xxhash64(own, salt).alias("block"))
    placed = written(placed, "forest-blocks")
    blocks = placed.select("grp", "own", "block").distinct()
    other = blocks.select("grp", F.col("own").alias("own2"), F.col("block").alias("block2"))
    pairs = blocks.join(other, "grp").filter("own is null or own2 is null or own <> own2")
    run = F.xxhash64(F.lit(-2), "grp", F.least("block", "block2"), F.greatest("block", "block2"))
    return placed.join(pairs.select("grp", "block", run.alias("run")), ["grp", "block"]).select("run", "rep")


def _one_group() -> Column:
    """Whether all rows that are aggregated lie in one group (``grp``, null outside of groups)."""
    return F.coalesce((F.count("grp") == F.count(F.lit(1))) & (F.min("grp") == F.max("grp")), F.lit(False))


def _start_runs(region: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``run, rep`` of the classes of dense regions (``rep, root, grp, sig``): orders from
    each of the signature's values, by the shortest prefix of a run that is small
    enough, so that a value two classes share against the rest of their region brings them
    together.  Runs within one component or one group (``grp``) are left out.  Also
    ``(u, v)``: what lies in a run that is too large at the longest prefix, with the run's
    first class, or None."""
    start = F.explode(F.sequence(F.lit(0), F.lit(_VALUES - 1))).alias("start")
    key = F.substring(F.concat("sig", "sig"), F.col("start") * 2 + 1, F.lit(2 * STARTS[-1]))
    rows = region.select("rep", "root", "grp", "sig", start).select("rep", "root", "grp", "start", key.alias("key"))
    rows = written(rows, "forest-starts")
    runs = None
    for depth in STARTS:
        rows = rows.withColumn("p", F.substring("key", 1, 2 * depth))
        counts = rows.groupBy("start", "p").agg(
            F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("rep").alias("first"), _one_group().alias("one")
        )
        counts = written(counts.filter("lo <> hi and not one").select("start", "p", "n", "first"), f"forest-starts-{depth}")
        here = rows.join(counts.filter(F.col("n") <= RUN), ["start", "p"], "left_semi")
        here = here.select(F.xxhash64(F.lit(depth), "start", "p").alias("run"), "rep")
        runs = here if runs is None else runs.unionAll(here)
        big = counts.filter(F.col("n") > RUN)
        if big.isEmpty():
            return runs, None
        if depth < STARTS[-1]:
            rows = written(rows.join(big, ["start", "p"], "left_semi").drop("p"), f"forest-starts-rows-{depth}")
    return runs, rows.join(big, ["start", "p"]).select(F.col("first").alias("u"), F.col("rep").alias("v"))


def _region_runs(region: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``run, reps`` of the classes of dense regions (``rep, root, sig``), see ``_start_runs``.
    Classes whose run is still too large at the longest prefix make groups (``rep, grp``,
    or None), which are compared all with all of other components (``_block_runs``): a pair
    that shares a prefix of step 2 is in a run here, whatever its region's size.  Other runs
    of one group's classes alone would only repeat that."""
    runs, near = _start_runs(region.withColumn("grp", F.lit(None).cast("long")))
    groups = None
    if near is not None:
        groups = written(components(near, "forest-rest").select(F.col("node").alias("rep"), F.col("root").alias("grp")), "forest-groups")
        grouped = region.join(groups, "rep", "left")
        runs = _start_runs(grouped)[0].unionAll(_block_runs(grouped.filter("grp is not null").select("grp", "rep", "root")))
    members = runs.groupBy("run").agg(F.array_sort(F.collect_set("rep")).alias("reps"))
    return members.filter(F.size("reps") > 1).select("reps").distinct().select(F.xxhash64("reps").alias("run"), "reps"), groups


def _members(runs: DataFrame, classes: DataFrame) -> DataFrame:
    return (
        runs.select("run", F.explode("reps").alias("rep"))
        .join(classes.select("rep", "sig").hint("merge"), "rep")
        .groupBy("run")
        .agg(F.collect_list(F.struct("rep", "sig")).alias("members"))
    )


def _spanning(estimate: np.ndarray, least: float) -> tuple[list[tuple[int, int]], int, np.ndarray]:
    """Maximum spanning forest of the graph of estimates (Prim), the graph's
    number of edges, and which nodes have an edge."""
    n = len(estimate)
    graph = estimate >= least
    np.fill_diagonal(graph, False)
    n_edges = int(graph.sum()) // 2
    touched = graph.any(axis=1)
    edges: list[tuple[int, int]] = []
    if n_edges == 0:
        return edges, 0, touched
    weight = np.where(graph, estimate, -1.0)
    outside = touched.copy()
    best = np.full(n, -1.0)
    link = np.zeros(n, np.int64)
    while outside.any():
        k = int(np.where(outside, best, -2.0).argmax())
        if best[k] > 0:
            edges.append((int(link[k]), k))
        outside[k] = False
        closer = outside & (weight[k] > best)
        best[closer] = weight[k][closer]
        link[closer] = k
    return edges, n_edges, touched


def _candidates(members: DataFrame) -> DataFrame:
    """Per run: its forest edges, its classes with a candidate, and whether the
    candidate graph holds more than the forest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(0).offsets.to_numpy()
            items = batch.column(0).values
            ids = items.field(0).to_numpy()
            sigs = items.field(1)
            out_a, out_b, out_ids, more = [], [], [], []
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                x = np.frombuffer(b"".join(v.as_py() for v in sigs[s:e]), "<u2").reshape(e - s, _VALUES)
                own = ids[s:e]
                if e - s == 2:
                    if np.count_nonzero(x[0] == x[1]) >= MAYBE * _VALUES:
                        out_a.append([int(own[0])])
                        out_b.append([int(own[1])])
                        out_ids.append(own.tolist())
                        more.append(False)
                    continue
                same = np.empty((e - s, e - s), np.float32)
                for i in range(e - s):
                    same[i] = np.count_nonzero(x == x[i], axis=1)
                edges, n_edges, touched = _spanning(same / _VALUES, MAYBE)
                if edges:
                    out_a.append([int(own[i]) for i, _ in edges])
                    out_b.append([int(own[j]) for _, j in edges])
                    out_ids.append(own[touched].tolist())
                    more.append(n_edges > len(edges))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_a, longs), pa.array(out_b, longs), pa.array(out_ids, longs), pa.array(more, pa.bool_())],
                names=["a", "b", "reps", "more"],
            )

    return members.select("members").mapInArrow(run, "a array<long>, b array<long>, reps array<long>, more boolean")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                if held is None or a != last:
                    last, held = a, shingle_set(a.as_py(), size)
                keep.append(_similar(held, shingle_set(b.as_py(), size), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b"))
    return pairs.join(right.hint("merge"), "v").join(left.hint("merge"), "u").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [shingle_set(t.as_py(), size).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(run, "rep long, shingles binary")


def _across(blocks: DataFrame, percent: int) -> DataFrame:
    """Edges between the roots of different components within a run, by the exact
    similarity of all pairs of their classes; a class is compared with the postings of
    its shingles, so nothing is written per pair that is not an edge."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "run"):
            group = group.combine_chunks()
            runs = group.column("run").to_numpy()
            roots = group.column("root").to_numpy()
            blobs = group.column("shingles")
            found: set[tuple[int, int]] = set()
            for s, e in run_bounds(runs):
                sets = [np.frombuffer(blobs[k].as_py(), np.uint64) for k in range(s, e)]
                sizes = np.array([len(x) for x in sets])
                flat = np.concatenate(sets)
                owner = np.repeat(np.arange(e - s), sizes)
                order = np.argsort(flat, kind="stable")
                flat, owner = flat[order], owner[order]
                for i in range(e - s - 1):
                    lo = np.searchsorted(flat, sets[i], "left")
                    hi = np.searchsorted(flat, sets[i], "right")
                    n = hi - lo
                    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    both = np.bincount(owner[at], minlength=e - s)
                    near = 100 * both >= percent * (sizes + sizes[i] - both)
                    near &= roots[s:e] != roots[s + i]
                    near[: i + 1] = False
                    found.update((int(roots[s + i]), int(roots[s + j])) for j in np.flatnonzero(near).tolist())
            ends = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    return blocks.select("run", "root", "shingles").mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sigs = written(signatures(texts, "doc_id", "text", size), "forest-signatures")
    named = sigs.filter("digest is not null and doc_id is not null")
    classes = written(
        named.groupBy("digest").agg(F.min(F.struct("doc_id", "sig")).alias("x")).select("digest", "x.doc_id", "x.sig"), "forest-classes"
    ).withColumnRenamed("doc_id", "rep")
    runs, region = _forest_runs(classes)
    found = written(_candidates(_members(written(runs, "forest-runs"), classes)), "forest-candidates")
    pairs = found.select(F.explode(F.arrays_zip("a", "b")).alias("x")).select(
        F.least("x.a", "x.b").alias("u"), F.greatest("x.a", "x.b").alias("v")
    )
    pairs = written(pairs.filter("u <> v").distinct(), "forest-pairs")
    whole = texts.filter("doc_id is not null")
    needed = pairs.select(F.col("u").alias("doc_id")).unionAll(pairs.select("v")).distinct()
    ours = written(whole.join(needed.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "forest-texts")
    first = written(_confirmed(pairs, ours, size, percent), "forest-links")
    joined = components(first, "forest-a")

    # Second look: runs whose candidates were not all forest edges, and runs of the
    # dense regions' further orders, that still span several components.
    open_runs = found.filter("more").select("reps", F.lit(True).alias("first_look"))
    known = joined.withColumn("grp", F.lit(None).cast("long"))
    if not region.isEmpty():
        dense = classes.select("rep", "sig").join(region.hint("merge"), "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        further, groups = _region_runs(written(dense.withColumn("root", F.coalesce("root", "rep")), "forest-region-classes"))
        further = _candidates(_members(written(further, "forest-region-runs"), classes)).select("reps", F.lit(False).alias("first_look"))
        open_runs = open_runs.unionAll(written(further, "forest-region-candidates"))
        if groups is not None:
            known = joined.join(groups.withColumnRenamed("rep", "node"), "node", "full")
    open_runs = open_runs.groupBy("reps").agg(F.min("first_look").alias("first_look"))
    open_runs = open_runs.select(F.xxhash64("reps").alias("run"), "first_look", F.explode("reps").alias("node"))
    root = F.coalesce("root", "node").alias("root")
    rooted = open_runs.join(known, "node", "left").select("run", "first_look", F.col("node").alias("rep"), root, "grp")
    rooted = written(rooted, "forest-rooted")
    # What lies in one group was compared in its blocks, if not one itself.
    spanning = rooted.groupBy("run").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), (F.min("first_look") & _one_group()).alias("again"))
    spanning = spanning.filter("lo <> hi and not again").select("run")
    unsettled = written(rooted.select("run", "rep", "root").join(spanning, "run", "left_semi"), "forest-unsettled")
    needed = unsettled.select(F.col("rep").alias("doc_id")).distinct()
    read = whole.join(needed.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = written(_sets(read, size), "forest-sets")
    blocks = unsettled.join(sets.hint("merge"), "rep").repartition("run").sortWithinPartitions("run")
    # Only the roots of components that these edges connect are merged again.
    tops = components(_across(blocks, percent), "forest-b").select(F.col("node").alias("root"), F.col("root").alias("top"))

    # Joins that move texts or signatures are merge joins at every size: no side is bounded.
    roots = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"))
    roots = roots.join(tops, "root", "left").select("digest", F.coalesce("top", "root").alias("component_id"))
    out = sigs.select("doc_id", "n_shingles", "digest").join(roots.hint("merge"), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)
