"""Operator 10: line dedup by a segment-partition edit join.

Lines are cut at ``\\n``.  Equal lines form a class (128-bit digest) whose first
occurrence is the smallest (document id, line number).  Classes of at least
``MIN_CHARS`` code points are near when their edit distance is at most ``EDITS``;
links are joined into components, and of each component only the first
occurrence stays: every other occurrence is removed from its document.

The join: a line of length l is cut into ``EDITS + 1`` segments; a line within the
distance must contain one of them unchanged, at a position and for lengths that
differ by at most ``EDITS`` (multi-match-aware windows).  Every class sends its
segments (index) and, for each length it may meet, its windows (probes) under a
64-bit key; equal keys make candidates unless their character parities differ in
more places than ``EDITS`` edits can change, verified by a banded bit-parallel edit
distance on the texts.

A key that many classes share (``PAIRS`` and more index-probe pairs) makes no pairs
and is never held whole: the shared segment is cut out of its lines, at every place
where a line holds it, and the rests are segmented again under the old key -- two
lines within the distance have rests within the distance -- ``LEVELS`` times.  What is still frequent then differs in a short rest only; it is
verified in blocks of ``BLOCK`` classes, each pair of blocks on its own, and each
leaves no more links than classes.

Defined cases: blank lines (ASCII blanks only) are kept and never matched; a null
text stays null; rows with a null id are left as they are and match nothing;
equal lines at equal places of rows that repeat an id are one occurrence; ties
cannot occur as places are unique; an empty table gives an empty result; lines of
any length are used whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import components, rows_as_struct, run_bounds, table, whole_groups, written

# Production parameters.
EDITS = 2
MIN_CHARS = 24
PAIRS = 4096  # index-probe pairs from which a key is cut further
LEVELS = 3
BLOCK = 256
INDEX, PROBE = 1, 2
_NO_INDEX = -(1 << 31)  # bit of a mark: no segment under the key so far
_WORD = 0xFFFFFFFFFFFFFFFF
_hash = xxhash.xxh64_intdigest
_BIT = np.uint32(1) << (np.arange(256, dtype=np.uint32) & np.uint32(31)) % np.uint32(29)
_BLANK = " \t\x0b\f\r"


def lines_of(text: str) -> Iterator[tuple[int, str]]:
    for k, line in enumerate(text.split("\n")):
        if line.strip(_BLANK):
            yield k, line


def digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode())


def parities(line: str, raw: bytes) -> int:
    """29 bits: of each class of code points (modulo 32, then 29), whether its count
    is odd.  An edit changes at most two of them."""
    points = np.frombuffer(raw, np.uint8) if len(raw) == len(line) else np.frombuffer(line.encode("utf-32-le"), np.uint32) & 31
    return int(np.bitwise_xor.reduce(_BIT[points])) if len(points) else 0


def short(raw: bytes) -> int:
    """A line's id as a long: 64 bits of its digest, none of its parities."""
    return int.from_bytes(xxhash.xxh3_128_digest(raw)[:8], "big", signed=True)


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, length) of the edits + 1 segments of a line."""
    least, more = divmod(length, edits + 1)
    out, at = [], 0
    for k in range(edits + 1):
        n = least + (k > edits - more)
        out.append((at, n))
        at += n
    return out


@lru_cache(maxsize=8192)
def windows(size: int, edits: int = EDITS) -> list[tuple[int, int, int, int]]:
    """(seed, side, start, length) of the segments and probes of a line of that
    size; the seed names the length and the segment that it may meet."""
    out = {}
    for less in range(min(edits, size) + 1):
        other = size - less
        for k, (at, n) in enumerate(segments(other, edits)):
            low = max(at - k, at + less - (edits - k), 0)
            high = min(at + k, at + less + (edits - k), size - n)
            for start in range(low, high + 1):
                out[other * (edits + 1) + k, start] = (n, PROBE | (INDEX if less == 0 and start == at else 0))
    return [(seed, side, start, n) for (seed, start), (n, side) in out.items()]


def entries(text: str, salt: int = 0, edits: int = EDITS) -> list[tuple[int, int, int, int]]:
    """(unsigned key, side, start, length) of the segments and probes of a line."""
    raw = text.encode()
    found = windows(len(text), edits)
    if len(raw) == len(text):
        return [(_hash(raw[at : at + n], seed=(salt + s) & _WORD), side, at, n) for s, side, at, n in found]
    return [(_hash(text[at : at + n].encode(), seed=(salt + s) & _WORD), side, at, n) for s, side, at, n in found]


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most ``edits``: Myers' bit vectors over a
    band of 2 * edits + 1 diagonals (Hyyro 2003), common ends stripped."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    low, high = 0, len(b)
    while low < high:  # length of the common prefix
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    a, b = a[low:], b[low:]
    low, high = 0, len(b)
    while low < high:
        mid = (low + high + 1) // 2
        if a[len(a) - mid :] == b[len(b) - mid :]:
            low = mid
        else:
            high = mid - 1
    a, b = a[: len(a) - low], b[: len(b) - low]
    m, n = len(a), len(b)
    if m <= edits or n == 0:
        return m <= edits
    k, width = edits, 2 * edits + 1
    full = (1 << width) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + k)
    vp = full & ~((1 << k) - 1)
    vn, distance = 0, k
    for j in range(n):
        pm = places.get(b[j], 0) >> j & full
        d0 = ((((pm & vp) + vp) ^ vp) | pm | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if j + k < m:  # the lowest diagonal is still inside the line
            distance += not d0 >> (width - 1) & 1
            if distance > 3 * k:
                return False
        else:
            row = m - 1 - (j - k)
            distance += (hp >> row & 1) - (hn >> row & 1)
        vp = (hn | ~((d0 >> 1) | hp)) & full
        vn = (d0 >> 1) & hp
    return distance <= edits


def _occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id, line, digest, h, short`` of every non-blank line; h is Spark's
    xxhash64 of the line, by which a removal is checked against the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                ids, at, full, h, own = [], [], [], [], []
                part = batch.slice(k, 512)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for n, line in lines_of(text):
                        raw = line.encode()
                        ids.append(i)
                        at.append(n)
                        full.append(xxhash.xxh3_128_digest(raw))
                        own.append(short(raw) if len(line) >= MIN_CHARS else 0)
                        h.append(xxhash.xxh64_intdigest(raw, seed=42))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(full, pa.binary()), _signed(h), pa.array(own, pa.int64())],
                    names=["doc_id", "line", "digest", "h", "short"],
                )

    return docs.mapInArrow(run, "doc_id long, line int, digest binary, h long, short long")


_ENTRY = "key long, line long, mark int"  # mark: parities, then two bits for the side


def _first_entries(docs: DataFrame, edits: int) -> DataFrame:
    """Level 0: segments and probes of the distinct lines of each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                keys, lines, marks = [], [], []
                for text in batch.column(1).slice(k, 256).to_pylist():
                    for line in text.split("\n"):
                        if len(line) < MIN_CHARS or not line.strip(_BLANK):
                            continue
                        raw = line.encode()
                        own = short(raw)
                        if own in seen:
                            continue
                        seen.add(own)
                        mark = parities(line, raw) << 2
                        found = entries(line, 0, edits)
                        keys += [key for key, _, _, _ in found]
                        marks += [mark | side for _, side, _, _ in found]
                        lines += [own] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [_signed(keys), pa.array(lines, pa.int64()), pa.array(marks, pa.int32())], names=["key", "line", "mark"]
                )

    return docs.mapInArrow(run, _ENTRY)


def _met(all_entries: DataFrame, edits: int) -> DataFrame:
    """Candidates ``(a, b)`` of each key -- lines whose parities are close enough -- or
    for a frequent key its members ``(key, side, a)`` with b null, a member perhaps in
    several rows; side is the mark, parities included, and negative while the key has
    shown no segment.  Every member is a probe."""

    most = 2 * edits

    def rows(a: list, b: list, k: list, s: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.int32())],
            names=["a", "b", "key", "side"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A key's members are held until they make PAIRS pairs; from then on its
        # rows pass through, so a task never holds more of a key than that.
        own: dict[int, int] = {}
        last, frequent, indexed = None, False, False

        def pairs() -> set[tuple[int, int]]:
            index = [(i, m >> 2) for i, m in own.items() if m & INDEX]
            probe = [(i, m >> 2) for i, m in own.items() if m & PROBE]
            return {(i, p) if i < p else (p, i) for i, x in index for p, y in probe if i != p and (x ^ y).bit_count() <= most}

        for batch in batches:
            key = batch.column(0).to_numpy()
            lines, marks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            out_a, out_b, out_k, out_s = [], [], [], []
            if not len(key):
                continue
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(key))
            # Keys of one row, neither begun before nor going on, meet nothing.
            used = ends - starts > 1
            used[[0, -1]] = True
            for s, e in zip(starts[used].tolist(), ends[used].tolist(), strict=True):
                now = int(key[s])
                if now != last:
                    if len(own) > 1 and not frequent:
                        met = pairs()
                        out_a += [a for a, _ in met]
                        out_b += [b for _, b in met]
                        out_k += [0] * len(met)
                        out_s += [0] * len(met)
                    own, last, frequent, indexed = {}, now, False, False
                if not frequent:
                    for n, (x, m) in enumerate(zip(lines[s:e].tolist(), marks[s:e].tolist(), strict=True), 1):
                        own[x] = own.get(x, 0) | m
                        if n % PAIRS and s + n < e or len(own) ** 2 < PAIRS:
                            continue
                        if len(own) >= PAIRS or len(own) * sum(1 for m in own.values() if m & INDEX) >= PAIRS:
                            frequent = True
                            indexed = any(m & INDEX for m in own.values())
                            out_a += own.keys()
                            out_s += own.values() if indexed else [m | _NO_INDEX for m in own.values()]
                            out_b += [None] * len(own)
                            out_k += [now] * len(own)
                            own = {}
                            s += n
                            break
                    else:
                        continue
                indexed = indexed or bool((marks[s:e] & INDEX).any())
                out_a += lines[s:e].tolist()
                out_s += (marks[s:e] if indexed else marks[s:e] | np.int32(_NO_INDEX)).tolist()
                out_b += [None] * (e - s)
                out_k += [now] * (e - s)
            if out_a:
                yield rows(out_a, out_b, out_k, out_s)
        if len(own) > 1 and not frequent:
            met = pairs()
            yield rows([a for a, _ in met], [b for _, b in met], [0] * len(met), [0] * len(met))

    by_key = all_entries.repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(run, "a long, b long, key long, side int")


def _members(met: DataFrame) -> DataFrame:
    """``key, a, side``: the members of the frequent keys, one row each, dealt by a.
    A key without a segment has probes only, which meet nothing, and goes; the rows
    that came before a key's first segment are few and looked up."""
    rows = met.filter("b is null").select("key", "a", "side")
    sure, early = rows.filter("side >= 0"), rows.filter("side < 0")
    early = early.withColumn("side", F.col("side").bitwiseAND(~_NO_INDEX))
    rows = sure.unionAll(early.join(sure.select("key").distinct(), "key", "left_semi"))
    return rows.repartition("a").groupBy("key", "a").agg(F.bit_or("side").alias("side"))


def _rests(members: DataFrame, edits: int) -> DataFrame:
    """The rests of each member of a frequent key, with the key as salt: ``salt, line,
    rest, side``, once per row of the member.  A line that holds the key at several
    places has a rest for each: the one that leaves two lines within the distance may
    be any of them.  Nothing marks the cut, so places within a run of one character leave one rest.  Two
    lines under one id have both texts here; the one that does not hold the key
    has no rest under it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts, lines, sides, rests = [], [], [], []
            for key, salt, mark, line, text in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                found: dict[str, int] = {}
                for k, side, at, n in entries(text, salt, edits):
                    if k == key & _WORD and side & mark:
                        rest = text[:at] + text[at + n :]
                        found[rest] = found.get(rest, 0) | side & mark
                salts += [key] * len(found)
                lines += [line] * len(found)
                sides += [mark & ~3 | side for side in found.values()]
                rests += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(salts, pa.int64()), pa.array(lines, pa.int64()), pa.array(sides, pa.int32()), pa.array(rests, pa.string())],
                names=["salt", "line", "side", "rest"],
            )

    return members.select("key", "salt", "side", "line", "rest").mapInArrow(run, "salt long, line long, side int, rest string")


def _next_entries(rests: DataFrame, edits: int) -> DataFrame:
    """Segments and probes of the rests, each on the sides that its line had.  Their
    parities are those of the line: what was cut out is the same in all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                keys, lines, marks = [], [], []
                for r in batch.slice(k, 256).to_pylist():
                    for key, side, _, _ in entries(r["rest"], r["salt"], edits):
                        if side & r["side"] & 3:
                            keys.append(key)
                            lines.append(r["id"])
                            marks.append(r["side"] & (side | ~3))
                yield pa.RecordBatch.from_arrays(
                    [_signed(keys), pa.array(lines, pa.int64()), pa.array(marks, pa.int32())], names=["key", "line", "mark"]
                )

    return rests.mapInArrow(run, _ENTRY)


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within(a.as_py(), b.as_py(), edits) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(near, pa.bool_()))

    left = texts.select(F.col("line").alias("a"), F.col("full").alias("u"), F.col("text").alias("ta"))
    right = texts.select(F.col("line").alias("b"), F.col("full").alias("v"), F.col("text").alias("tb"))
    found = pairs.join(left, "a").join(right, "b").select("u", "v", "ta", "tb")
    return found.mapInArrow(run, "u binary, v binary")


def _block_links(left: DataFrame, edits: int) -> DataFrame:
    """The last resort for keys still frequent: members are dealt into blocks and
    each pair of blocks is compared on its own (``left``: key, blocks, block, full,
    text).  A pair of blocks leaves a spanning forest of its links."""
    cells = left.select(
        "key", "full", "text", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "full", "text")
    cells = cells.withColumn("cell", F.xxhash64("key", "lo", "hi"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "cell"):
            group = group.combine_chunks()
            cell = group.column("cell").to_numpy()
            us, vs = [], []
            for s, e in run_bounds(cell):
                full, text = group.column("full")[s:e].to_pylist(), group.column("text")[s:e].to_pylist()
                block = group.column("block").to_numpy()[s:e]
                root = list(range(e - s))

                def find(x: int, root: list[int] = root) -> int:
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                one = bool((block == block[0]).all())
                for i in range(e - s):
                    for j in range(i):
                        if (one or block[i] != block[j]) and (x := find(i)) != (y := find(j)) and within(text[i], text[j], edits):
                            root[x] = y
                            us.append(full[i])
                            vs.append(full[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    dealt = cells.select("cell", "block", "full", "text").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "u binary, v binary")


def _texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``line, full, text`` of the classes with the given short ids, read back
    from the documents that hold their first occurrence."""
    places = ids.distinct().join(classes.select("line", "digest", "h", "first.doc_id", F.col("first.line").alias("at")), "line")
    by_doc = places.groupBy("doc_id").agg(F.collect_list(F.struct("at", "line", "digest", "h")).alias("wanted"))
    held = docs.join(by_doc.hint("merge"), "doc_id").select("doc_id", F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w"))
    found = held.select("doc_id", "w.line", F.col("w.digest").alias("full"), "w.h", F.get("lines", F.col("w.at")).alias("text"))
    # Rows that repeat an id may hold another line at the place, none or the same; all are in one task.
    found = found.filter(F.col("text").isNotNull() & (F.xxhash64("text") == F.col("h")))
    return found.distinct().select("line", "full", "text")


def near_links(docs: DataFrame, classes: DataFrame, edits: int = EDITS) -> DataFrame:
    """Verified links ``(u, v)`` between digests of different lines."""
    met = written(_met(_first_entries(docs, edits), edits), "line-met")
    ids = met.select(F.col("a").alias("line")).unionAll(met.filter("b is not null").select("b"))
    texts = written(_texts(ids, classes, docs), "line-texts")
    pairs = met.filter("b is not null").select("a", "b")
    frequent = _members(met).select("key", F.lit(0).cast("long").alias("salt"), "side", F.col("a").alias("line"))
    hot = frequent.join(texts.select("line", F.col("text").alias("rest")), "line")
    for level in range(1, LEVELS + 1):
        hot = written(hot, f"line-hot-{level}")
        if hot.isEmpty():
            break
        # A rest of a line under a key goes by an id of its own.  Rests are cut where
        # they are needed, a hash for each window, and not written.
        own = F.xxhash64("salt", "line", "rest").alias("id")
        rests = _rests(hot, edits).select(own, "salt", "side", "line", "rest")
        deeper = written(_met(_next_entries(rests, edits), edits), f"line-met-{level}")
        lines = rests.select("id", "line")
        found = deeper.filter("b is not null").select("a", "b")
        found = found.join(lines.select(F.col("id").alias("a"), F.col("line").alias("u")), "a")
        found = found.join(lines.select(F.col("id").alias("b"), F.col("line").alias("v")), "b").filter("u <> v")
        pairs = pairs.unionAll(found.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")))
        members = _members(deeper).select("key", "side", F.col("a").alias("id"))
        used = rests.select("id", "salt", "line", "rest")
        if level > 1:  # a line has several rows under a key then: a rest may come from each
            used = used.repartition("id").distinct()
        hot = members.join(used, "id").select("key", "salt", "side", "line", "rest")
    left = hot.select("key", "line").distinct().join(texts, "line")
    sizes = left.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    left = left.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("full"), F.col("blocks")))
    pairs = pairs.repartition("a").distinct()
    return _verified(pairs, texts, edits).unionAll(_block_links(left, edits))


def removals(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``doc_id, gone``: the removed lines of documents that lose some, as
    ``(line, h)``; docs has ``doc_id`` and ``text``, neither null."""
    seen = written(_occurrences(docs), "line-occurrences")
    first, n = F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n")
    classes = seen.groupBy("digest").agg(first, n, F.min("short").alias("line"), F.min("h").alias("h"))
    classes = written(classes, "line-classes")
    links = written(near_links(docs, classes, edits), "line-links")
    firsts = classes.select("digest", "first")
    nodes = links.join(firsts.select(F.col("digest").alias("u"), F.col("first").alias("fu")), "u").join(
        firsts.select(F.col("digest").alias("v"), F.col("first").alias("fv")), "v"
    )
    rooted = components(nodes.select(F.col("fu").alias("u"), F.col("fv").alias("v")), "line")
    stays = classes.join(rooted.withColumnRenamed("node", "first"), "first", "left").select(
        "digest", "n", "first", F.coalesce("root", "first").alias("stay")
    )
    changed = stays.filter("n > 1 or first <> stay").select("digest", "stay")
    gone = seen.join(changed, "digest").filter((F.col("stay.doc_id") != F.col("doc_id")) | (F.col("stay.line") != F.col("line")))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("line", "h")).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """``row`` (all columns, unchanged), ``text`` without the removed lines,
    ``n_lines`` (non-blank lines of the input) and ``n_removed``."""
    rows = rows_as_struct(docs, doc_id=F.col(doc_id).cast("long"), text=F.col(text))
    used = rows.select("doc_id", "text").filter("doc_id is not null and text is not null")
    gone = removals(used, edits)
    lines = F.split("text", "\n", -1)
    stays = F.filter(lines, lambda x, k: ~F.array_contains("gone", F.struct(k.alias("line"), F.xxhash64(x).alias("h"))))
    cut = rows.join(gone.hint("merge"), "doc_id", "left").withColumn("kept", F.when(F.col("gone").isNotNull(), stays))
    # A non-blank line is its first non-blank character and what follows.
    n_lines = F.coalesce(F.regexp_count("text", F.lit(r"[^ \t\x0B\f\r\n][^\n]*+")), F.lit(0))
    return cut.select(
        "row",
        F.coalesce(F.array_join("kept", "\n"), "text").alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("kept").isNotNull(), F.size(lines) - F.size("kept")).otherwise(0).cast("long").alias("n_removed"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many of them went, and the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_removed", "text")
