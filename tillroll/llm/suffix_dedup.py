"""Operator 9: removal of repeated byte strings, suffixes sorted one bucket at a time.

A byte goes if a string of ``MATCH`` bytes that covers it also starts earlier: in a
document with a smaller id or further left in the same one.

1. Copies of a whole text: all but the smallest id lose everything (if ``MATCH``
   bytes long) and need no sorting; the smallest stands for them.
2. Buckets.  Every ``MATCH``-byte window takes the smallest hash of the
   ``GRAM``-byte strings in it as its key, so equal windows have equal keys;
   neighbouring windows whose key comes from one place form a run (about 40
   windows).  Equal windows lie in different runs of one key, so only keys that
   occur twice can hold a repeat.  Of a key that is frequent among the
   runs looked at together a single marker is shuffled, its runs pass through under spread
   keys, so no task receives a frequent key's runs.
3. The runs of the shared keys are cut out as fragments and dealt by key: a
   suffix bucket.  Equal fragments are settled at once.  For the rest of a block
   of buckets, positions whose residue lies in a difference cover modulo ``V``
   are ranked first (``V``-byte names, doubled twice); then the bucket's suffixes
   are sorted by their first ``V`` bytes, and ties are split around pivots by
   the ranks of the next cover positions that a suffix and its pivot have in
   common.  Neighbours in that order with equal windows are the repeats.  A
   block is a few megabytes, whatever the corpus.
4. Fragments of frequent keys (``HOT`` runs and more: a short line that many
   documents hold, with other text around it) are settled at once where they are
   equal; the different ones are keyed once more by strings of ``LONG_GRAM`` bytes, which only windows that agree nearly whole share.  What is
   shared still goes window by window: repeats within a batch are settled there,
   the rest by the earliest place per 128-bit fingerprint, a combined aggregate.
5. Windows found are merged per document into the removed spans.

Defined cases: a null text is empty; texts are UTF-8 bytes and may be cut inside
a character; rows with a null id keep everything and match nothing; rows that
repeat an id count as one document when it comes to "earlier", and equal places
are never earlier; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import release, table, whole_groups, written

# Production parameters.
MATCH = 100  # bytes
GRAM = 24  # bytes of the strings whose smallest hash is a window's key
LONG_GRAM = 90  # the same for the second key of frequent ones
GATHERED = 500_000  # runs that are looked at together before they are shuffled
LOCAL_PART, LOCAL_LEAST = 64, 16  # a key in more than a 64th of their texts sends a marker only
HOT = 100_000  # runs of a key from which it is keyed again
BLOCK_BYTES = 4 << 20  # bytes of fragments whose windows are settled together
SLICE = 1 << 20  # bytes whose hashes are held at a time
# A perfect difference set modulo 31.
V, COVER = 31, (1, 5, 11, 24, 25, 27)

_IN_WINDOW = sorted({*range(0, MATCH - 7, 8), MATCH - 8})  # words that cover a window
_PLACE_BITS = 22  # a slice is at most two SLICE long
_MIX = np.random.default_rng(9).integers(0, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_COVER = np.isin(np.arange(V), COVER)
#: _SHIFT[a, b]: least d such that a + d and b + d are both in the cover
_SHIFT = np.array([[next(d for d in range(V) if _IN_COVER[(a + d) % V] and _IN_COVER[(b + d) % V]) for b in range(V)] for a in range(V)])


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from every position (data ends in eight spare bytes)."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def runs_of(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, number of windows, key) of every run of the texts."""
    parts: list[tuple[int, int, bytes]] = []
    held, out = 0, []
    for k, t in enumerate(texts):
        for at in range(0, max(len(t) - MATCH + 1, 0), SLICE):
            parts.append((k, at, t[at : at + SLICE + MATCH - 1]))
            held += len(parts[-1][2])
            if held >= SLICE:
                out.append(_slice_runs(parts, gram))
                parts, held = [], 0
    if parts:
        out.append(_slice_runs(parts, gram))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _slice_runs(parts: list[tuple[int, int, bytes]], gram: int) -> tuple[np.ndarray, ...]:
    """Runs of some (text, offset, bytes): the smallest hash of each window,
    leftmost of equals, by a sliding minimum over hash and place in one word."""
    data = b"".join(x for _, _, x in parts) + bytes(gram + 8)
    sizes = np.array([len(x) for _, _, x in parts], np.int64)
    w = _words(data)
    n = int(sizes.sum())
    h = np.zeros(n, np.uint64)
    for k, off in enumerate(sorted({*range(0, gram - 7, 8), gram - 8})):
        h += w[off : off + n] * _MIX[k]
    h ^= h >> np.uint64(32)
    h *= _MIX[-1]
    h ^= h >> np.uint64(29)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    least = (h & ~place) | np.arange(n, dtype=np.uint64)
    span, width = MATCH - gram + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    starts = np.cumsum(sizes) - sizes
    count = sizes - MATCH + 1  # windows of each part
    part = np.repeat(np.arange(len(parts)), count)
    at = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
    where = (least[at + starts[part]] & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (part[1:] != part[:-1])]))
    own = part[first]
    text, offset = np.array([k for k, _, _ in parts]), np.array([o for _, o, _ in parts])
    return text[own], at[first] + offset[own], np.diff(np.append(first, len(where))), h[where[first]].view(np.int64)


_RUN = "key long, kind int, doc_id long, pos int, sub int, n int"


def _keyed_rows(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, sub: np.ndarray, n: np.ndarray, texts: int) -> pa.RecordBatch:
    """Rows of the runs of some texts looked at together: as they are (kind 0), but
    of a key that is frequent here only a marker (1), its runs under keys of their
    own (2)."""
    values, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    limit = max(LOCAL_LEAST, texts // LOCAL_PART)
    frequent = counts[inverse] > limit if len(key) else np.empty(0, bool)
    marks = values[counts > limit]
    spread = key.view(np.uint64) ^ doc.astype(np.uint64) * _MIX[0] ^ pos.astype(np.uint64) * _MIX[1] ^ sub.astype(np.uint64) * _MIX[2]
    none = np.zeros(len(marks), np.int64)
    columns = {
        "key": np.concatenate([np.where(frequent, (spread * _MIX[3]).view(np.int64), key), marks]),
        "kind": np.concatenate([np.where(frequent, 2, 0), none + 1]).astype(np.int32),
        "doc_id": np.concatenate([doc, none]),
        "pos": np.concatenate([pos, none]).astype(np.int32),
        "sub": np.concatenate([sub, none]).astype(np.int32),
        "n": np.concatenate([n, none]).astype(np.int32),
    }
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _gathered(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], texts: int) -> pa.RecordBatch:
    doc, at, key = (np.concatenate(x) for x in zip(*found, strict=True))
    zero = np.zeros(len(at), np.int64)
    return _keyed_rows(key, doc, at, zero, zero, texts)


def _rows_of_runs(docs: DataFrame) -> DataFrame:
    """The runs of all texts; ``pos`` is a run's first window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, texts = [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts += len(ids)
            for k in range(0, batch.num_rows, 512):
                t, a, _, x = runs_of([s.encode() for s in batch.column(1).slice(k, 512).to_pylist()])
                found.append((ids[t + k], a, x))
                held += len(x)
            if held >= GATHERED:
                yield _gathered(found, texts)
                found, held, texts = [], 0, 0
        if found:
            yield _gathered(found, texts)

    rows = docs.select("doc_id", "text").mapInArrow(run, _RUN)
    return rows.select("key", "kind", "doc_id", "pos")


def _second_runs(hot: DataFrame) -> DataFrame:
    """The runs of the fragments of frequent keys by their long strings; ``pos`` is
    the fragment's start, ``sub`` and ``n`` the run's windows within it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            frag, sub, n, key = runs_of(batch.column(2).to_pylist(), LONG_GRAM)
            yield _keyed_rows(key, ids[frag], starts[frag], sub, n, batch.num_rows)

    return hot.select("doc_id", "start", "frag").mapInArrow(run, _RUN)


def _shared_runs(rows: DataFrame) -> DataFrame:
    """The runs whose key occurs more than once, with ``hot``: the key is frequent."""
    kept = [c for c in rows.columns if c not in ("key", "kind")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "key"):
            key, kind = group.column("key").to_numpy(), group.column("kind").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(first, len(key)))
            marked = np.add.reduceat((kind == 1).astype(np.int64), first) > 0
            own = np.repeat(np.arange(len(first)), size)
            hot = (marked | (size >= HOT))[own] | (kind == 2)
            keep = (kind == 2) | ((kind == 0) & (marked | (size > 1))[own])
            chosen = group.select(kept).append_column("hot", pa.array(hot)).filter(pa.array(keep))
            yield from chosen.combine_chunks().to_batches()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)
    by_key = rows.repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(run, f"{kinds}, hot boolean")


def _text_hash(raw: bytes) -> bytes:
    return hashlib.md5(raw).digest()


_FRAGMENT = "key long, hot boolean, doc_id long, h binary, start int, frag binary"


def _fragments(wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs (``doc_id, text, runs, copies``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids, copies = part.column(0).to_numpy(), part.column(3).to_pylist()
                texts = [s.encode() for s in part.column(1).to_pylist()]
                hashes = [_text_hash(t) for t in texts]
                texts = [b"" if c and h in c else t for t, h, c in zip(texts, hashes, copies, strict=True)]
                runs = part.column(2)
                asked_of = np.repeat(np.arange(part.num_rows), runs.value_lengths().to_numpy())
                asked = runs.flatten()
                asked = (asked_of << 32) | asked.field("pos").to_numpy(), asked.field("hot").to_numpy(zero_copy_only=False)
                order = np.argsort(asked[0])
                codes, flags = asked[0][order], asked[1][order]
                text, at, n, key = runs_of(texts)
                slot = np.searchsorted(codes, (text << 32) | at)
                slot[slot == len(codes)] = 0
                mine = np.flatnonzero(codes[slot] == ((text << 32) | at))
                own, at, n = text[mine], at[mine], n[mine]
                frags = [texts[t][a : a + m + MATCH - 1] for t, a, m in zip(own.tolist(), at.tolist(), n.tolist(), strict=True)]
                out = (key[mine], flags[slot[mine]], ids[own], [hashes[t] for t in own.tolist()], at.astype(np.int32), frags)
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["key", "hot", "doc_id", "h", "start", "frag"]
                )

    return wanted.select("doc_id", "text", "runs", "copies").mapInArrow(run, _FRAGMENT)


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Rank (from 1) of each element, given an order that sorts the keys."""
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) + 1
    return rank


def sorted_suffixes(data: bytes, wanted: np.ndarray) -> np.ndarray:
    """The wanted positions of ``data`` in the order of their suffixes, compared
    over at least 4 * V bytes.  ``data`` ends in MATCH + 8 spare bytes."""
    big = _words(data).byteswap()  # compared as numbers, words order like bytes
    n = len(big)
    last = np.uint64(0xFFFFFFFFFFFFFF00)  # 31 bytes are three words and seven bytes

    def head(at: np.ndarray) -> list[np.ndarray]:
        return [big[np.minimum(at + 24, n - 1)] & last, *[big[np.minimum(at + k, n - 1)] for k in (16, 8, 0)]]

    # Ranks of the cover positions, by V bytes, then 2V, then 4V.
    cover = np.flatnonzero(_IN_COVER[np.arange(n) % V])
    slot = np.zeros(n + 4 * V, np.int64)
    keys = head(cover)
    rank = _dense(np.lexsort(keys), *keys)
    for step in (V, 2 * V):
        slot[cover] = rank
        ahead = slot[cover + step]
        rank = _dense(np.lexsort((ahead, rank)), rank, ahead)
    slot[cover] = rank

    keys = head(wanted)
    order = np.lexsort(keys)
    group = _dense(order, *keys)[order]
    out = wanted[order]
    live = np.arange(len(out))  # places not settled yet; equal groups are neighbours
    while True:
        g = group[live]
        lone = np.ones(len(g), bool)
        if len(g) > 1:
            same = g[1:] == g[:-1]
            lone[1:] &= ~same
            lone[:-1] &= ~same
        live = live[~lone]
        if not len(live):
            return out
        g = group[live]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff(np.append(first, len(g)))
        at = out[live]
        pivot = np.repeat(at[first + size // 2], size)
        d = _SHIFT[at % V, pivot % V]
        side = np.sign(slot[at + d] - slot[pivot + d])
        move = np.lexsort((side, np.repeat(np.arange(len(first)), size)))
        out[live] = at[move]
        side = side[move]
        # Within a group: smaller, equal (settled), larger; new group numbers keep the order.
        fresh = np.concatenate([[True], (side[1:] != side[:-1]) | (g[1:] != g[:-1])])
        group[live] = np.cumsum(fresh)
        live = live[side != 0]


def _window_hashes(data: bytes, at: np.ndarray) -> np.ndarray:
    w = _words(data)
    h = np.zeros(len(at), np.uint64)
    for k, off in enumerate(_IN_WINDOW):
        h += w[at + off] * _MIX[k]
    h ^= h >> np.uint64(32)
    return h * _MIX[-1]


def _layout(frags: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The fragments end to end, and of each window its fragment, its place in it
    and its place in all."""
    data = b"".join(frags) + bytes(MATCH + 8)
    sizes = np.array([len(f) for f in frags], np.int64)
    count = sizes - MATCH + 1
    owner = np.repeat(np.arange(len(frags)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return data, owner, inside, (np.cumsum(sizes) - sizes)[owner] + inside


def repeated_windows(frags: list[bytes], doc: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(fragment, first, last) runs of windows that also start earlier, where a
    fragment begins at (doc, start).  Fragments and windows whose hash no other
    window has cannot hold a repeat and are not sorted."""
    data, owner, inside, window = _layout(frags)
    hashes = _window_hashes(data, window)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    likely = np.zeros(len(order), bool)
    likely[order[1:][same]] = True
    likely[order[:-1][same]] = True
    if not likely.any():
        return []
    left = np.unique(owner[likely])
    data, own, at, window = _layout([frags[k] for k in left.tolist()])
    mine = np.isin(owner, left, kind="table")
    likely = likely[mine]
    owner, inside, window = left[own[likely]], at[likely], window[likely]
    order = sorted_suffixes(data, window)
    w = _words(data)
    same = np.ones(len(order) - 1, bool)
    for k in _IN_WINDOW:
        x = w[order + k]
        same &= x[1:] == x[:-1]
    if not same.any():
        return []
    of_window = np.full(len(data), -1, np.int64)
    of_window[window] = np.arange(len(window))
    number = of_window[order]
    cls = np.cumsum(np.concatenate([[True], ~same]))
    d, p = doc[owner[number]], start[owner[number]] + inside[number]
    by = np.lexsort((p, d, cls))
    cls, d, p, number = cls[by], d[by], p[by], number[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], cls[1:] != cls[:-1]]), np.arange(len(cls)), 0))
    late = (d != d[head]) | (p != p[head])
    gone = np.sort(number[late])
    if not len(gone):
        return []
    cut = np.concatenate([[True], (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]])])
    a = np.flatnonzero(cut)
    b = np.append(a[1:], len(gone)) - 1
    return list(zip(owner[gone[a]].tolist(), inside[gone[a]].tolist(), inside[gone[b]].tolist(), strict=True))


_RANGE = "doc_id long, h binary, s int, e int"


def _bucket_ranges(fragments: DataFrame) -> DataFrame:
    """Repeated windows of the buckets: ``doc_id, h, s, e`` (window starts)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "key"):
            key = group.column("key").to_numpy()
            doc, start = group.column("doc_id").to_numpy(), group.column("start").to_numpy().astype(np.int64)
            frags, hashes = group.column("frag").to_pylist(), group.column("h").to_pylist()
            order = np.lexsort((start, doc)).tolist()
            earliest: dict[bytes, int] = {}
            found: list[tuple[int, int, int]] = []
            for k in order:
                head = earliest.setdefault(frags[k], k)
                if (doc[k], start[k]) != (doc[head], start[head]):
                    found.append((k, 0, len(frags[k]) - MATCH))
            left = np.array(sorted(earliest.values()), np.int64)
            x = key[left]
            alone = np.ones(len(x), bool)
            alone[1:] &= x[1:] != x[:-1]
            alone[:-1] &= x[1:] != x[:-1]
            left = left[~alone]
            # Blocks of whole buckets, about a megabyte each.
            weight = np.cumsum([len(frags[k]) for k in left.tolist()], dtype=np.int64) if len(left) else np.empty(0, np.int64)
            a = 0
            while a < len(left):
                b = max(int(np.searchsorted(weight, (weight[a - 1] if a else 0) + (1 << 20))), a + 1)
                while b < len(left) and key[left[b]] == key[left[b - 1]]:
                    b += 1
                part = left[a:b]
                found += [(int(part[f]), s, e) for f, s, e in repeated_windows([frags[k] for k in part.tolist()], doc[part], start[part])]
                a = b
            rows = [k for k, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(doc[k]) for k in rows], pa.int64()),
                    pa.array([hashes[k] for k in rows], pa.binary()),
                    pa.array([int(start[k]) + s for k, s, _ in found], pa.int32()),
                    pa.array([int(start[k]) + e for k, _, e in found], pa.int32()),
                ],
                names=["doc_id", "h", "s", "e"],
            )

    by_key = fragments.select("key", "doc_id", "h", "start", "frag").repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(run, _RANGE)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Arrow batches put together to about ``BLOCK_BYTES``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= BLOCK_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _window_places(hot: DataFrame) -> DataFrame:
    """Windows of the shared sub-runs of hot fragments (``subs``): the first of
    equal ones in a block as ``fp, doc_id, h, s``, the others as settled
    ranges ``doc_id, h, s, e`` without fp."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            rows = block.to_pylist()
            rows.sort(key=lambda r: (r["doc_id"], r["start"]))
            first: dict[bytes, tuple[int, int]] = {}
            fps, places, ranges = [], [], []
            for r in rows:
                i, h, at, frag = r["doc_id"], r["h"], r["start"], r["frag"]
                last = -2
                for j in sorted({j for x in r["subs"] for j in range(x["sub"], min(x["sub"] + x["n"], len(frag) - MATCH + 1))}):
                    fp = xxhash.xxh3_128_digest(frag[j : j + MATCH])
                    place = first.setdefault(fp, (i, at + j))
                    if place == (i, at + j):
                        fps.append(fp)
                        places.append((i, h, at + j))
                    elif last == at + j - 1 and ranges and ranges[-1][:2] == [i, h]:
                        ranges[-1][3] = last = at + j
                    else:
                        last = at + j
                        ranges.append([i, h, last, last])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*fps, *[None] * len(ranges)], pa.binary()),
                    pa.array([*[p[0] for p in places], *[x[0] for x in ranges]], pa.int64()),
                    pa.array([*[p[1] for p in places], *[x[1] for x in ranges]], pa.binary()),
                    pa.array([*[p[2] for p in places], *[x[2] for x in ranges]], pa.int32()),
                    pa.array([*[p[2] for p in places], *[x[3] for x in ranges]], pa.int32()),
                ],
                names=["fp", "doc_id", "h", "s", "e"],
            )

    return hot.select("doc_id", "h", "start", "frag", "subs").mapInArrow(run, f"fp binary, {_RANGE}")


def _hot_ranges(hot: DataFrame) -> DataFrame:
    """Repeated windows of the fragments of frequent keys.  Most of those are
    equal: the earliest of equal ones (combined before the shuffle) goes on, the
    others are repeats from end to end."""
    same = hot.groupBy("frag").agg(F.min(F.struct("doc_id", "start", "h")).alias("first")).select("frag", "first.*")
    firsts = written(same, "suffix-different-fragments")
    name = F.unhex(F.md5("frag")).alias("name")
    named = firsts.select(name, F.col("doc_id").alias("d"), F.col("start").alias("a"))
    copies = hot.select(name, "doc_id", "h", F.col("start").alias("s"), (F.col("start") + F.length("frag") - MATCH).alias("e"))
    whole = copies.join(named.hint("merge"), "name").filter("doc_id <> d or s <> a").select("doc_id", "h", "s", "e")
    whole = written(whole, "suffix-whole-ranges")  # a join of its own: its frequent names can be split
    shared = written(_shared_runs(_second_runs(firsts)), "suffix-shared-again")
    subs = shared.groupBy("doc_id", F.col("pos").alias("start")).agg(F.collect_list(F.struct("sub", "n")).alias("subs"))
    places = written(_window_places(firsts.join(subs.hint("merge"), ["doc_id", "start"])), "suffix-places")
    single = places.filter("fp is not null")
    first = single.groupBy("fp").agg(F.min(F.struct("doc_id", "s")).alias("first"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    late = single.join(first.hint("merge"), "fp").filter((F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.s") != F.col("s")))
    ranges = late.select("doc_id", "h", "s", "e").unionAll(places.filter("fp is null").select("doc_id", "h", "s", "e"))
    return ranges.unionAll(whole)


def _cut(rows: DataFrame, kind: str) -> DataFrame:
    """Applies the ranges: ``row, text, ranges, copies`` -> ``row`` and results."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sizes, removed, spans, kept = [], [], [], []
                for text, ranges, copies in zip(*(part.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                    raw = (text or "").encode()
                    size = len(raw)
                    own = _text_hash(raw) if ranges or copies else b""
                    pieces, at, gone, n = [], 0, 0, 0
                    if copies and own in copies and size >= MATCH:
                        cuts = [(0, size)]
                    else:
                        cuts = sorted((r["s"], r["e"] + MATCH) for r in ranges or [] if r["h"] == own)
                    for s, e in cuts:
                        if s > at or n == 0:
                            pieces.append(raw[at:s])
                            n += 1
                            gone += e - s
                            at = e
                        elif e > at:
                            gone += e - at
                            at = e
                    pieces.append(raw[at:])
                    sizes.append(size)
                    removed.append(gone)
                    spans.append(n)
                    kept.append(b"".join(pieces))
                longs = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *longs, pa.array(kept, pa.binary())], names=["row", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    return rows.select("row", "text", "ranges", "copies").mapInArrow(
        run, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (all columns but the text), ``n_bytes``, ``n_removed``, ``n_spans``
    and ``kept``, the remaining bytes."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(others.alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    used = rows.filter("doc_id is not null and octet_length(text) >= 1").select("doc_id", "text")

    hashed = used.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = hashed.join(first.hint("merge"), "h").filter("doc_id > first").groupBy("doc_id").agg(F.collect_set("h").alias("copies"))
    copies = written(copies, "suffix-copies")

    spark = docs.sparkSession
    shared = written(_shared_runs(_rows_of_runs(used)), "suffix-shared")
    release(spark)
    by_doc = shared.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "hot")).alias("runs"))
    wanted = by_doc.join(copies.hint("merge"), "doc_id", "left")
    fragments = written(_fragments(used.join(wanted.hint("merge"), "doc_id")), "suffix-fragments", compression="zstd")
    release(spark)
    ranges = written(_bucket_ranges(fragments.filter("not hot")), "suffix-bucket-ranges")
    release(spark)
    ranges = ranges.unionAll(written(_hot_ranges(fragments.filter("hot")), "suffix-hot-ranges"))
    release(spark)
    ranges = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("h", "s", "e")).alias("ranges"))
    verdicts = written(ranges.join(copies.hint("merge"), "doc_id", "full"), "suffix-verdicts")
    return _cut(rows.join(verdicts.hint("merge"), "doc_id", "left"), rows.schema["row"].dataType.simpleString())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
