"""Operator 11: phrase collocation mining over weighted acyclic automata.

Counts of word n-grams are held in deterministic acyclic automata whose states
carry weights (``CountAutomaton``): the weight of the state that a phrase leads to
is the phrase's count, and states with equal weight and equal arcs are one state.

1. Range bounds: phrases are ordered by language and words, and the order is cut
   into ``RANGES_PER_PARTITION`` prefix ranges per shuffle partition, at quantiles of
   a bounded sample of word positions.  They decide where a phrase is held, not what
   is found.
2. Shards: every task counts the n-grams of blocks of ``BLOCK_TOKENS`` words, sorts
   them, and builds an automaton per range from them, incrementally: a state is
   closed and looked up in the register once the sorted phrases have passed it.
3. Union: the automata of a range meet in a task, which sums their weights.  Phrases
   below the least count are left out: no part of a candidate can be below it.
4. Part lookups: a candidate's parts lie in other ranges.  Each range sends each other
   one an automaton of the parts it asks for, once per part, however many candidates
   share it; composed with the counts there it comes back with the parts' counts.
   The request's weight is the largest candidate that asks, so the range of a
   two-word phrase also learns the largest longer candidate that holds it.
5. Scores are exact (Python integers), and the first of each language are found by
   one range sort of what is among the first of its range.

No task holds more than a block of words or a range's automata; a word or phrase of
any frequency is one entry per block.  A range may start within the phrases of one
word, so a frequent first word is spread over several.

Defined cases: a null text is the empty text; a null language is ``und``; repeated
rows count each; texts of any length are counted whole, word by word, in blocks that
overlap by the words a phrase needs; ties go to the larger count, then to the phrase
that is smaller in UTF-8 bytes; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import run_bounds, table, text_of, whole_groups, written
from tillroll.operators.ranking import row_number_global

# Production parameters.
LEAST_COUNT = 10
INSIDE_PERCENT = 50
FIRST = 2000
SCORE_UNIT = 1_000_000
BLOCK_TOKENS = 1_500_000
CHUNK_BYTES = 1 << 22
RANGES_PER_PARTITION = 4
SAMPLES_PER_RANGE = 16
SAMPLE_CHARS = 100
# Word ids of a block have 21 bits in its sort keys; phrases have three words at most.
_BITS = 21
_MASK = (1 << _BITS) - 1
LONGEST = 3
# The contract's lower case, word gaps and piece ends.
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\v\f\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"

_AUTOMATON = "words binary, weights binary, sizes binary, arcs binary"

Bound = tuple[str, bytes, bytes]


class CountAutomaton:
    """Phrases of up to three words with weights above zero.

    State ``s`` has ``weight[s]`` and the arcs ``start[s] .. start[s + 1]``: a word
    (its place in the sorted ``words``) and the state it leads to.  Arcs are sorted by
    word, states stand after those that their arcs lead to, the last is the root.
    """

    def __init__(self, words: list[bytes], weight: np.ndarray, start: np.ndarray, arcs: np.ndarray):
        self.words, self.weight, self.start = words, weight, start
        self.word, self.to = arcs[:, 0].astype(np.int64), arcs[:, 1].astype(np.int64)

    @classmethod
    def build(cls, vocabulary: list[bytes], phrases: np.ndarray, weights: np.ndarray) -> CountAutomaton:
        """From phrases in order: rows of word numbers from 1 on, zeros behind the end.

        Once the phrases have passed a prefix its state is closed: it is the state of
        the register with that weight and those arcs, or a new one.  States behind
        three words have no arcs and are told apart by weight alone.
        """
        used = np.flatnonzero(np.bincount(phrases.ravel(), minlength=1)[1:])
        words = [vocabulary[k] for k in used.tolist()]
        number = np.zeros(len(vocabulary) + 1, np.int32)
        number[used + 1] = np.arange(len(used))
        first, second, third = (number[phrases[:, k]] for k in range(LONGEST))
        long, short = phrases[:, 2] > 0, phrases[:, 1] == 0
        leaf_weight, leaf = np.unique(weights[long], return_inverse=True)
        arcs3 = np.stack([third[long], leaf], axis=1).astype("<i4")
        raw = arcs3.tobytes()
        # runs of equal first two words, and of equal first words
        new_first, new_pair = np.ones((2, len(phrases)), bool)
        new_first[1:] = phrases[1:, 0] != phrases[:-1, 0]
        new_pair[1:] = (phrases[1:, 1] != phrases[:-1, 1]) | new_first[1:]
        pair = np.flatnonzero(new_pair & ~short)
        before = np.concatenate([[0], np.cumsum(long)])
        own = np.where(long[pair], 0, weights[pair])  # an entry of its own stands before those that extend it
        ends = before[np.append(pair, len(phrases))[1:]]
        opens = np.flatnonzero(new_first)
        alone = np.where(short[opens], weights[opens], 0)
        of_first = np.searchsorted(pair, np.append(opens, len(phrases))).tolist()

        register: dict[tuple[int, bytes], int] = {(w, b""): k for k, w in enumerate(leaf_weight.tolist())}
        state_weight, begin, end = leaf_weight.tolist(), [0] * len(leaf_weight), [0] * len(leaf_weight)

        def closed(weight: int, arcs: bytes, a: int, z: int) -> int:
            state = register.setdefault((weight, arcs), len(state_weight))
            if state == len(state_weight):
                state_weight.append(weight)
                begin.append(a)
                end.append(z)
            return state

        arcs2, root = array("i"), array("i")
        pairs = zip(own.tolist(), before[pair].tolist(), ends.tolist(), second[pair].tolist(), strict=True)
        for symbol, weight, a, z in zip(first[opens].tolist(), alone.tolist(), of_first[:-1], of_first[1:], strict=True):
            for w, s, e, word in islice(pairs, z - a):
                arcs2.append(word)
                arcs2.append(closed(w, raw[8 * s : 8 * e], s, e))
            root.append(symbol)
            root.append(closed(weight, arcs2[2 * a :].tobytes(), len(arcs3) + a, len(arcs3) + z))
        state_weight.append(0)
        arcs = np.concatenate([arcs3.ravel(), np.array(arcs2, "<i4"), np.array(root, "<i4")]).reshape(-1, 2)
        begin.append(len(arcs) - len(root) // 2)
        end.append(len(arcs))
        sizes = np.array(end) - begin
        start = np.concatenate([[0], np.cumsum(sizes)])
        return cls(words, np.array(state_weight, np.int64), start, arcs[np.repeat(begin - start[:-1], sizes) + np.arange(start[-1])])

    def columns(self) -> tuple[bytes, bytes, bytes, bytes]:
        arcs = np.stack([self.word, self.to], axis=1).astype("<i4")
        return b" ".join(self.words), self.weight.astype("<i8").tobytes(), np.diff(self.start).astype("<i4").tobytes(), arcs.tobytes()

    @classmethod
    def read(cls, row: dict) -> CountAutomaton:
        start = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], "<i4"))])
        words = row["words"].split(b" ") if row["words"] else []
        return cls(words, np.frombuffer(row["weights"], "<i8"), start, np.frombuffer(row["arcs"], "<i4").reshape(-1, 2))

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases (rows of word numbers from 1 on, zeros behind the end) and weights."""
        states, paths = np.array([len(self.weight) - 1]), np.zeros((1, LONGEST), np.int64)
        found, weights = [np.zeros((0, LONGEST), np.int64)], [np.zeros(0, np.int64)]
        for depth in range(LONGEST):
            count = self.start[states + 1] - self.start[states]
            parent = np.repeat(np.arange(len(states)), count)
            arc = np.repeat(self.start[states] - (np.cumsum(count) - count), count) + np.arange(len(parent))
            paths = paths[parent]
            paths[:, depth] = self.word[arc] + 1
            states = self.to[arc]
            entry = self.weight[states] > 0
            found.append(paths[entry])
            weights.append(self.weight[states][entry])
        return np.concatenate(found), np.concatenate(weights)

    def compose(self, words: list[bytes], phrases: np.ndarray) -> np.ndarray:
        """Weights of phrases over another list of words (zero if absent): both
        sides step along the same words from the roots."""
        place = {w: k for k, w in enumerate(self.words)}
        own = np.array([place.get(w, -1) for w in words] + [-1], np.int64)
        keys = np.repeat(np.arange(len(self.weight)), np.diff(self.start)) * (len(self.words) + 1) + self.word
        states = np.full(len(phrases), len(self.weight) - 1)
        for k in range(LONGEST):
            step = (phrases[:, k] > 0) & (states >= 0)
            word = own[phrases[:, k] - 1]
            wanted = states * (len(self.words) + 1) + word
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            known = step & (word >= 0) & (keys[at] == wanted if len(keys) else False)
            states = np.where(known, self.to[at] if len(keys) else -1, np.where(step, -1, states))
        return np.where(states >= 0, self.weight[states], 0)


def union(parts: list[CountAutomaton], merge=np.add) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The sorted words, phrases and merged weights (``merge`` is a ufunc) of several automata."""
    words = sorted(set(chain.from_iterable(p.words for p in parts)))
    place = {w: k for k, w in enumerate(words, 1)}
    rows, weights = [np.zeros((0, LONGEST), np.int64)], [np.zeros(0, np.int64)]
    for p in parts:
        number = np.array([0, *map(place.__getitem__, p.words)], np.int64)
        phrases, weight = p.phrases()
        rows.append(number[phrases])
        weights.append(weight)
    phrases, weight = np.concatenate(rows), np.concatenate(weights)
    order = np.lexsort(phrases.T[::-1])
    phrases, weight = phrases[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True] * bool(len(phrases)), (phrases[1:] != phrases[:-1]).any(axis=1)]))
    return words, phrases[first], merge.reduceat(weight, first) if len(first) else weight


def cut_by(bounds: list[Bound], lang: str, vocabulary: list[bytes], phrases: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(range, rows) of sorted phrases: range k holds what lies from bound k - 1 on and before bound k."""
    low, high = bisect_left(bounds, (lang, b"", b"")), bisect_left(bounds, (lang + "\0", b"", b""))
    span = len(vocabulary) + 2
    keys = phrases[:, 0] * span + phrases[:, 1]
    at = []
    for _, first, second in bounds[low:high]:
        k = bisect_left(vocabulary, first)
        there = k < len(vocabulary) and vocabulary[k] == first
        at.append((k + 1) * span + ((bisect_left(vocabulary, second) + 1 if second else 0) if there else 0))
    ends = [0, *np.searchsorted(keys, at).tolist(), len(keys)]
    for k, (a, z) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if a < z:
            yield low + k, slice(a, z)


class _Numbers(dict):
    """Word -> number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Blocks:
    """The words of one language in this task, counted block by block."""

    def __init__(self):
        self.numbers = _Numbers()
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self._restart([])

    def _restart(self, carried: list[bytes]) -> None:
        self.numbers = _Numbers({b"\n": 0, b"": 1})
        tokens = np.array([self.numbers[w] for w in carried], np.int64)
        self.waiting, self.size = [tokens], len(tokens)

    def add(self, text: bytes) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """Take a text in; give the counts of the blocks that it fills."""
        raw, at = text.translate(_NORMAL), 0
        while at < len(raw):  # whole words, some megabytes at a time
            end = raw.find(b" ", at + CHUNK_BYTES)
            end = len(raw) if end < 0 else end
            words = raw[at:end].replace(b"\n", b" \n ").split(b" ")
            tokens = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            tokens = tokens[tokens != 1]
            at = end + 1
            k = 0
            while k < len(tokens):  # a block is never longer, so its words have numbers of ``_BITS``
                part = tokens[k : k + max(1, BLOCK_TOKENS - self.size)]
                k += len(part)
                self.waiting.append(part)
                self.size += len(part)
                if self.size >= BLOCK_TOKENS:
                    rest = tokens[k:]
                    names = list(self.numbers) if len(rest) else []
                    yield self._counted(last=False)
                    if len(rest):  # numbers were given anew
                        tokens[k:] = [self.numbers[names[x]] for x in rest.tolist()]
        self.waiting.append(np.zeros(1, np.int64))
        self.size += 1

    def finish(self) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        if self.size:
            yield self._counted(last=True)

    def _counted(self, last: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Vocabulary, phrases and counts of the waiting words.  Phrases count where
        they start; the last words wait for what follows."""
        tokens = np.concatenate(self.waiting)
        names = list(self.numbers)
        starts = len(tokens) if last else len(tokens) - (LONGEST - 1)
        vocabulary = sorted({names[k] for k in np.unique(tokens).tolist()} - {b"\n"})
        place = {w: k for k, w in enumerate(vocabulary, 1)}
        rank = np.array([place.get(w, 0) for w in names], np.int64)[tokens]
        self._restart([names[k] for k in tokens[starts:].tolist()])
        rank = np.concatenate([rank, np.zeros(LONGEST, np.int64)])
        a, b, c = (rank[k : k + starts] for k in range(LONGEST))
        one = a << 2 * _BITS
        two = (one | b << _BITS)[(a > 0) & (b > 0)]
        three = (one | b << _BITS | c)[(a > 0) & (b > 0) & (c > 0)]
        keys, counts = np.unique(np.concatenate([one[a > 0], two, three]), return_counts=True)
        return vocabulary, np.stack([keys >> 2 * _BITS, keys >> _BITS & _MASK, keys & _MASK], axis=1), counts


def _rows(found: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as small batches."""
    waiting, size = [], 0
    for row in found:
        waiting.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > 1 << 23 or len(waiting) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting, strict=True), types, strict=True)], names=names)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting, strict=True), types, strict=True)], names=names)


_FIELDS = ["words", "weights", "sizes", "arcs"]
_BYTES = [pa.binary()] * 4


def range_bounds(docs: DataFrame) -> list[Bound]:
    """Language, first and second word where ranges start.  Texts are drawn with the
    chance of their length, so about ``SAMPLES_PER_RANGE`` a range come to the driver."""
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = docs.withColumn("size", F.length("text").cast("long"))  # times the samples it is no int
    total = sized.agg(F.sum("size")).first()[0] or 0
    drawn = sized.filter(F.rand(11) * F.lit(total) < F.col("size") * F.lit(SAMPLES_PER_RANGE * ranges))
    at = (F.rand(12) * F.greatest(F.col("size") - SAMPLE_CHARS, F.lit(0))).cast("int") + 1
    sample = drawn.select("lang", F.substring("text", at, F.lit(SAMPLE_CHARS)).alias("near")).collect()
    words = [(r.lang, r.near.encode().translate(_NORMAL).replace(b"\n", b" ").split()) for r in sample]
    places = sorted((lang, w[len(w) // 2 - 1], w[len(w) // 2]) for lang, w in words if len(w) > 3)
    return sorted({places[len(places) * k // ranges] for k in range(1, ranges)}) if places else []


def _shards(docs: DataFrame, bounds: list[Bound]) -> DataFrame:
    """Automata of each block of words and range."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            blocks: dict[str, _Blocks] = {}
            for batch in batches:
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                    counted = blocks.setdefault(lang, _Blocks()).add(text.as_py())
                    yield from ((lang, *x) for x in counted)
                if sum(b.size for b in blocks.values()) >= 2 * BLOCK_TOKENS:
                    yield from ((lang, *x) for lang, b in blocks.items() for x in b.finish())
                    blocks = {}
            yield from ((lang, *x) for lang, b in blocks.items() for x in b.finish())

        def automata():
            for lang, vocabulary, phrases, counts in parts():
                for k, rows in cut_by(bounds, lang, vocabulary, phrases):
                    yield k, lang, *CountAutomaton.build(vocabulary, phrases[rows], counts[rows]).columns()

        return _rows(automata(), ["part", "lang", *_FIELDS], [pa.int32(), pa.string(), *_BYTES])

    return docs.select("lang", "text").mapInArrow(count, f"part int, lang string, {_AUTOMATON}")


def _of_lang(rows: list[dict]) -> dict[str, list[dict]]:
    by: dict[str, list[dict]] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    return by


def counted(docs: DataFrame, bounds: list[Bound], least: int) -> DataFrame:
    """One automaton per range and language with the phrases found ``least`` times,
    and ``n``, all words of that language that lie in the range."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def automata():
            parts = (g.slice(a, z - a) for g in whole_groups(batches, "part") for a, z in run_bounds(g.column("part").to_numpy()))
            for lang, rows in (x for part in parts for x in _of_lang(part.to_pylist()).items()):
                words, phrases, weights = union([CountAutomaton.read(r) for r in rows])
                n = int(weights[phrases[:, 1] == 0].sum())
                often = weights >= least
                yield rows[0]["part"], lang, n, *CountAutomaton.build(words, phrases[often], weights[often]).columns()

        return _rows(automata(), ["part", "lang", "n", *_FIELDS], [pa.int32(), pa.string(), pa.int64(), *_BYTES])

    shards = _shards(docs, bounds).repartition("part").sortWithinPartitions("part")
    return shards.mapInArrow(merge, f"part int, lang string, n long, {_AUTOMATON}")


def _parts_of(phrases: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words before the cut, first parts, rests) of candidates of one length."""
    length = int((phrases[0] > 0).sum())
    for k in range(1, length):
        first, rest = np.zeros_like(phrases), np.zeros_like(phrases)
        first[:, :k] = phrases[:, :k]
        rest[:, : length - k] = phrases[:, k:length]
        yield k, first, rest


def _candidates(counts: CountAutomaton) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of each length with their counts."""
    phrases, weights = counts.phrases()
    length = (phrases > 0).sum(axis=1)
    for n in range(2, LONGEST + 1):
        if (length == n).any():
            yield phrases[length == n], weights[length == n]


def _largest(phrases: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct phrases and the largest weight of each."""
    order = np.lexsort(phrases.T[::-1])
    phrases, weights = phrases[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], (phrases[1:] != phrases[:-1]).any(axis=1)]))
    return phrases[first], np.maximum.reduceat(weights, first)


def _requests(counts: DataFrame, bounds: list[Bound]) -> DataFrame:
    """Automata of the parts that a range's candidates have in each range."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def automata():
            for row in (r for b in batches for r in b.to_pylist()):
                own = CountAutomaton.read(row)
                parts = [(p, w) for phrases, w in _candidates(own) for _, *cut in _parts_of(phrases) for p in cut]
                if not parts:
                    continue
                phrases, weights = _largest(np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts]))
                for k, rows in cut_by(bounds, row["lang"], own.words, phrases):
                    yield k, row["part"], row["lang"], *CountAutomaton.build(own.words, phrases[rows], weights[rows]).columns()

        return _rows(automata(), ["part", "asker", "lang", *_FIELDS], [pa.int32(), pa.int32(), pa.string(), *_BYTES])

    return counts.mapInArrow(ask, f"part int, asker int, lang string, {_AUTOMATON}")


def _answer(counts: pa.Table, requests: pa.Table) -> pa.Table:
    """Counts of the parts asked for; and, to the range itself (``inside``), the
    largest longer candidate around each of its two-word phrases."""
    own = {r["lang"]: CountAutomaton.read(r) for r in counts.to_pylist()}
    out = []
    asked = _of_lang(requests.to_pylist())
    for lang, rows in asked.items():
        automata = [CountAutomaton.read(r) for r in rows]
        for r, a in zip(rows, automata, strict=True):
            phrases, _ = a.phrases()
            order = np.lexsort(phrases.T[::-1])
            phrases = phrases[order]
            found = own[lang].compose(a.words, phrases)
            out.append((r["asker"], lang, False, *CountAutomaton.build(a.words, phrases, found).columns()))
        words, phrases, largest = union(automata, np.maximum)
        two = phrases[:, 1] > 0
        out.append((rows[0]["part"], lang, True, *CountAutomaton.build(words, phrases[two], largest[two]).columns()))
    types = [pa.int32(), pa.string(), pa.bool_(), *_BYTES]
    names = ["part", "lang", "inside", *_FIELDS]
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)


def _score(inside_percent: int):
    def run(counts: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        told = _of_lang(answers.to_pylist())
        for row in counts.to_pylist():
            own, lang = CountAutomaton.read(row), row["lang"]
            replies = told.get(lang, [])
            parts = CountAutomaton.build(*union([CountAutomaton.read(r) for r in replies if not r["inside"]]))
            around = CountAutomaton.build(*union([CountAutomaton.read(r) for r in replies if r["inside"]], np.maximum))
            for phrases, weights in _candidates(own):
                hidden = np.zeros(len(phrases), bool)
                if phrases[0, 2] == 0:
                    # a request by a two-word candidate is for single words, so these weights are of longer ones
                    largest = around.compose(own.words, phrases)
                    hidden = (largest > 0) & (100 * largest >= inside_percent * weights)
                cuts = [(parts.compose(own.words, f).tolist(), parts.compose(own.words, r).tolist()) for _, f, r in _parts_of(phrases)]
                for k in np.flatnonzero(~hidden).tolist():
                    a = int(weights[k])
                    score, _, l, r = min((SCORE_UNIT * a * a // (f[k] * r[k]), n, f[k], r[k]) for n, (f, r) in enumerate(cuts))
                    phrase = b" ".join(own.words[w - 1] for w in phrases[k].tolist() if w).decode()
                    out.append((lang, row["part"], phrase, a, l, r, score))
        types = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 4]
        names = ["lang", "part", "phrase", "a", "l", "r", "score"]
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=names)

    return run


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, inside_percent: int = INSIDE_PERCENT) -> tuple[DataFrame, DataFrame]:
    """All candidates that are kept (lang, part, phrase, a, l, r, score), and the
    words of each language (lang, n)."""
    docs = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), text_of(F.col(f"`{text}`")).alias("text"))
    bounds = range_bounds(docs)
    counts = written(counted(docs, bounds, least), "phrases-counts")
    requests = _requests(counts, bounds)
    plain = counts.drop("n")
    answers = plain.groupBy("part").cogroup(requests.groupBy("part")).applyInArrow(
        _answer, f"part int, lang string, inside boolean, {_AUTOMATON}"
    )
    scored = plain.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _score(inside_percent), "lang string, part int, phrase string, a long, l long, r long, score long"
    )
    return scored, counts.groupBy("lang").agg(F.sum("n").alias("n"))


def first_phrases(docs: DataFrame, first: int = FIRST, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    scored, totals = candidates(docs, **options)
    scored = written(scored, "phrases-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # what is not among the first of its range is not among the first at all
    near = scored.repartition("lang", "part").withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    near = near.filter(F.col("at") <= first).withColumns({"down": -F.col("score"), "less": -F.col("a")}).drop("part", "at")
    numbered, _ = row_number_global(written(near, "phrases-near"), ["lang", "down", "less", "phrase"], "place")
    before = numbered.groupBy("lang").agg(F.min("place").alias("start"))
    ranked = numbered.join(before, "lang").withColumn("rank", F.col("place") - F.col("start") + 1).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_phrases(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH piece AS (
    SELECT lang, unnest(regexp_split_to_array(text, '{PIECE_ENDS}')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
          FROM documents)
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM piece
), place AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM listed
), gram AS (
    SELECT lang, 1 AS size, words[i] AS phrase FROM place
    UNION ALL
    SELECT lang, 2, concat_ws(' ', words[i], words[i + 1]) FROM place WHERE i + 1 <= len(words)
    UNION ALL
    SELECT lang, 3, concat_ws(' ', words[i], words[i + 1], words[i + 2]) FROM place WHERE i + 2 <= len(words)
), f AS (
    SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM gram GROUP BY ALL
), common AS MATERIALIZED (
    SELECT lang, size, phrase, string_split(phrase, ' ') AS words, f FROM f WHERE f >= {LEAST_COUNT}
), part AS (
    SELECT lang, size, phrase, f, k, array_to_string(words[1 : k], ' ') AS first, array_to_string(words[k + 1 : size], ' ') AS rest
    FROM common, (VALUES (1), (2)) AS cuts(k) WHERE k < size
), candidate AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, {SCORE_UNIT}::HUGEINT * c.f * c.f // (x.f * y.f) AS score
    FROM part AS c
    JOIN common AS x ON x.lang = c.lang AND x.phrase = c.first
    JOIN common AS y ON y.lang = c.lang AND y.phrase = c.rest
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, part, max(f) AS f
    FROM (SELECT lang, f, unnest([words[1] || ' ' || words[2], words[2] || ' ' || words[3]]) AS part FROM common WHERE size = 3)
    GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM candidate AS c JOIN total AS t ON t.lang = c.lang
LEFT JOIN inside AS i ON i.lang = c.lang AND i.part = c.phrase
WHERE i.f IS NULL OR 100 * i.f < {INSIDE_PERCENT} * a
QUALIFY rank <= {FIRST}
"""
