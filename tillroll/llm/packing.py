"""Operator 6: concatenate and cut.

Token streams of all documents are laid end to end in the order in which the
input is read and cut into fixed windows of ``size`` tokens, so only the very
last sequence is short.

Pass 1 tokenizes each input partition once and writes, per document, its ids
and its start *within the partition* (a running sum).  The partition totals --
one number per partition -- are prefix-summed into partition offsets.  Pass 2
joins the offsets and cuts: a document that crosses a window boundary leaves
one boundary record (piece) per window.  No text or id is shuffled.

Defined cases: a null text is the empty text (one piece holding the end id); a
null ``doc_id`` is carried; repeated rows are packed once each; an empty table
gives no piece; long documents span several sequences.  Extra columns of the
input are ignored.

Tokenizing: the vocabulary drops white space and never merges across it, so a
text's ids are the ids of its blank-separated words; each worker remembers the
ids of the words it has met lately (about ``WORDS_KEPT`` at most).  A text that waits
for the ids of new words is held as a number per word.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import table, written

# Production parameters.
SEQUENCE_TOKENS = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
WORDS_KEPT = 500_000
# The vocabulary's end-of-text mark and the end of its words.
_MARK, _MARK_ID = "<|endoftext|>", 49407
_WORD_END = "</w>"
_TAIL = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""


class Words(dict):
    """Word -> its place in ``ids``, which is given to a word when it is first looked
    up; ids that ``older`` does not know either are None, and the word is ``fresh``."""

    def __init__(self, older: Words | None = None):
        self.ids: list[bytes | None] = []
        self.fresh: list[bytes] = []
        self._older = older

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.ids)
        older = None if self._older is None else self._older.get(word)
        if older is None:
            self.fresh.append(word)
        self.ids.append(None if older is None else self._older.ids[older])
        return place

    def turned(self) -> Words:
        """The next words, which know these but none before."""
        self._older = None
        return Words(self)


class WordEncoder:
    """Texts -> ids (uint16 little-endian bytes) of a word-level BPE vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self._ends_word = np.zeros(1 << 16, bool)
        self._ends_word[[i for w, i in vocabulary.items() if w.endswith(_WORD_END)]] = True
        self._known = Words()

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)  # without places in the text
        return np.array(found.ids, dtype="<u2")

    def _learn(self) -> None:
        """The ids of the fresh words.  Punctuation after a letter is a unit of its own, so a word is its stem
        and its tail, and most tails and many stems are known.  A run of letters is
        one unit and a unit's last id is a word end, so many stems are encoded in
        one call; what is no run of letters is encoded between marks."""
        known = self._known
        cut: list[tuple[int, int, int]] = []
        plain, other = [], []
        for w in known.fresh:  # a stem or tail that is new comes in at the end
            stem = w.rstrip(_TAIL)
            text = stem.decode()
            if not text or not text[-1].isalpha():
                other.append(w)
            elif len(stem) < len(w):
                cut.append((known[w], known[stem], known[w[len(stem) :]]))
            elif text.isalpha():
                plain.append(w)
            else:
                other.append(w)
        known.fresh.clear()
        for k in range(0, len(plain), 512):
            part = plain[k : k + 512]
            ids = self._ids(b" ".join(part).decode())
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) == len(part):
                self._keep(part, ids, ends.tolist(), 0)
            else:
                other += part
        for k in range(0, len(other), 512):
            part = other[k : k + 512]
            ids = self._ids(f" {_MARK} ".join(w.decode() for w in part))
            self._keep(part, ids, [*np.flatnonzero(ids == _MARK_ID).tolist(), len(ids)], 1)
        for place, stem, tail in cut:
            known.ids[place] = known.ids[stem] + known.ids[tail]

    def _keep(self, words: list[bytes], ids: np.ndarray, ends: list[int], gap: int) -> None:
        raw, start, known = ids.tobytes(), 0, self._known
        for w, end in zip(words, ends, strict=True):
            known.ids[known[w]] = raw[2 * start : 2 * end]
            start = end + gap

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > WORDS_KEPT // 2:  # words not met again since the last turn are forgotten
            self._known = self._known.turned()
        known = self._known
        places: list[list[int] | None] = []
        for text in texts:
            raw = text.encode()
            if b"<|" in raw:  # may hold the vocabulary's special marks, which are case-sensitive
                places.append(None)
            else:  # ASCII case and blanks only; the vocabulary ignores both
                places.append(list(map(known.__getitem__, raw.lower().split())))
        self._learn()
        ids_of = known.ids.__getitem__
        return [self._ids(t).tobytes() if p is None else b"".join(map(ids_of, p)) for t, p in zip(texts, places, strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(vocabulary: str) -> WordEncoder:
    """One encoder per worker process; ``vocabulary`` is a path or the name of a public file."""
    if vocabulary not in _ENCODERS:
        path = vocabulary
        if "/" not in path:
            import public_tokenizers

            path = str(public_tokenizers.path(path))
        _ENCODERS[vocabulary] = WordEncoder(path)
    return _ENCODERS[vocabulary]


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Pass 1: ``part, nth, doc_id, local_start, n_tokens, ids`` (ids as
    little-endian 16-bit binary, the end id last)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, start = TaskContext.get().partitionId(), 0, 0
        encoder, end = _encoder(vocabulary), END_ID.to_bytes(2, "little")
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                piece = batch.slice(k, 256)
                ids = [x + end for x in encoder.encode([t or "" for t in piece.column(1).to_pylist()])]
                n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
                starts = start + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, np.int32)),
                        pa.array(nth + np.arange(len(n), dtype=np.int64)),
                        piece.column(0),
                        pa.array(starts),
                        pa.array(n),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["part", "nth", "doc_id", "local_start", "n_tokens", "ids"],
                )
                start, nth = start + int(n.sum()), nth + len(n)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        run, f"part int, nth long, doc_id {kind}, local_start long, n_tokens long, ids binary"
    )


def with_offsets(tokens: DataFrame) -> DataFrame:
    """Adds ``global_start``.  ``tokens`` must be written: pass 1 fixed the
    partition numbers.  The window runs over one row per partition."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = written(totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start")), "pack-offsets")
    return tokens.join(offsets, "part").withColumn("global_start", F.col("part_start") + F.col("local_start"))


PIECES = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _cut(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(1).to_numpy()
            n = batch.column(2).to_numpy()
            per_doc = np.where(n > 0, (first + n - 1) // size - first // size + 1, 0)
            row = np.repeat(np.arange(len(n)), per_doc)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            sequence = first[row] // size + nth
            begin = np.maximum(sequence * size, first[row])
            length = np.minimum((sequence + 1) * size, first[row] + n[row]) - begin
            start = begin - first[row]
            ids = batch.column(3)
            cut, last, wide = [], -1, b""
            for r, a, m in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
                if r != last:
                    wide, last = np.frombuffer(ids[r].as_py(), "<u2").astype("<u4").tobytes(), r
                cut.append(wide[4 * a : 4 * (a + m)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(n[row]),
                    pa.array(sequence),
                    pa.array(begin - sequence * size),
                    pa.array(cut, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(
    docs: DataFrame, size: int = SEQUENCE_TOKENS, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Pieces: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``
    (ids of the piece, 32-bit little-endian).  Sequences are read back by
    ordering the pieces of a ``sequence_id`` by ``offset``; windows are full
    but for the last, whose length is padded to ``size`` unless it is a power
    of two."""
    tokens = written(tokenized(docs, doc_id, text, vocabulary), "pack-tokens", compression="zstd")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return with_offsets(tokens).select("doc_id", "global_start", "n_tokens", "ids").mapInArrow(
        _cut(size), f"doc_id {kind}, {PIECES}"
    )


def digests(pieces: DataFrame) -> DataFrame:
    """Replaces ``ids`` by their CRC-32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))
