"""Operator 12: byte-level BPE encoding and decoding.

Every Python worker opens a DuckDB database of its own in memory (one thread, a
fixed memory limit, no files, no port) holding the vocabulary and the merge table: all
pairs of tokens whose bytes together are a token.  The words that the worker
has not met lately are laid out as rows (word, position, token), one per byte.  A
recursive query joins neighbouring rows with the merge table and contracts each
word's leftmost pair of minimum rank; words without such a pair leave the working
table, which ends at the fixpoint.  Decoding joins token rows with the vocabulary
and concatenates the bytes by an aggregate ordered by position.

Words are the matches of the tokenizer's pattern; a word that is a token is that
token.  Words above ``LONG_WORD`` bytes need many steps, so two exact shortcuts
hold for them: they are cut where no token holds both neighbouring bytes (no merge
can cross), and all occurrences of the minimum pair are contracted in one step if
no pair of lower rank can arise from it (no token of lower rank starts or ends with
the merged one); otherwise the leftmost one only.

A query costs much by itself, so the new words of many texts go into one.
Words of a text of Latin-1 characters are matched by ``re``, whose pattern says the
same of these.

Bounds: a worker holds the ids of about ``WORDS_KEPT`` words, a text that waits for
its ids is held as a number per word until ``NEW_WORDS`` are new, and a query gets
``QUERY_BYTES`` bytes of words or ``QUERY_TOKENS`` tokens (one word of any length
at least).  Longer id lists are decoded in slices.

Defined cases: a null text is the empty text and has no ids; null ids decode to
null; an id outside the vocabulary, or a null one, is an error; repeated rows are
coded once each; an empty table gives an empty result; columns of the input come
back in ``row``, so their names cannot clash.  Texts are never cut.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import rows_as_struct, table, text_of

# Production parameters.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORDS_KEPT = 400_000
QUERY_BYTES = 500_000
QUERY_TOKENS = 500_000
NEW_WORDS = 20_000
LONG_WORD = 64
MEMORY_LIMIT = "400MB"

#: What the classes of the pattern are up to U+00FF.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN = {r"[^\s\p{L}\p{N}]": f"[^{_S}{_L}{_N}]", r"\p{L}": f"[{_L}]", r"\p{N}": f"[{_N}]", r"\s": f"[{_S}]", r"\S": f"[^{_S}]"}

#: Contract the leftmost pair of minimum rank of each word, until no word has one.
#: A row that a contraction has swallowed keeps its key and loses its token.  Word and
#: position (below 128 here) are one number, and rank and both positions are compared
#: as one.
CONTRACT = """
WITH RECURSIVE run(k, tok) USING KEY (k) AS (
    SELECT (w::BIGINT << 7) + pos, tok FROM base
    UNION ALL
    (WITH pair AS (
        SELECT k, tok, lead(tok) OVER line AS nxt, lead(k) OVER line AS nxt_k
        FROM run WHERE tok IS NOT NULL
        WINDOW line AS (ORDER BY k)
    ), least AS (
        SELECT k >> 7 AS w, min((merged::BIGINT << 14) + ((k & 127) << 7) + (nxt_k & 127)) AS m
        FROM pair JOIN merge ON l = tok AND r = nxt WHERE k >> 7 = nxt_k >> 7 GROUP BY 1
    )
    SELECT k, CASE k & 127 WHEN (m >> 7) & 127 THEN (m >> 14)::INTEGER WHEN m & 127 THEN NULL ELSE tok END
    FROM run JOIN least ON w = k >> 7 WHERE tok IS NOT NULL)
)
SELECT (k >> 7)::INTEGER AS w, tok FROM run WHERE tok IS NOT NULL ORDER BY k
"""

#: The same for long words.  Occurrences that follow each other directly overlap:
#: of such an island every other one is contracted, from the left.
CONTRACT_LONG = """
WITH RECURSIVE run(w, pos, tok) USING KEY (w, pos) AS (
    SELECT w, pos, tok FROM base
    UNION ALL
    (WITH line AS (
        SELECT w, pos, tok, lead(tok) OVER word AS nxt, row_number() OVER word AS i
        FROM run WHERE tok IS NOT NULL
        WINDOW word AS (PARTITION BY w ORDER BY pos)
    ), pair AS (
        SELECT line.*, safe, min(merged) OVER (PARTITION BY w) AS best,
               coalesce(merged = min(merged) OVER (PARTITION BY w), false) AS hit
        FROM line LEFT JOIN merge ON l = tok AND r = nxt
    ), counted AS (
        SELECT *, row_number() OVER (PARTITION BY w, hit ORDER BY i) AS k FROM pair WHERE best IS NOT NULL
    ), chosen AS (
        SELECT w, pos, tok, i, best,
               hit AND (k = 1 OR safe AND row_number() OVER (PARTITION BY w, hit, i - k ORDER BY i) % 2 = 1) AS here
        FROM counted
    )
    SELECT w, pos, CASE WHEN lag(here, 1, false) OVER (PARTITION BY w ORDER BY i) THEN NULL
                        WHEN here THEN best ELSE tok END
    FROM chosen)
)
SELECT w, tok FROM run WHERE tok IS NOT NULL ORDER BY w, pos
"""

DECODE = """
SELECT part, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes, count(*) AS n
FROM ids JOIN vocabulary USING (id) GROUP BY part ORDER BY part
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank (which is the id) of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Words(dict):
    """Word -> its place in ``ids``, which is given to a word when it is first looked
    up; ids that ``older`` does not know either are None, and the word is ``fresh``."""

    def __init__(self, older: Words | None = None):
        self.ids: list[bytes | None] = []
        self.fresh: list[str] = []
        self._older = older

    def __missing__(self, word: str) -> int:
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


class DuckBpe:
    """The vocabulary, its merge table and the words met lately."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self._ranks = ranks = read_ranks(path)
        self._words_of = regex.compile(pattern).findall
        for kind, chars in LATIN.items():
            pattern = pattern.replace(kind, chars)
        self._latin_words_of = self._words_of if "\\p" in pattern else re.compile(pattern).findall
        self._con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY_LIMIT, "temp_directory": ""})
        self._con.register("v", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self._con.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
        self._older = Words()  # what was known before the last turn
        self._known = Words(self._older)
        self._ready = False

    def _prepare(self) -> None:
        """The merge table, the token of each byte, and the pairs of bytes that some token holds."""
        ranks = self._ranks
        pairs = [
            (left, right, merged)
            for token, merged in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        ]
        l, r, merged = np.array(pairs, np.int32).reshape(-1, 3).T
        unsafe = np.union1d(l[merged < l], r[merged < r])
        self._con.register("m", pa.table({"l": l, "r": r, "merged": merged, "safe": ~np.isin(merged, unsafe)}))
        self._con.execute("CREATE TABLE merge AS SELECT * FROM m")
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._inside = np.zeros(1 << 16, bool)
        for token in ranks:
            b = np.frombuffer(token, np.uint8).astype(np.int32)
            self._inside[b[:-1] * 256 + b[1:]] = True
        self._ready = True

    def _contracted(self, words: list[bytes], query: str) -> list[bytes]:
        """The ids of each word, as bytes of int32."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words])
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        self._con.register("base", pa.table({"w": w, "pos": pos, "tok": self._byte_ids[raw]}))
        out = self._con.sql(query).to_arrow_table()
        ends = np.cumsum(np.bincount(out["w"].to_numpy(), minlength=len(words)))
        ids = out["tok"].to_numpy().astype("<i4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _in_parts(self, words: list[bytes], query: str) -> Iterator[bytes]:
        part, size = [], 0
        for w in words:
            if part and size + len(w) > QUERY_BYTES:
                yield from self._contracted(part, query)
                part, size = [], 0
            part.append(w)
            size += len(w)
        if part:
            yield from self._contracted(part, query)

    def _pieces(self, word: bytes) -> list[bytes]:
        """A long word cut where no token holds both neighbouring bytes."""
        b = np.frombuffer(word, np.uint8).astype(np.int32)
        cuts = np.flatnonzero(~self._inside[b[:-1] * 256 + b[1:]]) + 1
        return [word[a:z] for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(word)], strict=True)]

    def _split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._words_of(text)
        return self._latin_words_of(text)

    def _learn(self) -> None:
        """The ids of the fresh words."""
        known = self._known
        short: dict[int, bytes] = {}
        long: dict[int, list[bytes]] = {}
        for word in known.fresh:
            raw, place = word.encode(), known[word]
            if (rank := self._ranks.get(raw)) is not None:
                known.ids[place] = rank.to_bytes(4, "little")
                continue
            if not self._ready:
                self._prepare()
            if len(raw) <= LONG_WORD:
                short[place] = raw
            else:
                long[place] = self._pieces(raw)
        known.fresh.clear()
        for place, ids in zip(short, self._in_parts(list(short.values()), CONTRACT), strict=True):
            known.ids[place] = ids
        pieces = list(dict.fromkeys(p for cut in long.values() for p in cut))
        ids = dict(zip(pieces, self._in_parts(pieces, CONTRACT_LONG), strict=True))
        for place, cut in long.items():
            known.ids[place] = b"".join(ids[p] for p in cut)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; new words of many texts go into one query."""
        at = 0
        while at < len(texts):
            if len(self._known) > WORDS_KEPT // 2:
                self._older, self._known = self._known, self._known.turned()
            known, places = self._known, []
            while at < len(texts) and len(known.fresh) < NEW_WORDS:
                words = self._split(texts[at])
                places.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                at += 1
            self._learn()
            ids_of = known.ids.__getitem__
            for text in places:
                yield np.frombuffer(b"".join(map(ids_of, text.tolist())), "<i4")

    def decode(self, rows: list[np.ndarray]) -> Iterator[bytes]:
        """The bytes of each list of ids."""
        slices = [(k, ids[a : a + QUERY_TOKENS]) for k, ids in enumerate(rows) for a in range(0, len(ids), QUERY_TOKENS)]
        out: list[list[bytes]] = [[] for _ in rows]
        part: list[tuple[int, np.ndarray]] = []
        size = 0
        for s in [*slices, None]:
            if s is None or size + len(s[1]) > QUERY_TOKENS:
                for (k, _), piece in zip(part, self._joined([ids for _, ids in part]), strict=True):
                    out[k].append(piece)
                part, size = [], 0
            if s is not None:
                part.append(s)
                size += len(s[1])
        return map(b"".join, out)

    def _joined(self, parts: list[np.ndarray]) -> list[bytes]:
        if not parts:
            return []
        sizes = np.array([len(p) for p in parts])
        ids = np.concatenate(parts).astype(np.int32)
        self._con.register("ids", pa.table({
            "part": np.repeat(np.arange(len(parts), dtype=np.int32), sizes),
            "pos": np.arange(len(ids), dtype=np.int32),
            "id": ids,
        }))
        found = self._con.sql(DECODE).to_arrow_table()
        if found["n"].to_numpy().sum() != len(ids):
            raise ValueError("an id is not in the vocabulary")
        return found["bytes"].to_pylist()


@lru_cache(maxsize=1)
def _tokenizer(vocabulary: str) -> DuckBpe:
    """The tokenizer of this process: a worker that runs several tasks keeps its words."""
    import public_tokenizers

    return DuckBpe(str(public_tokenizers.path(vocabulary)), public_tokenizers.PATTERN)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(x) for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)))


def encode(docs: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """``row`` (the columns ``keep`` of the input, all if not given) and ``ids``,
    the token ids of the column ``text``."""
    rows = rows_as_struct(docs, text=text_of(F.col(f"`{text}`")))
    if keep is not None:
        rows = rows.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in keep]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or _tokenizer(vocabulary)
            ids = list(coder.encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(ids)], names=["row", "ids"])

    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def decode(coded: DataFrame, ids: str = "ids", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """``row`` (the columns ``keep`` of the input, all if not given) and ``decoded``,
    the bytes that the column ``ids`` stands for."""
    rows = rows_as_struct(coded, ids=F.col(f"`{ids}`").cast("array<int>"))
    if keep is not None:
        rows = rows.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in keep]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or _tokenizer(vocabulary)
            column = batch.column("ids")
            values, ends = column.values, column.offsets.to_numpy()
            if column.flatten().null_count:
                raise ValueError("an id is null")
            values = values.fill_null(0).to_numpy(zero_copy_only=False)
            found = list(coder.decode([values[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]))
            found = [x if ok else None for x, ok in zip(found, column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.binary())], names=["row", "decoded"])

    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the ids' number and digest and the digest of the text that
    they decode to."""
    coded = encode(docs, keep=["doc_id"]).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        "ids",
    )
    back = decode(coded, keep=["doc_id", "n_tokens", "ids_sha256"])
    return back.select("row.*", F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
