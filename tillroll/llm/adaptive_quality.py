"""Operator 8: quality rules with adaptive thresholds (DataFrame functions only).

Per document, integer counts are taken from the whole text (null: no words).
Fixed rules fail a document outright (``base_failed``).  The remaining verdict
replaces fixed cutoffs: per (language, source) a mergeable quantile sketch of
every feature is built -- a log-linear histogram whose bins keep six leading
bits, so its size is bounded, bins of any two sketches add up, and a quantile is
off by at most 1/32 of its value.  A fence ``Q3 + width * max(Q3 - Q1, spread)``
(and its mirror image for the mean word length) is read from the sketch and
joined back.  Keys with fewer than ``MIN_DOCS`` documents use the merged sketch
of their language, then that of all documents.

Defined cases: null or empty text has zero counts and fails the fixed rules;
null language or source is a key of its own; repeated rows count each; an empty
table gives an empty result; very long texts are processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import rows_as_struct, table, text_of, words_of, written

# Production parameters.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_DOCS = 200  # documents a sketch needs before its fences are used
FENCE_WIDTH = 4  # interquartile ranges beyond the quartile
#: feature -> (least spread used for a fence, has a lower fence too)
FEATURES = {
    "symbol_permille": (25, False),
    "dup_line_permille": (100, False),
    "repeat_permille": (75, False),
    "mean_word_percent": (75, True),
}
SYMBOLS = "#*$%&|<>"

# A window's sort key holds 44 hash bits and its position in 20 bits.
_POS_BITS = 20
_POS_MASK = (1 << _POS_BITS) - 1


def _text_counts(df: DataFrame) -> DataFrame:
    """Adds the counts to a frame with a non-null column ``text``.

    Repeated windows: every window's 44-bit hash and position share one long;
    sorting the longs brings equal hashes together.  All neighbours with equal
    hashes are compared word by word; if any differ (a collision), or the text
    has 2^20 words or more, the windows themselves are sorted instead.
    """
    df = df.withColumn("words", words_of(F.col("text"))).withColumn(
        "lines", F.filter(F.split(F.col("text"), "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    )
    df = df.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"""CASE WHEN size(words) < 3 THEN CAST(array() AS array<bigint>)
                ELSE sort_array(transform(sequence(0, size(words) - 3),
                     i -> (xxhash64(words[i], words[i + 1], words[i + 2]) & {~_POS_MASK}L) | CAST(i AS bigint))) END"""
        ).alias("keys"),
    )
    df = df.withColumn(
        "twins",
        F.expr(
            f"""filter(zip_with(keys, slice(keys, 2, size(keys)),
                  (x, y) -> CASE WHEN shiftright(x, {_POS_BITS}) = shiftright(y, {_POS_BITS})
                            THEN named_struct('a', CAST(x & {_POS_MASK} AS int), 'b', CAST(y & {_POS_MASK} AS int)) END),
                p -> p IS NOT NULL)"""
        ),
    )
    same = "words[p.a] = words[p.b] AND words[p.a + 1] = words[p.b + 1] AND words[p.a + 2] = words[p.b + 2]"
    df = df.withColumn(
        "starts",
        F.expr(
            f"""CASE WHEN size(words) < 3 THEN CAST(array() AS array<int>)
                WHEN size(words) < {_POS_MASK} AND forall(twins, p -> {same})
                THEN array_sort(array_union(transform(twins, p -> p.a), transform(twins, p -> p.b)))
                ELSE array_sort(array_distinct(flatten(transform(
                     array(sort_array(transform(sequence(0, size(words) - 3),
                         i -> named_struct('a', words[i], 'b', words[i + 1], 'c', words[i + 2], 'i', i)))),
                     w -> flatten(zip_with(w, slice(w, 2, size(w)),
                         (x, y) -> CASE WHEN x.a = y.a AND x.b = y.b AND x.c = y.c THEN array(x.i, y.i)
                                   ELSE CAST(array() AS array<int>) END)))))) END"""
        ),
    )
    return df.withColumn(
        "n_repeat_words",
        F.expr(
            """aggregate(zip_with(starts, slice(starts, 2, size(starts)),
                 (s, t) -> least(3, coalesce(t - s, 3))), 0L, (acc, x) -> acc + x)"""
        ),
    ).drop("words", "lines", "keys", "twins", "starts")


def quality_features(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: ``row`` (all input columns), ``lang``, ``source``,
    the counts, the four features and ``base_failed``."""
    base = rows_as_struct(df, lang=F.col(lang_col), source=F.col(source_col), text=text_of(text_col))
    out = _text_counts(base).drop("text")
    n, c, ln = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1)), F.greatest("n_lines", F.lit(1))

    def div(a: Column, b: Column) -> Column:
        return F.floor(a.cast("decimal(20,0)") / b).cast("long")

    return out.select(
        "*",
        div(F.col("n_symbols") * 1000, c).alias("symbol_permille"),
        div(F.col("n_dup_lines") * 1000, ln).alias("dup_line_permille"),
        div(F.col("n_repeat_words") * 1000, n).alias("repeat_permille"),
        div(F.col("word_chars") * 100, n).alias("mean_word_percent"),
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)).alias("base_failed"),
    )


def _bin(v: Column) -> Column:
    """Lower end of the log-linear bin of a non-negative integer (six leading bits kept)."""
    s = F.length(F.bin(v)) - 6
    return F.when(v < 64, v).otherwise(F.call_function("shiftleft", F.call_function("shiftright", v, s), s))


def quality_sketches(features: DataFrame) -> DataFrame:
    """Sketch of each (level, language, source, feature): its bins with counts.
    Level 0 is (language, source), 1 the language, 2 everything; sketches merge
    by adding counts."""
    stacked = features.filter(~F.col("base_failed")).select(
        "lang",
        "source",
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), _bin(F.col(f)).alias("bin")) for f in FEATURES])).alias("x"),
    )
    leaf = stacked.groupBy("lang", "source", "x.feature", "x.bin").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    by_lang = leaf.groupBy("lang", "feature", "bin").agg(F.sum("n").alias("n"))
    total = by_lang.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    return (
        leaf.select(F.lit(0).alias("level"), "lang", "source", "feature", "bin", "n")
        .unionAll(by_lang.select(F.lit(1), "lang", none, "feature", "bin", "n"))
        .unionAll(total.select(F.lit(2), none, none, "feature", "bin", "n"))
    )


def quality_thresholds(features: DataFrame) -> DataFrame:
    """One row per (language, source) that occurs: ``lo_<feature>``, ``hi_<feature>``."""
    sketches = written(quality_sketches(features), "quality-sketch")
    key = W.partitionBy("level", "lang", "source", "feature")
    cum = sketches.select(
        "*",
        F.sum("n").over(key.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(key).alias("total"),
    )
    quart = cum.groupBy("level", "lang", "source", "feature").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"),
    )
    lo, hi = [], []
    for f, (spread, two_sided) in FEATURES.items():
        reach = F.greatest(F.col("q3") - F.col("q1"), F.lit(spread)) * FENCE_WIDTH
        lo.append(F.max(F.when(F.col("feature") == f, (F.col("q1") - reach) if two_sided else F.lit(-1))).alias(f"lo_{f}"))
        hi.append(F.max(F.when(F.col("feature") == f, F.col("q3") + reach)).alias(f"hi_{f}"))
    fences = quart.groupBy("level", "lang", "source").agg(F.max("total").alias("total"), *lo, *hi)
    names = [f"{s}_{f}" for f in FEATURES for s in ("lo", "hi")]
    keys = features.select("lang", "source").distinct()
    own = fences.filter((F.col("level") == 0) & (F.col("total") >= MIN_DOCS)).select(
        F.col("lang").alias("l0"), F.col("source").alias("s0"), F.struct(*names).alias("own")
    )
    lang = fences.filter((F.col("level") == 1) & (F.col("total") >= MIN_DOCS)).select(
        F.col("lang").alias("l1"), F.struct(*names).alias("by_lang")
    )
    every = fences.filter("level = 2").select(F.struct(*names).alias("every"))
    picked = (
        keys.join(own, F.col("lang").eqNullSafe(F.col("l0")) & F.col("source").eqNullSafe(F.col("s0")), "left")
        .join(lang, F.col("lang").eqNullSafe(F.col("l1")), "left")
        .join(every, F.lit(True), "left")  # one row
    )
    return picked.select("lang", "source", F.coalesce("own", "by_lang", "every").alias("f")).select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), "f.*"
    )


def with_verdict(features: DataFrame) -> DataFrame:
    """Joins the fences to the features (already written) and adds ``kept``.
    The fence table is written too: Spark broadcasts it only below its limit."""
    fences = written(quality_thresholds(features), "quality-fences")
    ok = F.lit(True)
    for f in FEATURES:
        ok = ok & F.coalesce(F.col(f).between(F.col(f"lo_{f}"), F.col(f"hi_{f}")), F.lit(True))
    joined = features.join(
        fences, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left"
    )
    return joined.withColumn("kept", ~F.col("base_failed") & ok)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return with_verdict(written(quality_features(docs), "quality-features")).filter("kept").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    feats = quality_features(docs)
    feats = written(feats.withColumn("row", F.struct(F.col("row.doc_id").alias("doc_id"))), "quality-features")
    return with_verdict(feats).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql() -> str:
    feats = ", ".join(f"{{'feature': '{f}', 'v': {f}}}" for f in FEATURES)
    spread = " ".join(f"WHEN '{f}' THEN {s}" for f, (s, _) in FEATURES.items())
    two = " OR ".join(f"feature = '{f}'" for f, (_, t) in FEATURES.items() if t)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d),
pos AS (SELECT r, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c, i FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM pos) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
ln AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g')) > 0) AS ls FROM d),
base AS (SELECT d.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (r) JOIN ln USING (r) LEFT JOIN cov USING (r)),
f AS (SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbol_permille,
    1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_permille,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeat_permille,
    100 * word_chars // greatest(n_words, 1) AS mean_word_percent,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM base),
long AS (SELECT lang, source, unnest([{feats}], recursive := true) FROM f WHERE NOT base_failed),
bins AS (SELECT lang, source, feature, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b, count(*) AS n
  FROM long GROUP BY ALL),
sk AS (SELECT 0 AS level, * FROM bins
  UNION ALL SELECT 1, lang, NULL, feature, b, sum(n) FROM bins GROUP BY lang, feature, b
  UNION ALL SELECT 2, NULL, NULL, feature, b, sum(n) FROM bins GROUP BY feature, b),
cum AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, feature ORDER BY b) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, feature) AS total FROM sk),
q AS (SELECT level, lang, source, feature, max(total) AS total, min(b) FILTER (4 * upto >= total) AS q1,
    min(b) FILTER (4 * upto >= 3 * total) AS q3 FROM cum GROUP BY ALL),
fence AS (SELECT *, CASE WHEN {two} THEN q1 - {FENCE_WIDTH} * greatest(q3 - q1, CASE feature {spread} END) ELSE -1 END AS lo,
    q3 + {FENCE_WIDTH} * greatest(q3 - q1, CASE feature {spread} END) AS hi FROM q WHERE total >= {MIN_DOCS} OR level = 2),
keys AS (SELECT DISTINCT lang, source FROM f),
pick AS (SELECT keys.lang, keys.source, fence.feature, arg_min(lo, level) AS lo, arg_min(hi, level) AS hi
  FROM keys JOIN fence ON level = 2 OR (level = 1 AND keys.lang IS NOT DISTINCT FROM fence.lang)
    OR (level = 0 AND keys.lang IS NOT DISTINCT FROM fence.lang AND keys.source IS NOT DISTINCT FROM fence.source)
  GROUP BY ALL),
wide AS (SELECT lang, source, map_from_entries(list({{'k': feature, 'v': [lo, hi]}})) AS m FROM pick GROUP BY ALL)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed{"".join(f" AND coalesce({f} BETWEEN m['{f}'][1] AND m['{f}'][2], true)" for f in FEATURES)} AS kept
FROM f LEFT JOIN wide ON f.lang IS NOT DISTINCT FROM wide.lang AND f.source IS NOT DISTINCT FROM wide.source
"""


SQL = _sql()
