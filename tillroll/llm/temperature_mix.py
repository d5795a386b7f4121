"""Operator 4: temperature mixing of sources.

Source ``i`` holds the share ``p_i`` of all tokens.  Its weight is ``p_i ** a``,
normalised.  The exponent ``a`` in [0, 1] is bisected over the table of source
shares (an aggregate per step; nothing but a few sums reaches the driver):

* ``a_entropy`` is the largest exponent whose weights reach ``TARGET_ENTROPY``
  of the greatest possible entropy,
* ``a_repeat`` is the smallest exponent at which no source has to be repeated
  more than ``MAX_REPEATS`` times,

and the larger of the two is taken: the mix is flattened as far as the target
asks, never beyond the repetition limit.  The token budget is the smallest that
gives every source at least one epoch, so no document is lost: source ``i`` is
repeated ``(p_i ** a / p_i) / min_j(p_j ** a / p_j)`` times.

Realisation: each epoch of a source is a fresh hash permutation; whole epochs
take every document, the last takes documents until the budget is used.  A
source's stream is laid evenly over all blocks (about ``BLOCK_TOKENS`` tokens),
so every block has its share of every source; inside a block the order is a
permutation.  Stream positions are prefix sums in two levels (square root of
the source's size many buckets), so a hot source is spread over many tasks.

Defined cases: tokens are words between ASCII blanks, at least one per document;
a null source is a source; rows equal in id and source (null ids included) move
together; null texts count one token; one source gets weight 1; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import rows_as_struct, table, text_of, written

# Production parameters.
TARGET_ENTROPY = 0.9
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
SEED = 20240607
_HALVINGS = 5  # halvings of the bracket per pass over the shares
_PASSES = 5


def n_words(text: Column) -> Column:
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def source_shares(units: DataFrame) -> DataFrame:
    """``source, tokens, docs, p``."""
    own = units.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = own.agg(F.sum("tokens").alias("total"))
    return own.crossJoin(total).select("source", "tokens", "docs", (F.col("tokens") / F.col("total")).alias("p"))


def _measures(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """exponent -> (entropy as a part of the greatest, most repeats)."""
    grid = F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a")
    w = F.pow("p", "a")
    rows = (
        shares.select("p", grid)
        .groupBy("a")
        .agg(
            F.sum(w).alias("z"),
            F.sum(w * F.log(w)).alias("s"),
            F.count(F.lit(1)).alias("n"),
            F.min("p").alias("least"),
            F.max("p").alias("most"),
        )
        .collect()
    )
    out = {}
    for r in rows:
        entropy = (math.log(r["z"]) - r["s"] / r["z"]) / math.log(r["n"]) if r["n"] > 1 else 1.0
        out[r["a"]] = (entropy, (r["most"] / r["least"]) ** (1 - r["a"]))
    return out


def _bisect(shares: DataFrame, good, low: float, high: float) -> float:
    """Smallest exponent in [low, high] from which ``good`` holds (high if none);
    each pass halves the bracket ``_HALVINGS`` times at once."""
    steps = 1 << _HALVINGS
    for _ in range(_PASSES):
        points = [low + (high - low) * k / steps for k in range(steps + 1)]
        held = _measures(shares, points)
        first = next((k for k, a in enumerate(points) if a in held and good(*held[a])), steps)
        low, high = points[max(0, first - 1)], points[first]
        if first == 0:
            break
    return high


def exponent(shares: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """The exponent of the mix.  Entropy falls and repeats fall as it grows."""
    a_repeat = _bisect(shares, lambda h, r: r <= max_repeats + 1e-12, 0.0, 1.0)
    # The first exponent whose entropy is below the target bounds those that reach it.
    a_entropy = _bisect(shares, lambda h, r: h < target_entropy - 1e-12, 0.0, 1.0)
    return round(max(a_repeat, a_entropy), 9)


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    tokens: Column | None = None,
    text: str = "text",
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """One row per copy of a document: ``doc_id, source, epoch, n_tokens,
    block_id, position`` (position counts the copies of a block from 0)."""
    count = tokens if tokens is not None else n_words(text_of(text))
    units = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), count.alias("n"))
    units = written(units.groupBy("doc_id", "source").agg(F.sum("n").alias("n_tokens")), "mix-units")
    shares = written(source_shares(units), "mix-shares")
    a = exponent(shares, target_entropy, max_repeats)
    ratio = F.pow("p", F.lit(a - 1))
    least = shares.agg(F.min(ratio).alias("least"))
    plan = shares.crossJoin(least).select(
        F.col("source").alias("s"), "tokens", "docs", (ratio / F.col("least") * F.col("tokens")).alias("budget")
    )
    blocks = plan.agg(F.greatest(F.ceil(F.sum("budget") / block_tokens), F.lit(1)).alias("blocks"))
    plan = written(plan.crossJoin(blocks), "mix-plan")

    epochs = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("budget") / F.col("tokens") - 1e-9) - 1, F.lit(0)).cast("int"))
    copies = units.join(plan, F.col("source").eqNullSafe(F.col("s"))).select("*", F.explode(epochs).alias("epoch"))
    order = F.xxhash64(F.lit(seed), "doc_id", "source", "epoch")
    slots = F.ceil(F.sqrt("docs"))
    copies = copies.withColumn("h", order).withColumn("bucket", F.pmod(F.shiftright("h", 20), slots).cast("long"))
    copies = written(copies.drop("s"), "mix-copies")
    stream = ["source", "epoch"]
    sums = copies.groupBy(*stream, "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = F.sum("in_bucket").over(W.partitionBy(*stream).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select(
        F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("bucket").alias("b"), F.coalesce(before, F.lit(0)).alias("before")
    )
    inner = F.sum("n_tokens").over(W.partitionBy(*stream, "bucket").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1))
    placed = copies.withColumn("inner", F.coalesce(inner, F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("bucket") == F.col("b"))
    )
    start = F.col("epoch") * F.col("tokens") + F.col("before") + F.col("inner")
    placed = placed.withColumn("start", start).filter((F.col("epoch") == 0) | (F.col("start") < F.col("budget") - 1e-6))
    block = F.least(F.floor(F.col("start") / F.col("budget") * F.col("blocks")), F.col("blocks") - 1).cast("long")
    placed = placed.withColumn("block_id", block).withColumn("h2", F.xxhash64(F.lit(seed + 1), "h", "block_id"))
    turn = F.row_number().over(W.partitionBy("block_id").orderBy("h2", "doc_id", "source", "epoch")) - 1
    return placed.select("doc_id", "source", "epoch", "n_tokens", "block_id", turn.cast("long").alias("position"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The documents of the mix with all their columns, blocks whole and in
    order within a partition; blocks are alike, so their order is free."""
    plan = mix_plan(docs, doc_id, source, **options).select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), "block_id", "position"
    )
    rows = rows_as_struct(docs, k=F.col(doc_id), g=F.col(source))
    mixed = rows.join(plan, F.col("k").eqNullSafe(F.col("d")) & F.col("g").eqNullSafe(F.col("s")))
    return mixed.repartition("block_id").sortWithinPartitions("block_id", "position").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))
