"""Distributed order operators.

A plain ``row_number() over (order by ...)`` sends every row to one task, and a
window over a group that holds a third of all rows does the same.  Here:

* ``row_number_global`` range-sorts the rows into the session's shuffle
  partitions, writes them once with their partition and position (which fixes
  both), and adds to each partition the rows before it: a prefix sum over one row
  per partition.
* ``totals_before`` does the same with a sum instead of a count, for groups whose rows
  are numbered where they are; ``number_kept`` numbers the rows that a filter leaves by
  a bit for each, so the rows themselves are not exchanged; ``dense_lookup`` finds dense
  keys in the order of an integral id by the same kind of table.
* ``ntile_by_cuts`` is NTILE(n) without any sort: the rows at which a tile ends are
  found as order statistics, by counting rows per bucket of a value's range and
  counting again inside the buckets that hold them; a row's tile follows from
  comparing it with those few cut points.
* ``rank_within_groups`` cuts every group into ranges of a unique ordering
  column; a range is numbered by its own window and adds the rows of the earlier
  ranges of its group, joined by shuffle.
* ``rank_repeated`` does the same where most groups are single rows: hashes are
  counted first, the repeated ones set bits of a filter of bounded size, and only
  rows whose bit is set are shuffled and compared; all others are first and alone.

Every input, of any size, takes the same path.  Nothing but row counts and cut
points reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a range of values that one job counts.
CUT_BUCKETS = 65_536
#: Bits of the filter of repeated hashes: 16 for each, this many (64 MB) at most.
FILTER_BITS_EACH, FILTER_BITS = 16, 1 << 29
_FILTER_ROW = 1 << 15  # bits of one of its rows

_BLOCK_SHIFT = 10  # ids of a block of ``number_kept`` and ``dense_lookup``, as a power of two

#: Rows of one group that one task numbers at most (a range of the order column).
GROUP_RANGE_ROWS = 4_000_000


def row_number_global(df: DataFrame, order_cols: list[str], out: str, *, work: str | None = None) -> tuple[DataFrame, int]:
    """``row_number() over (order by order_cols asc)`` as a long, 1-based, and the
    row count.  The order columns should be (nearly) unique: rows that tie are
    numbered in an unspecified order and sorted by one task.

    ``df`` is evaluated twice (once for the range bounds); hand in a frame that
    has been written if that is dear.  ``work`` is the folder of the written rows.
    """
    from tillroll.plans.session import materialize, run_root

    placed = (
        df.repartitionByRange(*[F.col(c).asc() for c in order_cols])
        .sortWithinPartitions(*order_cols)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    fixed = materialize(placed, work or run_root(df.sparkSession, "ranked"))
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per shuffle partition: that is the bound of this broadcast.
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    # monotonically_increasing_id = (partition << 33) + position in the partition
    local = F.col("_pos").bitwiseAND((1 << 33) - 1) + 1
    numbered = fixed.join(offsets, "_part").withColumn(out, F.col("_before") + local).drop("_part", "_pos", "_before")
    return numbered, fixed.count()


def _running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to the rows of one partition, in their order, the sum of ``_n`` before them."""
    total = 0
    for batch in batches:
        n = batch.column("_n").to_numpy()
        before = np.cumsum(n) - n + total
        total += int(n.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], names=[*batch.schema.names, "_local"])


def totals_before(df: DataFrame, key: str, n: str, out: str, *, work: str | None = None) -> DataFrame:
    """``key`` (unique, integral; null comes first) and the sum of ``n`` over all smaller
    keys.  The rows are written once, below ``work``."""
    from tillroll.plans.session import materialize, run_root

    placed = df.select(key, F.col(n).cast("long").alias("_n")).repartitionByRange(key).sortWithinPartitions(key)
    placed = placed.withColumn("_part", F.spark_partition_id())
    kind = df.schema[key].dataType.simpleString()
    fixed = materialize(placed.mapInArrow(_running, f"`{key}` {kind}, _n long, _part int, _local long"), work or run_root(df.sparkSession, "totals"))
    sizes = fixed.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per shuffle partition: that is the bound of this broadcast.
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_earlier")))
    return fixed.join(offsets, "_part").select(key, (F.col("_earlier") + F.col("_local")).alias(out))


def _places(id_col: str | Column) -> tuple[Column, Column, Column]:
    """Block of an integral id, and its word and bit in that."""
    at = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("long")
    word = F.shiftright(at.bitwiseAND(F.lit((1 << _BLOCK_SHIFT) - 1)), 6).cast("int")
    return F.shiftright(at, _BLOCK_SHIFT), word, at.bitwiseAND(F.lit(63)).cast("int")


def _blocks(rows: DataFrame, id_col: str, **extra: Column) -> DataFrame:
    """``_block``, its ``_words`` with a bit per id, ``_n`` bits, and aggregates of words' ``extra`` aggregates."""
    block, word, bit = _places(id_col)
    words = rows.groupBy(block.alias("_block"), word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_mask"), *[c.alias(n) for n, c in extra.items()]
    )
    told = F.map_from_entries(F.collect_list(F.struct("_word", "_mask")))
    every = F.sequence(F.lit(0), F.lit((1 << _BLOCK_SHIFT - 6) - 1))
    masks = F.transform(every, lambda k: F.coalesce(F.try_element_at("_told", k), F.lit(0).cast("long")))
    more = {"_low": F.min, "_high": F.max}
    blocks = words.groupBy("_block").agg(told.alias("_told"), F.sum(F.bit_count("_mask")).alias("_n"), *[more[n](n).alias(n) for n in extra])
    return blocks.select("_block", "_n", masks.alias("_words"), *extra)


def _up_to(id_col: str | Column) -> Column:
    """The bits of the block's words before the id's own and at it."""
    _, word, bit = _places(id_col)
    before = F.aggregate(F.slice("_words", F.lit(1), word), F.lit(0).cast("long"), lambda n, x: n + F.bit_count(x))
    own = F.element_at("_words", word + 1).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-2).cast("long"), bit)))
    return before + F.bit_count(own)


def number_kept(df: DataFrame, kept: Column, id_col: str, out: str, *, work: str | None = None) -> DataFrame:
    """The rows with ``kept``, numbered from 1 by the unique integral ``id_col``.  Only a
    bit per row is exchanged: a row's number is the bits of the blocks before its own,
    and those up to its own.  ``df`` is read twice, so hand in a frame that has been
    written.  The table of blocks, some 3 bits a row, is joined as Spark chooses by its size."""
    from tillroll.plans.session import materialize, run_root

    work = work or run_root(df.sparkSession, "kept")
    rows = df.filter(kept)
    blocks = materialize(_blocks(rows, id_col), f"{work}/words")
    blocks = blocks.join(totals_before(blocks, "_block", "_n", "_before", work=f"{work}/blocks"), "_block").select("_block", "_words", "_before")
    blocks = materialize(blocks, f"{work}/numbered")
    numbered = rows.withColumn("_block", _places(id_col)[0]).join(blocks, "_block")
    return numbered.withColumn(out, F.col("_before") + _up_to(id_col)).drop("_block", "_words", "_before")


def dense_lookup(df: DataFrame, table: DataFrame, id_col: str, table_id: str, key: str, row_id: str, *, work: str | None = None) -> DataFrame:
    """LEFT JOIN of ``table`` on its integral ``table_id``, whose ``key`` is dense in the
    order of that id (an error if it is not): a bit per id and the key before each block of
    ids tell the key, so ``table`` is joined as a few bits a row.  Spark chooses by the
    written size of the blocks whether they are broadcast; in a shuffle join rows without
    an id carry the unique ``row_id`` and meet nothing."""
    from tillroll.plans.session import materialize, run_root

    blocks = _blocks(table.select(F.col(table_id), F.col(key)), table_id, _low=F.min(key), _high=F.max(key))
    gap = F.raise_error(F.lit(f"{key} is not dense by {table_id}")).cast("long")
    before = F.when(F.col("_high") - F.col("_low") + 1 == F.col("_n"), F.col("_low") - 1).otherwise(gap)
    blocks = materialize(blocks.select("_block", F.lit(0).cast("long").alias("_own"), "_words", before.alias("_before")), work or run_root(df.sparkSession, "dense"))
    block, word, bit = _places(id_col)
    left = df.withColumns({"_block": block, "_own": F.when(F.col(id_col).isNull(), F.col(row_id)).otherwise(F.lit(0)).cast("long")})
    joined = left.join(blocks, ["_block", "_own"], "left")
    held = F.bit_get(F.element_at("_words", word + 1), bit) == 1
    return joined.withColumn(key, F.when(held, F.col("_before") + _up_to(id_col))).drop("_block", "_own", "_words", "_before")


def value_blocks(table: DataFrame, key: str, value: str) -> DataFrame:
    """For ``dense_values``: the integral values of a block of keys from 0 on as their
    distances from the least one, which take few bytes where values follow the keys."""
    at = F.col(key).cast("long")
    pairs = F.sort_array(F.collect_list(F.struct(at.bitwiseAND(F.lit((1 << _BLOCK_SHIFT) - 1)).cast("int").alias("_at"), F.col(value).cast("long").alias("_v"))))
    blocks = table.groupBy(F.shiftright(at, _BLOCK_SHIFT).alias("_block")).agg(pairs.alias("_pairs"), F.min(F.col(value).cast("long")).alias("_least"))
    told = F.map_from_entries("_pairs")
    every = F.sequence(F.lit(0), F.lit((1 << _BLOCK_SHIFT) - 1))
    return blocks.withColumn("_told", told).select("_block", "_least", F.transform(every, lambda k: F.try_element_at("_told", k) - F.col("_least")).alias("_more"))


def dense_values(df: DataFrame, blocks: DataFrame, key: str, value: str, kind: str) -> DataFrame:
    """The value of each row's key (null if it has none) by written ``value_blocks``, which
    Spark broadcasts if their files are small."""
    at = F.col(key).cast("long")
    joined = df.withColumn("_block", F.shiftright(at, _BLOCK_SHIFT)).join(blocks, "_block", "left")
    own = F.element_at("_more", at.bitwiseAND(F.lit((1 << _BLOCK_SHIFT) - 1)).cast("int") + 1)
    return joined.withColumn(value, (F.col("_least") + own).cast(kind)).drop("_block", "_least", "_more")


def _ends(df: DataFrame, names: list[str]) -> dict[str, int]:
    """Row count, and the least and largest value of each column."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *ends).first().asDict()


def order_cuts(
    df: DataFrame, columns: list[str], tie: str, ranks: list[int], ends: dict[str, int] | None = None
) -> dict[str, list[tuple[int, int]]]:
    """For each column the rows at the given 1-based ranks of the order by (column,
    ``tie``), as (value, tie).  Columns are integral and not null.

    All searches advance together.  A search has a range of values and its rank in it;
    a job counts the rows per bucket of every range (``CUT_BUCKETS`` at most, partly
    aggregated before the shuffle) and keeps the bucket that holds the rank, until it
    is one value.  The same is then done on ``tie`` among the rows with that value.
    """
    ends = ends or _ends(df, [*columns, tie])
    # (column, rank) -> value or None while it is searched, low, high, rank within
    found = {(c, r): (None, ends[f"min_{c}"], ends[f"max_{c}"], r) for c in columns for r in ranks}
    while True:
        for (c, r), (value, low, high, left) in found.items():
            if value is None and low == high:
                found[c, r] = (low, ends[f"min_{tie}"], ends[f"max_{tie}"], left)
        spans = sorted({(c, -1 if v is None else 1, v or 0, low, high) for (c, _), (v, low, high, _) in found.items() if low < high})
        if not spans:
            return {c: [(found[c, r][0], found[c, r][1]) for r in ranks] for c in columns}
        entries, widths = [], {}
        for k, (c, phase, value, low, high) in enumerate(spans):
            x = F.col(c if phase < 0 else tie).cast("long")
            widths[k] = width = (high - low) // CUT_BUCKETS + 1
            inside = x.between(low, high) if phase < 0 else x.between(low, high) & (F.col(c) == value)
            bucket = F.call_function("div", x - F.lit(low), F.lit(width)).cast("long")
            entries.append(F.when(inside, F.struct(F.lit(k).alias("span"), bucket.alias("bucket"))))
        counts = df.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("span", "bucket").agg(F.count(F.lit(1)).alias("n"))
        # one row per bucket, CUT_BUCKETS a span at most
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("span").orderBy("bucket")))
        open_ = {key: spans.index((key[0], -1 if f[0] is None else 1, f[0] or 0, f[1], f[2])) for key, f in found.items() if f[1] < f[2]}
        holds = [(F.col("span") == k) & (F.col("upto") >= found[key][3]) & (F.col("upto") - F.col("n") < found[key][3]) for key, k in open_.items()]
        rows = upto.filter(reduce(lambda a, b: a | b, holds)).collect()
        for key, k in open_.items():
            value, low, high, left = found[key]
            hit = next(r for r in rows if r["span"] == k and r["upto"] - r["n"] < left <= r["upto"])
            start = low + hit["bucket"] * widths[k]
            found[key] = (value, start, min(high, start + widths[k] - 1), left - (hit["upto"] - hit["n"]))


def ntile_by_cuts(df: DataFrame, tiles: int, outs: dict[str, str], tie: str) -> DataFrame:
    """NTILE(tiles) over (order by column, tie) for each ``out: column``: the first
    ``n % tiles`` tiles hold one row more.  ``df`` is read several times, so hand in
    a frame that has been written; ``tie`` is unique."""
    ends = _ends(df, [*outs.values(), tie])
    if (n := ends["rows"]) == 0:
        return df.withColumns({out: F.lit(1) for out in outs})
    q, more = divmod(n, tiles)
    ranks = sorted({k * q + min(k, more) for k in range(1, tiles)})
    cuts = order_cuts(df, list(outs.values()), tie, ranks, ends)
    columns = {}
    for out, c in outs.items():
        at = dict(zip(ranks, cuts[c], strict=True))
        ends = [at[k * q + min(k, more)] for k in range(1, tiles)]
        beyond = [(F.col(c) > v) | ((F.col(c) == v) & (F.col(tie) > t)) for v, t in ends]
        columns[out] = reduce(lambda a, b: a + b, [x.cast("int") for x in beyond], F.lit(1))
    return df.withColumns(columns)


def _group_hash(group_cols: list[str], seed: int) -> Column:
    """64 bits of the group's values; NULL differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in group_cols]
    return F.xxhash64(F.lit(seed), *parts)


def rank_within_groups(
    df: DataFrame, group_cols: list[str], order_col: str, rank_out: str, size_out: str, *, range_rows: int = GROUP_RANGE_ROWS
) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_col)`` and
    ``count(*) over (partition by group_cols)``; NULLs group together.

    ``order_col`` must be a unique, non-null integral column.  Rows are shuffled
    once, by 128 bits of the group and the range of ``order_col``, so a task gets
    at most ``range_rows`` rows of a group.  The rows of the other ranges come from
    a narrow count per (group, range), kept for groups of several ranges only and
    joined on the same keys; the window then needs no further shuffle.
    """
    keys = ["_h1", "_h2", "_range"]
    tagged = df.withColumns(
        {
            "_h1": _group_hash(group_cols, 1),
            "_h2": _group_hash(group_cols, 2),
            "_range": F.call_function("div", F.col(order_col), F.lit(range_rows)).cast("long"),
        }
    )
    counts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per range of a group, so this window is small.
    group = Window.partitionBy("_h1", "_h2")
    before = F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    carry = counts.select(
        *keys, "_n", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_total")
    ).filter("_total > _n")
    joined = tagged.join(carry.drop("_n").hint("merge"), keys, "left")
    window = Window.partitionBy(*keys, *group_cols)
    rank = F.row_number().over(window.orderBy(order_col)) + F.coalesce("_before", F.lit(0))
    size = F.coalesce(F.col("_total"), F.count(F.lit(1)).over(window))
    return joined.withColumns({rank_out: rank.cast("long"), size_out: size.cast("long")}).drop(*keys, "_before", "_total")


def _repeat_filter(repeated: DataFrame, bits: int) -> DataFrame:
    """A bit per hash: rows of ``bucket`` and its ``words``, 64 bits each."""
    at = F.pmod(F.col("_h1"), F.lit(bits))
    place = F.pmod(at, F.lit(_FILTER_ROW))
    word = F.call_function("div", place, F.lit(64)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    bucket = F.call_function("div", at, F.lit(_FILTER_ROW)).cast("int")
    words = repeated.groupBy(bucket.alias("bucket"), word.alias("word")).agg(F.bit_or(mask).alias("mask"))
    told = F.map_from_entries(F.collect_list(F.struct("word", "mask")))
    every = F.sequence(F.lit(0), F.lit(_FILTER_ROW // 64 - 1))
    return words.groupBy(F.col("bucket").alias("_bucket")).agg(told.alias("told")).select(
        "_bucket", F.transform(every, lambda k: F.coalesce(F.try_element_at("told", k), F.lit(0).cast("long"))).alias("_words")
    )


def rank_repeated(
    df: DataFrame, group_cols: list[str], order_col: str, rank_out: str, size_out: str, *, work: str | None = None, range_rows: int = GROUP_RANGE_ROWS
) -> DataFrame:
    """The same columns as ``rank_within_groups`` for a frame in which most groups
    are single rows; ``df`` is read three times, so hand in a frame that has been written.

    64-bit hashes are counted (narrow rows, combined before their shuffle) and those
    met twice are written below ``work``.  Each sets a bit of a filter
    that is broadcast: at most ``FILTER_BITS``, whatever the table.  Rows whose bit is
    unset are first and alone and are not exchanged.  The rest, a few rows by chance
    among them, are ranked by ``rank_within_groups``, which compares the values.
    """
    from tillroll.plans.session import materialize, run_root

    work = work or run_root(df.sparkSession, "repeated")
    own = _group_hash(group_cols, 1)
    counts = df.select(own.alias("_h1")).groupBy("_h1").agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counts.filter("_n > 1").select("_h1"), f"{work}/hashes")
    bits = min(FILTER_BITS, max(_FILTER_ROW, 1 << (FILTER_BITS_EACH * repeated.count()).bit_length()))
    bloom = materialize(_repeat_filter(repeated, bits), f"{work}/filter")

    at = F.pmod(own, F.lit(bits))
    placed = df.withColumns({"_at": F.pmod(at, F.lit(_FILTER_ROW)).cast("int"), "_bucket": F.call_function("div", at, F.lit(_FILTER_ROW)).cast("int")})
    word = F.element_at("_words", F.call_function("div", F.col("_at"), F.lit(64)).cast("int") + 1)
    # bits / 8 bytes: FILTER_BITS is the bound of this broadcast
    marked = placed.join(F.broadcast(bloom), "_bucket", "left")
    marked = marked.withColumn("_maybe", F.coalesce(F.bit_get(word, F.pmod(F.col("_at"), F.lit(64)).cast("int")) == 1, F.lit(False)))
    marked = marked.drop("_at", "_bucket", "_words")
    one = F.lit(1).cast("long")
    alone = marked.filter(~F.col("_maybe")).drop("_maybe").withColumns({rank_out: one, size_out: one})
    met = marked.filter("_maybe").drop("_maybe")
    return alone.unionByName(rank_within_groups(met, group_cols, order_col, rank_out, size_out, range_rows=range_rows))
