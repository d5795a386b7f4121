"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.session import shared_dir

# Fixed value: white space of the word contracts (space, \t \n \v \f \r).
WORD_GAP = r"[\x20\x09-\x0D]+"


# Rows of an Arrow batch: ten thousand long texts would be hundreds of megabytes
# beside the heap.  Set only where the session leaves it unset.
BATCH_ROWS = 2048
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` below the folder of ``spark.checkpoint.dir``
    and read it back.  Its size is then known to the planner, so a join against
    it is broadcast only if the files are below the session's limit."""
    small_batches(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written: it
    does so once the driver has collected the objects that stand for them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(col: Column | str) -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text (maximal runs without ASCII white space)."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def rows_as_struct(df: DataFrame, **derived: Column) -> DataFrame:
    """All columns of ``df`` packed into ``row`` beside the derived ones, so no
    input column can clash with a helper column; undo with ``select("row.*")``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in derived.items()])


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup a partition sorted by ``key`` into tables that never cut a run of
    equal keys.  Holds one Arrow batch and the current run."""
    tail: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if tail is not None:
            table = pa.concat_tables([tail, table])
        keys = table.column(key)
        cut = pc.index(pc.equal(keys, keys[len(keys) - 1]), True).as_py()
        if cut > 0:
            yield table.slice(0, cut)
        tail = table.slice(cut)
    if tail is not None:
        yield tail


def run_bounds(keys) -> list[tuple[int, int]]:
    """(start, end) of each run of equal values of a sorted numpy array."""
    import numpy as np

    if len(keys) == 0:
        return []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True))


def _stars(edges: DataFrame) -> bool:
    """Whether no node of the edges ``u > v`` has two smaller ones, or one on each side."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not nodes.agg(F.bool_or((F.col("down") > 1) | (F.col("down") + F.col("up") > 1))).first()[0]


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the undirected edges ``(u, v)`` (any orderable
    type): ``(node, root)`` for every node of an edge, root the smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until all
    edges lead from a leaf to its root: each is a group minimum and a join; every
    second result is written to the shared folder.  The number of steps grows with the logarithm of the component size.  A hub is only a
    skewed join key, which adaptive execution splits.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = written(e, f"{label}-edges")
    while True:
        if _stars(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                e.select("v", "v").distinct()
            )
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = written(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), f"{label}-small")
