"""CSV text layer: render typed rows as text (A2), scan header CSV into text
columns (A1) and attach ingestion lineage (A3)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas as S
from tillroll.plans.session import materialize, run_root

# Spark's CSV defaults escape quotes with a backslash and drop malformed rows
# silently; these read ``""``-quoted fields correctly and fail on a short row.
READ_OPTIONS = {
    "header": "true",
    "escape": '"',
    "mode": "FAILFAST",
    "encoding": "UTF-8",
}
# The writer trims values by default; keep them as they are.
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

TEXT_LAYER_SOURCES = {
    "invoice_no": "invoice_no",
    "stock_code": "source_stock_code",
    "description": "description",
    "quantity": "quantity",
    "invoice_date": "invoice_date",
    "unit_price": "unit_price",
    "customer_id": "customer_id",
    "country": "country",
}


def as_text(df: DataFrame, name: str):
    """NULL -> empty; timestamps as ``yyyy-MM-dd HH:mm:ss``; dates ISO; else the value as text."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(dtype, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def render_text_layer(typed: DataFrame, sources: dict[str, str] = TEXT_LAYER_SOURCES) -> DataFrame:
    """A2: typed columns -> the eight text columns (projection only)."""
    return typed.select(*[as_text(typed, src).alias(dst) for dst, src in sources.items()])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType = S.RAW_TEXT_SCHEMA, *, multi_line: bool = False
) -> DataFrame:
    """A1: header CSV read by position into text columns, files split over tasks.
    ``multi_line`` reads fields that hold line ends (see ``scan_quoted``)."""
    if multi_line:
        return scan_quoted(spark, path, run_root(spark, "csv"), schema).select(*schema.fieldNames())
    return spark.read.schema(schema).options(**READ_OPTIONS).csv(path)


#: A byte range as a task reads it.
_RANGE = ("_file", "_split", "_length")


class _Reading:
    """A byte range read so far, if it starts ``inside`` quotes or not: the lines of the
    record that is open, and whether that began here (``own``)."""

    def __init__(self, inside: bool, kind: pa.DataType):
        self.open, self.own, self.held = int(inside), not inside, pa.array([], kind)

    def feed(self, lines: pa.Array, odd: np.ndarray) -> tuple[pa.Array | None, pa.ListArray | None]:
        """The next lines, with odd numbers of quotes or not.  Returns the lines that end
        the record of an earlier range, and the lines of the records that end here."""
        open_after = (self.open + np.cumsum(odd)) & 1
        stops = (np.flatnonzero(open_after == 0) + 1 + len(self.held)).tolist()
        every = pa.concat_arrays([self.held, lines]) if len(self.held) else lines
        self.open, first, tail = int(open_after[-1]), 0, None
        if stops and not self.own:
            first, self.own = stops[0], True
            tail, stops = every.slice(0, first), stops[1:]
        self.held = every.slice(stops[-1] if stops else first)
        return tail, pa.ListArray.from_arrays(pa.array([first, *stops], pa.int32()), every) if stops else None


def _joined(lines: pa.Array) -> str:
    return "\n".join(lines.to_pylist())


def _segments(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch, np.ndarray]]:
    """The parts of batches that lie in one byte range, with which lines have an odd
    number of quotes."""
    for batch in batches:
        odd = pc.bit_wise_and(pc.count_substring(batch.column("line"), '"'), 1).to_numpy().astype(np.int64)
        starts = np.zeros(batch.num_rows, bool)
        starts[:1] = True
        for k in keys:
            column = batch.column(k)
            starts[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        at = [*np.flatnonzero(starts).tolist(), batch.num_rows]
        for a, z in zip(at[:-1], at[1:], strict=True):
            yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, z - a), odd[a:z]


_ENDS = "odd boolean, tail string, ended0 boolean, open0 string, open1 string"


def _range_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per byte range: the parity of its quotes, and the texts at its ends that
    belong to records of several ranges -- ``tail`` and ``open1`` if it starts inside
    quotes, ``open0`` if it does not (``ended0``: a record ends in it then)."""
    kind = pa.string()
    place, readings, tail, ended, odds = None, [], None, False, 0

    def told() -> pa.RecordBatch:
        held = [_joined(r.held) if r.open else None for r in readings]
        values = [*place, odds & 1 == 1, tail, ended, *held]
        types = [kind, pa.int64(), pa.int64(), pa.bool_(), kind, pa.bool_(), kind, kind]
        names = [*_RANGE, "odd", "tail", "ended0", "open0", "open1"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    for here, part, odd in _segments(batches, _RANGE):
        lines = part.column("line")
        if here != place:
            if place is not None:
                yield told()
            place, tail, ended, odds = here, None, False, 0
            readings = [_Reading(inside, lines.type) for inside in (False, True)]
        ended |= readings[0].feed(lines, odd)[1] is not None
        last, _ = readings[1].feed(lines, odd)
        tail = tail if last is None else _joined(last)
        odds += int(odd.sum())
    if place is not None:
        yield told()


def _whole_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in one byte range, blank ones and headers left out,
    with their place among them."""
    place, reading, n, header = None, None, 0, False
    for here, part, odd in _segments(batches, ("_range",)):
        lines = part.column("line")
        if here != place:
            place, n, header = here, 0, part.column("leads")[0].as_py()
            reading = _Reading(part.column("inside")[0].as_py(), lines.type)
        _, records = reading.feed(lines, odd)
        if records is None:
            continue
        texts = pc.binary_join(records, pa.scalar("\n", lines.type))
        if header:
            texts, header = texts[1:], False
        bare = pc.utf8_trim(pc.replace_substring_regex(texts, r"\r\z", ""), " ")
        texts = texts.filter(pc.not_equal(bare, ""))
        pos = np.arange(n, n + len(texts))
        n += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(texts), here[0]), pa.int32()), pa.array(pos, pa.int64()), texts.cast(pa.string())], names=["_range", "_pos", "record"]
        )


def quoted_lines(spark: SparkSession, path: str, work: str) -> tuple[DataFrame, DataFrame]:
    """The lines of CSV files, and their byte ranges, written below ``work``.

    Lines are read by Spark's splittable text source.  A range alone cannot know
    whether it starts inside a quoted field, so a first reading takes the parity of the
    quotes of each range and the texts at its ends for both cases, one row a range; the
    parities are then combined from the start of the file (``inside``: the range starts
    within quotes).  ``head`` is the text of the record that is open where the range
    ends and began in it, ``more`` the text that continues one of an earlier range.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.col("_metadata.file_block_length").alias("_length"),
        F.col("value").alias("line"),
    )
    read = materialize(lines.mapInArrow(_range_ends, f"_file string, _split long, _length long, {_ENDS}"), f"{work}/ends")
    # Windows over one row per byte range.
    before = Window.partitionBy("_file").orderBy("_split")
    quotes = F.sum(F.col("odd").cast("long")).over(before)
    ranges = read.select(
        *_RANGE, "tail", "ended0", "open0", "open1",
        F.row_number().over(Window.orderBy(numeric_order(F.col("_file")), "_file", "_split")).alias("_range"),
        ((quotes - F.col("odd").cast("long")) % 2 == 1).alias("inside"),
        (F.row_number().over(before) == 1).alias("leads"),
        (quotes % 2 == 1).alias("open_end"),
        (F.lead("_split").over(before).isNull()).alias("ends"),
    )
    inside, through = F.col("inside"), F.col("tail").isNull()
    ranges = ranges.select(
        *_RANGE, "_range", "inside", "leads", "open_end", "ends",
        F.when(inside, F.when(~through, F.col("open1"))).otherwise(F.col("open0")).alias("head"),
        F.when(inside, F.coalesce("tail", "open1")).alias("more"),
        (F.col("leads") & ~F.col("ended0")).alias("in_header"),
    )
    ranges = materialize(ranges, f"{work}/ranges")
    unbalanced = ranges.filter("ends and open_end").select("_file").limit(5).collect()
    if unbalanced:
        raise ValueError(f"a quoted field is not closed in {', '.join(r[0] for r in unbalanced)}")
    return lines, ranges


def quoted_records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """The records behind the header that are not blank: ``_range`` of their first line,
    ``_pos`` among those that end in it (null: ends in a later one, so it is the last) and
    ``record``.

    A second reading, which knows how each range starts, joins the lines of the records
    that lie within one; lines are neither exchanged nor written.  Records of several
    ranges are put together from the texts at the ends of ranges, which the first
    reading has written.
    """
    # One row per byte range: that is the bound of this broadcast.
    known = F.broadcast(ranges.select(*_RANGE, "_range", "inside", "leads"))
    changed = F.raise_error(F.lit("a byte range differs between two readings; files or executors have changed")).cast("int")
    placed = lines.join(known, list(_RANGE), "left").select(F.coalesce("_range", changed).alias("_range"), "inside", "leads", "line")
    whole = placed.mapInArrow(_whole_records, "_range int, _pos long, record string")

    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("head").isNotNull(), F.struct(F.col("_range").alias("range"), F.col("in_header").alias("header")))
    carried = F.last(opened, True).over(earlier)
    pieces = ranges.select("_range", "more", "head", carried.alias("_carried"), opened.alias("_own"))
    piece = lambda start, text: F.struct(start.alias("start"), F.col(text).alias("text"))
    pieces = pieces.select("_range", F.explode(F.array(piece(F.col("_carried"), "more"), piece(F.col("_own"), "head"))).alias("x"))
    pieces = pieces.filter("x.text is not null and not x.start.header")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("_range", "x.text"))), lambda x: x["text"])
    many = pieces.groupBy(F.col("x.start.range").alias("_range")).agg(F.array_join(texts, "\n").alias("record"))
    return whole.unionByName(many.select("_range", F.lit(None).cast("long").alias("_pos"), "record"))


def scan_quoted(spark: SparkSession, path: str, work: str, schema: T.StructType = S.RAW_TEXT_SCHEMA) -> DataFrame:
    """A1 for fields that hold line ends: the text columns and the record's place
    (``_file``, ``_split``, ``_pos``, see ``quoted_records``).  A file of any size is read
    by many tasks.

    Records end at a line feed, with or without a carriage return before it; blank
    records are skipped; a quote inside a value that is not quoted must not occur (the
    format asks for quotes around such values), and a file in which a quoted field
    stays open is an error, as is a record with too few fields.
    """
    lines, ranges = quoted_lines(spark, path, work)
    names = F.broadcast(ranges.select("_range", "_file", "_split"))
    records = quoted_records(lines, ranges).join(names, "_range")
    text = F.regexp_replace("record", r"\r\z", "")
    options = {k: v for k, v in READ_OPTIONS.items() if k not in ("header", "encoding")}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(text, ddl, options)
    rows = records.select("_file", "_split", "_pos", parsed.alias("row"))
    return rows.select("row.*", "_file", "_split", "_pos")


def numeric_order(path: Column) -> Column:
    """A file name's sort key: every run of digits padded to 20, so that
    ``part-99999`` comes before ``part-100000``."""
    padded = F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})(?!\d)", "$1")


def ingest_csv(
    spark: SparkSession, path: str, work_path: str, *, source_file: str | None = None, multi_line: bool = False
) -> DataFrame:
    """A1 + A3: raw layer with ``raw_row_id`` dense from 1 in file order (files by
    name, numbers in names by value, then position), ``source_file`` and
    ``ingested_at``.

    A position is the start of the file's split and the row's place in it.  The scanned
    rows are written once, which fixes both; rows of a split lie together, so a row's
    number is the rows of all splits before its own, one sum per split, and its place.
    The rows themselves are neither exchanged nor sorted.
    """
    if multi_line:
        scanned = scan_quoted(spark, path, f"{work_path}-quoted")
    else:
        scanned = scan_csv(spark, path).select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    staged = materialize(scanned, work_path)
    splits = staged.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    earlier = Window.orderBy(numeric_order(F.col("_file")), "_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))
    # One row per split: that is the bound of this broadcast.
    splits = F.broadcast(splits.select("_file", "_split", "_n", "_first", before.alias("_before")))
    place = F.coalesce(F.col("_pos") - F.col("_first") + 1, F.col("_n"))
    numbered = staged.join(splits, ["_file", "_split"]).withColumn("raw_row_id", F.col("_before") + place)
    file_label = F.lit(source_file) if source_file else F.element_at(F.split(F.col("_file"), "/"), -1)
    return numbered.select(
        "raw_row_id", *S.RAW_COLUMNS, file_label.alias("source_file"), F.current_timestamp().alias("ingested_at")
    )
