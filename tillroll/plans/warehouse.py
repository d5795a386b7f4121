"""Full-refresh build of the layered warehouse.

raw (text) -> staging (typed, classified, duplicates marked) -> dimensions
-> fact.  Each layer is written as Parquet under the shared folder named by
``spark.checkpoint.dir`` and read back, which cuts lineage (a lost executor
recomputes at most one layer) and lets later stages read only the columns they
need.

A load never writes into a folder that is being read: it goes to a new folder,
becomes the current build of its input when all layers are written (``builds``),
and the build it replaces is deleted.  The current build is used again, also by
other applications that share the folder, as long as the input files -- path, size
and time, as Spark lists them on any file system -- and the code are the same.

A load may end at the last layer that a query needs; a later query that needs more
carries it on.

While a layer is written Spark counts what the validation report needs of it
(observed metrics of the tasks that wrote it), so the report need not scan the
layers again.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas as S
from tillroll.operators import dimensions, facts, staging, validate
from tillroll.plans import builds
from tillroll.plans.session import materialize, remove_path, run_root, shuffles_released
from tillroll.sources import fixture

# The month a fact file belongs to (YYYYMM, 0 without a date); not a fact column.
FACT_PARTITION = "sales_month"


# In the order of a load; each is made of those before it.
LAYERS = ("raw", "staging", "dimensions", "fact")


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    source: str | None = None
    rows: dict[str, int] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    metrics: dict[str, int] = field(default_factory=dict)
    made: set[str] = field(default_factory=set)
    upto: str = LAYERS[0]  # the last layer that is loaded

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @property
    def raw(self) -> DataFrame:
        return self.table("raw/online_retail")

    @property
    def staging(self) -> DataFrame:
        return self.table("staging/transactions")

    @property
    def fact_files(self) -> DataFrame:
        """The fact with its month folders; the schema is given, as a fact without
        rows has no file."""
        comments = S.COLUMN_COMMENTS["warehouse/fact_sales"]
        fields = T.StructType.fromDDL(f"{facts.FACT_DDL}, {FACT_PARTITION} int").fields
        schema = T.StructType([T.StructField(f.name, f.dataType, True, {"comment": comments[f.name]} if f.name in comments else {}) for f in fields])
        return self.spark.read.schema(schema).parquet(self.path("warehouse/fact_sales"))

    @property
    def fact(self) -> DataFrame:
        return self.fact_files.drop(FACT_PARTITION)

    def fact_months(self, first: int, last: int) -> DataFrame:
        """The fact of the months first to last (YYYYMM); other months' files are not read."""
        return self.fact_files.filter(F.col(FACT_PARTITION).between(first, last)).drop(FACT_PARTITION)

    @property
    def dim_customer(self) -> DataFrame:
        return self.table("warehouse/dim_customer")

    @property
    def dim_product(self) -> DataFrame:
        return self.table("warehouse/dim_product")

    @property
    def dim_country(self) -> DataFrame:
        return self.table("warehouse/dim_country")

    @property
    def dim_date(self) -> DataFrame:
        return self.table("warehouse/dim_date")

    def derived(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame that several analyses read, written once per build and deleted with it."""
        if name not in self.made:
            with shuffles_released(self.spark):
                make().write.mode("overwrite").option("compression", "zstd").parquet(self.path(f"derived/{name}"))
            self.made.add(name)
        return self.table(f"derived/{name}")

    def dim_rows(self, name: str) -> int:
        return self.rows[f"dim_{name}"]

    def register_views(self) -> list[str]:
        """Expose the layers and the seven analytical views as temporary
        views named ``<layer>_<table>`` (re-created on every call, views last,
        in dependency order)."""
        from tillroll.operators import views

        tables = {
            "raw_online_retail": self.raw,
            "staging_transactions": self.staging,
            "warehouse_dim_customer": self.dim_customer,
            "warehouse_dim_product": self.dim_product,
            "warehouse_dim_country": self.dim_country,
            "warehouse_dim_date": self.dim_date,
            "warehouse_fact_sales": self.fact,
        }
        orders = views.order_summary(self)
        tables.update(
            {
                "analytics_v_sales_enriched": views.sales_enriched(self),
                "analytics_v_order_summary": orders,
                "analytics_v_kpi_overview": views.kpi_overview(self),
                "analytics_v_monthly_kpis": views.monthly_kpis(self),
                "analytics_v_country_kpis": views.country_kpis(self),
                "analytics_v_product_kpis": views.product_kpis(self),
                "analytics_v_customer_kpis": views.customer_kpis(self, orders),
            }
        )
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return list(tables)

    def catalog(self) -> DataFrame:
        """A5: the registered names by layer, with the rows of each."""
        parts = [
            self.spark.table(name).agg(
                F.lit(name.split("_")[0]).alias("layer"), F.lit(name.split("_", 1)[1]).alias("name"), F.count(F.lit(1)).alias("row_count")
            )
            for name in self.register_views()
        ]
        return reduce(DataFrame.unionByName, parts)

    def descriptions(self) -> DataFrame:
        """A10: what the stored columns mean, read back from the written layers,
        with the values that each described column holds; tables are described
        with their row counts."""
        parts = []
        for table, text in S.TABLE_COMMENTS.items():
            df = self.fact if table == "warehouse/fact_sales" else self.table(table)
            notes = {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}
            counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in notes])
            told = [("", text, "_rows"), *[(c, t, c) for c, t in notes.items()]]
            rows = [
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("description"), F.col(n).alias("value_count")) for c, t, n in told
            ]
            parts.append(counts.select(F.lit(table).alias("object_name"), F.inline(F.array(*rows))))
        return reduce(DataFrame.unionByName, parts)


def described(df: DataFrame, table: str) -> DataFrame:
    """A10: attach the column descriptions of ``table`` as field metadata."""
    comments = S.COLUMN_COMMENTS.get(table, {})
    # Columns without one lose what they were described as in an earlier layer.
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]} if c in comments else {}) for c in df.columns])


def _timed(wh: Warehouse, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    wh.timings[name] = round(time.perf_counter() - t0, 3)
    return out


def _observed(wh: Warehouse, df: DataFrame, measures: dict[str, str], write: Callable[[DataFrame], None]) -> None:
    """Write a frame and keep what its writing tasks have counted."""
    seen = Observation()
    write(df.observe(seen, *[F.expr(c).alias(n) for n, c in measures.items()]))
    wh.metrics.update({n: int(v) for n, v in seen.get.items()})


def load_raw(wh: Warehouse, sf_dir: str) -> None:
    """A3/A4: number the raw rows and write the raw layer."""
    with shuffles_released(wh.spark):
        raw = fixture.raw_rows(wh.spark, sf_dir, work=wh.path("_work/raw"))
        write_raw(wh, described(raw, "raw/online_retail"))


def write_raw(wh: Warehouse, raw: DataFrame) -> None:
    _observed(wh, raw, validate.RAW_MEASURES, lambda df: materialize(df, wh.path("raw/online_retail")))


def load_staging(wh: Warehouse, *, strict: bool = True) -> None:
    # Rows without a duplicate, nearly all, are written by the task that read them,
    # in raw_row_id order; only possible duplicates have been exchanged.
    stg = staging.staging(wh.raw, strict=strict, work=wh.path("_work/repeated"))
    stg = described(stg, "staging/transactions")
    _observed(wh, stg, validate.STAGING_MEASURES, lambda df: materialize(df, wh.path("staging/transactions")))
    if not strict:
        # tolerant load: every row stays in staging (malformed values NULL); the raw
        # rows that cannot be facts are listed with their reasons in a side table
        staging.quarantine(wh.raw).write.mode("overwrite").parquet(wh.path("staging/quarantine"))


def load_dimensions(wh: Warehouse) -> None:
    stg, work = wh.staging, wh.path("_work")
    builders = {
        "dim_customer": lambda: dimensions.dim_customer(stg, work=work),
        "dim_product": lambda: dimensions.dim_product(stg, work=work),
        "dim_country": lambda: dimensions.dim_country(stg, work=work),
        "dim_date": lambda: dimensions.dim_date(stg),
    }

    def load(name: str) -> int:
        df = builders[name]()
        described(df, f"warehouse/{name}").write.mode("overwrite").parquet(wh.path(f"warehouse/{name}"))
        return wh.table(f"warehouse/{name}").count()

    # The four dimensions are independent: their (small) jobs run concurrently.
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        counts = dict(zip(builders, pool.map(load, builders)))
    wh.rows.update(counts)


def load_fact(wh: Warehouse, *, strict: bool = True) -> None:
    rows = facts.keyed_rows(
        wh.staging, wh.dim_customer, wh.dim_product, wh.dim_country, strict=strict, work=wh.path("_work/fact_numbered")
    )
    # One folder per month, so a range of dates reads its months only, and days in
    # order inside a file for the row-group statistics.  The rebalancing shuffle
    # splits months that are too large for a task and keeps small ones in one file.
    # It and the sort take the narrow rows.
    month = F.call_function("div", facts.date_key(), F.lit(100)).cast("int")
    placed = rows.withColumn(FACT_PARTITION, month).hint("rebalance", FACT_PARTITION)
    placed = placed.withColumn("_day", facts.date_key()).sortWithinPartitions(FACT_PARTITION, "_day", "raw_row_id")
    placed = described(facts.fact_columns(placed, FACT_PARTITION), "warehouse/fact_sales")
    path = wh.path("warehouse/fact_sales")
    _observed(wh, placed, validate.FACT_MEASURES, lambda df: df.write.mode("overwrite").option("compression", "zstd").partitionBy(FACT_PARTITION).parquet(path))
    wh.rows["fact_sales"] = wh.metrics["fact_rows"]


def load_layers(wh: Warehouse, *, strict: bool = True, upto: str = LAYERS[-1]) -> Warehouse:
    """The layers behind those already in ``wh``, ``upto`` the given one; the working
    frames are deleted."""
    loads = {
        "staging": lambda: load_staging(wh, strict=strict),
        "dimensions": lambda: load_dimensions(wh),
        "fact": lambda: load_fact(wh, strict=strict),
    }
    for layer in LAYERS[LAYERS.index(wh.upto) + 1 : LAYERS.index(upto) + 1]:
        remove_path(wh.spark, wh.path("_work"))
        with shuffles_released(wh.spark):
            _timed(wh, layer, loads[layer])
        wh.upto = layer
    remove_path(wh.spark, wh.path("_work"))
    return wh


def build_from_raw(spark: SparkSession, raw: DataFrame, *, root: str | None = None, strict: bool = True) -> Warehouse:
    """Load a warehouse from a raw layer with the ``RAW_SCHEMA`` columns."""
    wh = Warehouse(spark, root or run_root(spark, "warehouse"))
    write_raw(wh, raw)
    return load_layers(wh, strict=strict)


def build_from_csv(
    spark: SparkSession,
    csv_path: str,
    *,
    root: str | None = None,
    source_file: str | None = None,
    strict: bool = True,
    multi_line: bool = False,
) -> Warehouse:
    """Full load from header CSV files of the eight source columns (A1 + A3):
    raw_row_id follows file name, then position in the file.  ``multi_line`` reads
    fields that hold line ends."""
    from tillroll.sources import csv

    wh = Warehouse(spark, root or run_root(spark, "warehouse"))

    def load() -> None:
        with shuffles_released(spark):
            raw = csv.ingest_csv(spark, csv_path, wh.path("_work/csv_scan"), source_file=source_file, multi_line=multi_line)
            write_raw(wh, described(raw, "raw/online_retail"))

    _timed(wh, "raw", load)
    return load_layers(wh, strict=strict)


def build(
    spark: SparkSession, sf_dir: str, *, root: str | None = None, strict: bool = True, upto: str = LAYERS[-1]
) -> Warehouse:
    """Run the whole load from the test tables in ``sf_dir``, or its layers ``upto`` one."""
    wh = Warehouse(spark, root or run_root(spark, "warehouse"), source=sf_dir)
    _timed(wh, "raw", lambda: load_raw(wh, sf_dir))
    return load_layers(wh, strict=strict, upto=upto)


INPUT_TABLES = ("lineitem", "orders", "customer", "nation", "part")
# (application, input folder, target) -> (number of the build, the build)
_OPENED: dict[tuple[str, str, str], tuple[int, Warehouse]] = {}
_LOCK = threading.Lock()


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size, latest time and a combined hash of the input files, from
    Spark's own listing (no content is read)."""
    paths = [f"{sf_dir}/{t}.parquet" for t in INPUT_TABLES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    changed = F.unix_micros("modificationTime")
    own = F.xxhash64("path", "length", changed)
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max(changed), F.bit_xor(own)).first())


def _publish(spark: SparkSession, wh: Warehouse, state: tuple, target: str) -> Warehouse:
    sf_dir = wh.source
    told = {"root": wh.root, "state": list(state), "rows": wh.rows, "timings": wh.timings, "metrics": wh.metrics, "upto": wh.upto}
    number = builds.publish(spark, sf_dir, target, told)
    _OPENED[spark.sparkContext.applicationId, sf_dir, target] = (number, wh)
    return wh


def _load(spark: SparkSession, sf_dir: str, state: tuple, target: str = "queries", upto: str = LAYERS[-1]) -> Warehouse:
    wh = build(spark, sf_dir) if upto == LAYERS[-1] else build(spark, sf_dir, upto=upto)
    return _publish(spark, wh, state, target)


def refresh(spark: SparkSession, sf_dir: str, target: str = "queries") -> Warehouse:
    """A4: load again and replace the target's current build of this input; the
    replaced build is deleted once the new one is complete."""
    sf_dir = sf_dir.rstrip("/")
    with _LOCK:
        return _load(spark, sf_dir, input_state(spark, sf_dir), target)


def warehouse_for(spark: SparkSession, sf_dir: str, target: str = "queries", upto: str = LAYERS[-1]) -> Warehouse:
    """The current build for ``sf_dir``, whichever application published it; loaded
    anew if there is none or the input files have changed.

    ``upto`` is the last layer that is needed.  A build of this application that ends
    before it is carried on; one of another application, which may be at that itself,
    is left to it and loaded anew."""
    sf_dir = sf_dir.rstrip("/")
    with _LOCK:
        state = input_state(spark, sf_dir)
        found = builds.current(spark, sf_dir, target)
        if not found or found[1]["state"] != list(state):
            return _load(spark, sf_dir, state, target, upto)
        app, told = spark.sparkContext.applicationId, found[1]
        key = (app, sf_dir, target)
        if key not in _OPENED or _OPENED[key][0] != found[0]:
            wh = Warehouse(spark, told["root"], sf_dir, told["rows"], told["timings"], told["metrics"], upto=told.get("upto", LAYERS[-1]))
            _OPENED[key] = (found[0], wh)
        wh = _OPENED[key][1]
        if LAYERS.index(wh.upto) >= LAYERS.index(upto):
            return wh
        if told["app"] != app:
            return _load(spark, sf_dir, state, target, upto)
        return _publish(spark, load_layers(wh, upto=upto), state, target)
