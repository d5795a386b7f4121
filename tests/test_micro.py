"""Hand-made fixtures for cases the main fixture cannot hold."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.money import exact_mean, percent
from tillroll.operators import analyses as G
from tillroll.operators import profile as B
from tillroll.operators import staging as C
from tillroll.operators import validate as H
from tillroll.operators import views as V
from tillroll.plans.warehouse import Warehouse, build_from_raw
from tillroll.sources import csv

D1 = "2011-01-03 10:00:00"
D2 = "2011-02-07 11:30:00"


def raw_df(spark, rows):
    now = datetime(2026, 1, 1)
    data = [(i + 1, *r, "micro.csv", now) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, S.RAW_SCHEMA)


def line(invoice="500001", code="85123A", desc="HEART", qty="2", date=D1, price="2.55", cust="17850", country="UK"):
    return (invoice, code, desc, qty, date, price, cust, country)


def staged(spark, rows, **kw):
    return {r["raw_row_id"]: r for r in C.staging(raw_df(spark, rows), **kw).collect()}


def test_null_invoice_is_sale_but_not_positive_and_fact_load_raises(spark):
    rows = [line(invoice="  "), line()]
    s = staged(spark, rows)
    assert s[1]["record_type"] == "SALE" and s[1]["is_positive_sale"] is False
    with pytest.raises(Exception, match="invoice_no must not be NULL"):
        build_from_raw(spark, raw_df(spark, rows))


def test_overlapping_flags(spark):
    s = staged(spark, [line(qty="-2", price="-1.00"), line(qty="0", price="3")])
    assert s[1]["record_type"] == "ACCOUNTING_ADJUSTMENT" and s[1]["is_stock_adjustment"] is True
    assert s[2]["record_type"] == "OTHER"


@pytest.mark.parametrize(
    "bad",
    [line(qty="x"), line(qty="5.0"), line(qty="12345678901"), line(date="2011-13-01 10:00:00"), line(qty="1\n"),
     line(date="2011"), line(date="2011-01"), line(date="2011-01-05 08"), line(date="2011-01-05 08:")],
)
def test_strict_load_raises_and_quarantine_keeps(spark, bad):
    raw = raw_df(spark, [line(), bad])
    with pytest.raises(Exception, match="malformed"):
        C.staging(raw).collect()
    tolerant = C.staging(raw, strict=False).collect()
    assert len(tolerant) == 2
    assert [r["raw_row_id"] for r in C.quarantine(raw).collect()] == [2]


def test_plain_dates_and_minutes_are_timestamps(spark):
    s = staged(spark, [line(date="2011-01-05"), line(date="2011-01-05 08:30"), line(date="2011-01-05T08:30:15.5")])
    assert [s[i]["invoice_date"] for i in (1, 2, 3)] == [
        datetime(2011, 1, 5), datetime(2011, 1, 5, 8, 30), datetime(2011, 1, 5, 8, 30, 15, 500_000)
    ]


def test_exact_prices_in_the_profile(spark):
    raw = raw_df(spark, [line(price="-0.0000001"), line(price="123456789012345.5", cust=None), line(price="0.00"), line(price="-" + "9" * 30)])
    r = B.business_anomalies(raw).first()
    assert (r["negative_unit_price_rows"], r["zero_unit_price_rows"]) == (2, 1)
    short = raw.filter("raw_row_id < 4")
    assert [r["raw_row_id"] for r in B.negative_price_rows(short).collect()] == [1]
    assert [r["row_count"] for r in B.zero_price_products(short).collect()] == [1]
    assert B.missing_customer_profile(short).first()["positive_revenue_without_customer"] == Decimal("246913578024691.00")


def test_format_profile_uses_end_anchor(spark):
    raw = raw_df(spark, [line(qty="1\n"), line(qty=" 3"), line(price="1e3"), line(cust="12.0")])
    r = B.invalid_formats(raw).first()
    assert (r["invalid_quantity_format"], r["invalid_unit_price_format"], r["invalid_customer_id_format"]) == (2, 1, 1)


def test_cancelled_with_non_negative_quantity(spark):
    raw = raw_df(spark, [line(invoice="C500002", qty="3"), line(invoice="C500003", qty="-1"), line(qty="-4")])
    r = B.cancel_consistency(raw).first()
    assert tuple(r) == (1, 1, 1)


def test_raw_vs_normalised_duplicates(spark):
    rows = [line(), line(), line(desc="HEART "), line(code="85123a")]
    s = staged(spark, rows)
    assert [s[i]["duplicate_group_size"] for i in (1, 2, 3, 4)] == [2, 2, 1, 1]
    assert [s[i]["duplicate_rank"] for i in (1, 2)] == [1, 2]
    assert {s[i]["stock_code"] for i in s} == {"85123A"}


@pytest.fixture(scope="module")
def micro_wh(spark):
    rows = [
        line(invoice="500001", country="UK"),
        line(invoice="500001", code="22423", country="France"),  # one invoice, two countries
        line(invoice="500002", code="22423", desc="REGENCY B", date=D2),
        line(invoice="500003", code="22423", desc="REGENCY A", date=D2),  # same count and date: alphabetical
        line(invoice="500004", code="22423", desc="REGENCY A", date=D1),
        line(invoice="500005", code="22423", desc="REGENCY B", date=D1),
        line(invoice="C500006", code="99999", desc="ONLY CANCELLED", qty="-5", date=D2),
        line(invoice="500007", code="DOT", desc="POSTAGE", qty="1", price="18.00", cust=None),
    ]
    return build_from_raw(spark, raw_df(spark, rows))


def test_multi_country_invoice_gives_two_order_rows(micro_wh):
    orders = V.order_summary(micro_wh).filter(F.col("invoice_no") == "500001").collect()
    assert sorted(r["country_name"] for r in orders) == ["France", "UK"]


def test_description_ties(micro_wh):
    d = {r["stock_code"]: r["product_description"] for r in micro_wh.dim_product.collect()}
    assert d["22423"] == "REGENCY A"


def test_nothing_sold_gives_null_ratios(micro_wh):
    p = {r["stock_code"]: r for r in V.product_kpis(micro_wh).collect()}
    assert p["99999"]["cancelled_units_pct_of_sold"] is None
    assert p["99999"]["cancelled_quantity"] == 5
    m = {r["year_month"]: r for r in V.monthly_kpis(micro_wh).collect()}
    assert set(m) == {"2011-01", "2011-02"}
    growth = G.monthly_growth(micro_wh).collect()
    assert growth[0]["previous_month_gross_revenue"] is None and growth[0]["year_month"] == "2011-01"


def test_unknown_members_and_validation_pass(micro_wh):
    rows = H.assert_valid(micro_wh, raw_rows=8, products=4)
    assert all(r[3] for r in rows)
    f = micro_wh.fact.filter(F.col("customer_key") == 0).count()
    assert f == 1


def test_exact_mean_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("200496.0000"), 100000, 3, 8)], "s decimal(38,4), n long, a long, b long")
    r = df.select(
        exact_mean("s", "n", total_scale=4).alias("m"), percent("a", "b").alias("p"), percent("a", "0").alias("z")
    ).first()
    assert r["m"] == Decimal("2.00") and r["p"] == Decimal("37.50") and r["z"] is None


def test_empty_input(spark):
    wh = build_from_raw(spark, raw_df(spark, []))
    k = V.kpi_overview(wh).first()
    assert k["positive_sale_lines"] == 0 and k["gross_revenue"] == Decimal("0.00")
    assert k["average_order_value"] is None and k["cancellation_invoice_rate_pct"] is None
    assert wh.dim_customer.count() == 1 and wh.dim_date.count() == 1
    census = B.duplicate_census(wh.raw).first()
    assert tuple(census) == (0, 0, 0)


def test_csv_round_trip(spark, tmp_path):
    values = [
        ('say "hi"', "a,b", "two\nlines", "", " pad ", "x", "1", "z"),
        (None, "q", "r", "s", "t", "u", "v", "w"),
    ]
    df = spark.createDataFrame(values, S.RAW_TEXT_SCHEMA)
    path = str(tmp_path / "csv")
    csv.write_csv(df.coalesce(1), path)
    back = {tuple(r) for r in csv.scan_csv(spark, path, multi_line=True).collect()}
    assert ('say "hi"', "a,b", "two\nlines", None, " pad ", "x", "1", "z") in back
    assert (None, "q", "r", "s", "t", "u", "v", "w") in back


def quoted_file(folder, rows, line_end="\n", last=True):
    """One CSV file with a header; a field is quoted if it must be."""
    field = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') else v
    text = line_end.join([",".join(S.RAW_COLUMNS), *[",".join(map(field, r)) for r in rows]]) + (line_end if last else "")
    folder.mkdir(exist_ok=True)
    (folder / "part-1.csv").write_text(text, newline="")
    return str(folder)


@pytest.mark.parametrize("split", [400, 1 << 27])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_quoted_line_ends_by_byte_range(spark, tmp_path, split, line_end):
    """Fields with line ends, longer than several ranges, read by many tasks in file order."""
    rows = [
        [str(k), f"s{k}", ["plain", "a\nb", 'say "x",\n\n"', "\n" * 40, '""', f"{'long line ' * 30}\n" * (k % 7 + 1), "é\r\nü"][k % 7], "1", "2011-01-01 10:00:00", "1.0", "5", "United\nKingdom" if k % 3 else "UK"]
        for k in range(28)
    ]
    path = quoted_file(tmp_path / f"q{split}{len(line_end)}", rows, line_end, last=split > 400)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines, ranges = csv.quoted_lines(spark, path, str(tmp_path / "lines"))
        out = csv.ingest_csv(spark, path, str(tmp_path / "work"), multi_line=True).orderBy("raw_row_id").collect()
        plain = csv.scan_csv(spark, path, multi_line=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ranges.count() > 8 or split > 400
    assert [r.raw_row_id for r in out] == list(range(1, 29))
    assert [[r[c] for c in S.RAW_COLUMNS] for r in out] == rows
    assert sorted(map(tuple, plain)) == sorted(map(tuple, rows))
    if line_end == "\n":
        one_task = spark.read.schema(S.RAW_TEXT_SCHEMA).options(**csv.READ_OPTIONS).option("multiLine", True).csv(path)
        same = lambda df: sorted(tuple(r) for r in df if "\r" not in r.description)
        assert same(one_task.collect()) == same(plain)


def test_quoted_files_stay_apart(spark, tmp_path):
    """Each file has a header and its own quotes; an open quote is an error that names the file."""
    good = quoted_file(tmp_path / "two", [["1", "s", "a\nb", "1", "d", "1", "", "UK"], ["2", "s", "", "1", "d", "1", "", "UK"]])
    (tmp_path / "two" / "part-2.csv").write_text(f'{",".join(S.RAW_COLUMNS)}\n\n3,s,"x\n",1,d,1,,UK\n   \n')
    got = csv.scan_csv(spark, good, multi_line=True).collect()
    assert sorted((r.invoice_no, r.description) for r in got) == [("1", "a\nb"), ("2", None), ("3", "x\n")]
    (tmp_path / "two" / "part-3.csv").write_text(f'{",".join(S.RAW_COLUMNS)}\n4,s,"x,1,d,1,,UK\n')
    with pytest.raises(ValueError, match="part-3.csv"):
        csv.scan_csv(spark, good, multi_line=True)
    short = tmp_path / "short2.csv"
    short.write_text(f"{','.join(S.RAW_COLUMNS)}\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.scan_csv(spark, str(short), multi_line=True).collect()


def test_csv_short_row_raises(spark, tmp_path):
    p = tmp_path / "short.csv"
    p.write_text("invoice_no,stock_code,description,quantity,invoice_date,unit_price,customer_id,country\n1,2,3\n")
    with pytest.raises(Exception):
        csv.scan_csv(spark, str(p)).collect()


def test_seeded_violations_each_hit_their_rule(spark, micro_wh, tmp_path):
    root = str(tmp_path / "tampered")
    wh = Warehouse(spark, root, rows=dict(micro_wh.rows))
    fact = micro_wh.fact
    dup = fact.limit(1)
    orphan = fact.limit(1).withColumn("raw_row_id", F.lit(999).cast("long")).withColumn(
        "sales_key", F.lit(999).cast("long")
    ).withColumn("product_key", F.lit(12345).cast("long"))
    fact.unionByName(dup).unionByName(orphan).write.parquet(wh.path("warehouse/fact_sales"))
    micro_wh.staging.withColumn(
        "stock_code", F.when(F.col("raw_row_id") == 1, F.lower("stock_code")).otherwise(F.col("stock_code"))
    ).write.parquet(wh.path("staging/transactions"))
    micro_wh.raw.write.parquet(wh.path("raw/online_retail"))
    micro_wh.dim_customer.filter(~F.col("is_unknown")).write.parquet(wh.path("warehouse/dim_customer"))
    for d in ("dim_product", "dim_country", "dim_date"):
        getattr(micro_wh, d).write.parquet(wh.path(f"warehouse/{d}"))
    failed = {r["rule"]: r["actual"] for r in H.report(wh, raw_rows=8, products=4).collect() if not r["passed"]}
    assert set(failed) == {
        "first_occurrences_equal_fact",
        "stock_code_uppercase",
        "fact_raw_row_id_unique",
        "orphan_product_key",
        "orphan_customer_key",
        "unknown_member_dim_customer",
    }
    assert failed["stock_code_uppercase"] == 1 and failed["orphan_product_key"] == 1
    with pytest.raises(H.ValidationError):
        H.assert_valid(wh, raw_rows=8, products=4)


def test_registered_views_answer_sql(spark, micro_wh):
    names = micro_wh.register_views()
    assert "analytics_v_kpi_overview" in names
    r = spark.sql("SELECT positive_order_count FROM analytics_v_kpi_overview").first()
    assert r[0] == 6


def test_build_from_csv_equals_build_from_raw(spark, micro_wh, tmp_path):
    from tillroll.plans.warehouse import build_from_csv

    path = str(tmp_path / "source_csv")
    csv.write_csv(micro_wh.raw.orderBy("raw_row_id").select(*S.RAW_COLUMNS).coalesce(1), path)
    wh = build_from_csv(spark, path, source_file="micro.csv")
    cols = ["raw_row_id", "invoice_no", "stock_code", "quantity", "line_amount", "record_type", "duplicate_rank"]
    a = sorted(tuple(r) for r in wh.staging.select(*cols).collect())
    b = sorted(tuple(r) for r in micro_wh.staging.select(*cols).collect())
    assert a == b
    assert V.kpi_overview(wh).collect() == V.kpi_overview(micro_wh).collect()


def test_tolerant_load_quarantines_and_skips(spark):
    rows = [line(), line(invoice="500009", qty="x"), line(invoice="500010", date="not a date"), line(invoice=" ")]
    wh = build_from_raw(spark, raw_df(spark, rows), strict=False)
    listed = {r["raw_row_id"]: r["reasons"] for r in spark.read.parquet(wh.path("staging/quarantine")).collect()}
    assert listed == {2: ["malformed quantity"], 3: ["malformed invoice_date"], 4: ["missing invoice_no"]}
    assert wh.staging.count() == 4
    assert [r["raw_row_id"] for r in wh.fact.collect()] == [1]  # NULL quantity / date are required
    failed = {r["rule"] for r in H.report(wh, raw_rows=4, products=1).collect() if not r["passed"]}
    assert failed == {"first_occurrences_equal_fact"}


def test_one_file_is_read_by_several_tasks_in_order(spark, tmp_path):
    """A file split over tasks keeps its order, and numbers in names count as numbers."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(S.RAW_COLUMNS) + "\n"
    names = ["part-99999.csv", "part-100000.csv"]
    n = 0
    for name in names:
        lines = [f"{n + k},c,d,1,2011-01-01 00:00:00,1,1,UK\n" for k in range(3000)]
        (folder / name).write_text(head + "".join(lines))
        n += 3000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert csv.scan_csv(spark, str(folder)).rdd.getNumPartitions() > 4
        out = csv.ingest_csv(spark, str(folder), str(tmp_path / "work")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [int(r["invoice_no"]) for r in sorted(out, key=lambda r: r["raw_row_id"])] == list(range(6000))
    assert {r["source_file"] for r in out} == set(names)
