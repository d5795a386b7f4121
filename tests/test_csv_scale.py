"""CSV rows and records are read where they lie."""

import re

from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.sources import csv


def test_csv_rows_are_not_exchanged(spark, wh_small, tmp_path):
    """Neither ingesting files nor putting quoted records together deals rows anew."""
    path = str(tmp_path / "csv")
    csv.write_csv(wh_small.raw.select(*S.RAW_COLUMNS).withColumn("description", F.lit('a\n"b')).limit(500), path)
    for many in (False, True):
        if many:
            plan = csv.quoted_records(*csv.quoted_lines(spark, path, str(tmp_path / "lines")))
        else:
            csv.write_csv(wh_small.raw.select(*S.RAW_COLUMNS), path + "1")
            plan = csv.ingest_csv(spark, path + "1", str(tmp_path / "work"))
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange rangepartitioning|hashpartitioning\([^)]*(line|invoice_no)", text)
        assert many or "SortMergeJoin" not in text
