"""Published builds, load-time metrics and the entry module from elsewhere."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from conftest import ROOT, SF_SMALL

from tillroll.operators import validate as H
from tillroll.plans import builds, warehouse


@pytest.fixture
def published(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(builds, "builds_dir", lambda s: f"file://{tmp_path}/builds")
    return tmp_path


def manifest(path: Path, **more) -> dict:
    root = path / "tillroll" / f"r{len(list(path.glob('tillroll/*')))}"
    root.mkdir(parents=True)
    return {"root": str(root), "state": [1, 2], "rows": {}, "timings": {}, "metrics": {}, **more}


def test_highest_number_is_current(spark, published):
    assert builds.current(spark, "in", "t") is None
    first, second = manifest(published), manifest(published)
    assert builds.publish(spark, "in", "t", first) == 1
    assert builds.publish(spark, "in", "t", second) == 2
    number, told = builds.current(spark, "in", "t")
    assert (number, told["root"]) == (2, second["root"])
    assert not Path(first["root"]).exists() and builds.current(spark, "in", "other") is None


def test_another_applications_build_outlives_one_refresh(spark, published, monkeypatch):
    """Its readers are pinned to it; the build after the next deletes it."""
    first, second, third = manifest(published), manifest(published), manifest(published)
    builds.publish(spark, "in", "t", first)
    folder = Path(builds._folder(spark, "in", "t").removeprefix("file://"))
    text = (folder / "build-00000001.json").read_text()
    (folder / "build-00000001.json").write_text(text.replace(spark.sparkContext.applicationId, "application-of-others"))
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    builds.publish(spark, "in", "t", second)
    assert Path(first["root"]).exists()
    builds.publish(spark, "in", "t", third)
    assert not Path(first["root"]).exists() and not Path(second["root"]).exists()


def test_aborted_load_leaves_the_old_build(spark, published, monkeypatch):
    first = manifest(published)
    builds.publish(spark, "in", "t", first)
    monkeypatch.setattr(warehouse, "build", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
    monkeypatch.setattr(warehouse, "input_state", lambda *a: (9,))
    with pytest.raises(RuntimeError, match="executor lost"):
        warehouse.refresh(spark, "in", "t")
    assert builds.current(spark, "in", "t")[1]["root"] == first["root"]


def test_two_loads_at_once(spark, published, monkeypatch):
    builds.publish(spark, "in", "t", manifest(published))
    monkeypatch.setattr(builds, "_numbers", lambda *a: [])
    monkeypatch.setattr(builds, "current", lambda *a: None)
    with pytest.raises(RuntimeError, match="same time"):
        builds.publish(spark, "in", "t", manifest(published))


def test_another_process_finds_the_build(spark, wh_small, monkeypatch):
    """Without what this process remembers, the manifest leads to the same layers."""
    monkeypatch.setattr(warehouse, "_OPENED", {})
    monkeypatch.setattr(warehouse, "build", lambda *a: pytest.fail("loaded again"))
    again = warehouse.warehouse_for(spark, SF_SMALL)
    assert again is not wh_small and (again.root, again.rows, again.metrics) == (wh_small.root, wh_small.rows, wh_small.metrics)


def test_observed_counts_equal_scans(wh_small):
    """What the load counted while writing equals a scan of what is stored, and the
    report does not scan the staging rows and the raw layer again."""
    assert sorted(H.report(wh_small).collect()) == sorted(H.report(wh_small, observed=False).collect())
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans(H.report(wh_small)) == scans(H.report(wh_small, observed=False)) - 3


def test_entry_from_another_folder(tmp_path):
    """Python workers get the package although neither they nor the driver start in it."""
    code = f"""
        import importlib.util
        from pyspark.sql import SparkSession
        spec = importlib.util.spec_from_file_location("elsewhere", "{ROOT}/__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        print("ROWS", entry.queries()["raw_csv_scan_quoted"](spark, "{SF_SMALL}").count())
    """
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 6" in out.stdout, out.stderr[-2000:]
