"""Operator 2: archives written, read back and assembled."""

import base64
import hashlib

from compare import compare

from tillroll.llm import warc_transactions as wt

from .helpers import duck_llm, sf_copy

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def test_sql(spark):
    r = compare(wt.query(spark, SF), duck_llm(SF), wt.SQL)
    assert r["hash_equal"] and not r["type_diff"], r


ROWS = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (9, "http://c/", "same"), (3, None, None), (4, "http://d/", ""),
    (5, "http://e/\r\nX: y", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC/1.1\r\n"), (None, "http://f/", "é\x00\n\r\n\r\n"),
    (6, "u", "x" * 300_000), (7, "u", "\r\n\r\n"), (8, "u", "payload-bytes: 9\r\ncapture: 1"),
]


def expected(rows):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, url, h in rows:
        raw = (h or "").encode()
        t = top.get(h or "")
        visit = t is not None and i != t
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if visit else "response", t if visit else None, url and url.replace("\r", "%0D").replace("\n", "%0A")))
    return sorted(out, key=repr)


def test_edge_cases(spark, tmp_path):
    d = sf_copy(spark, tmp_path, pages=spark.createDataFrame(ROWS, SCHEMA))
    assert sorted((tuple(r) for r in wt.query(spark, d).collect()), key=repr) == expected(ROWS)


def test_repeated_rows_and_empty(spark, tmp_path):
    twice = [(1, "u", "x"), (1, "u", "x"), (2, "u", "y"), (2, "u", "x")]
    d = sf_copy(spark, tmp_path / "a", pages=spark.createDataFrame(twice, SCHEMA))
    assert sorted((tuple(r) for r in wt.query(spark, d).collect()), key=repr) == expected(twice)
    d = sf_copy(spark, tmp_path / "b", pages=spark.createDataFrame([], SCHEMA))
    assert wt.query(spark, d).collect() == []


def test_payloads_come_back(spark, tmp_path):
    df = spark.createDataFrame([(i, u, h, "clash") for i, u, h in ROWS], SCHEMA + ", value string")
    path = str(tmp_path / "warc")
    wt.write_archives(df, path)
    got = {r["metadata"]["text"].split("\r\n")[0]: r for r in wt.captures(wt.read_records(spark, path)).collect()}
    for i, _, h in ROWS:
        r = got[f"capture: {'' if i is None else i}"]
        assert bytes(r["main"]["block"]) == ((h or "").encode() if r["main"]["type"] == "response" else b"")
        assert r["main"]["payload_bytes"] == (len((h or "").encode()) if r["main"]["type"] == "response" else None)
        assert r["request"]["text"].startswith("GET ") and r["main"]["record_id"] == r["capture"]
    assert "%0D%0AX" in got["capture: 5"]["main"]["uri"]


def test_archives_are_read_once_and_requests_joined(spark):
    plan = wt.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "MapInArrow" not in plan and plan.count("Join ") >= 2


def test_least_payload_size(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    rows = wt.archive_rows(df, "page_id", "url", "html", min_bytes=3).collect()
    assert sum("WARC-Type: revisit" in r["value"] for r in rows) == 1
