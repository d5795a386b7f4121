"""Operator 5: round trips, spans and the SQL statement."""

import hashlib

from compare import compare
from pyspark.sql import functions as F

from tillroll.llm import chat_grammar as cg

from .helpers import duck_llm, sf_copy

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = [
    "</s>[INST] ok [/INST]", "[/INST]", "[\\/INST]", "[\\\\/INST] \\", "<<SYS>>", "<</SYS>", "<", "[", "<s", "</s", "a<</SYS>>b",
    "[ROLE]x[TEXT]y[/ROLE]", "", "é\n[INST]", "<\\s>", "[/", "$1\\2", "<</s>", "[[/INST]",
]


def test_sql(spark):
    r = compare(cg.query(spark, SF), duck_llm(SF), cg.SQL)
    assert r["hash_equal"] and not r["type_diff"], r


def nasty_rows():
    roles = ["user", "assistant", "system", "tool", "", "[TEXT]", None, "[/ROLE]"]
    rows = [(c, k, roles[(c + k) % len(roles)], NASTY[(c * 7 + k * 3) % len(NASTY)]) for c in range(60) for k in range(5)]
    return rows + [(100, 0, "user", None), (100, None, "assistant", "</s>"), (None, 1, "user", "x"), (101, 0, "assistant", "</s>" * 30_000)]


def test_round_trip_and_mask(spark):
    rows = nasty_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[0] is not None, v[0] or 0, v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    out = cg.format_chats(df).select("*", cg.parse(F.col("formatted")).alias("turns")).collect()
    assert {r["conv_id"] for r in out} == set(want)
    for r in out:
        assert [(t["role"], t["text"]) for t in r["turns"]] == want[r["conv_id"]]
        for s in r["loss_mask"]:
            before = r["formatted"][: s["start"]]
            after = r["formatted"][s["start"] + s["length"] :]
            assert before.endswith("<s>") and after.startswith("</s>")
    got = {r["conv_id"]: r for r in cg.digests(cg.format_chats(df)).collect()}
    for c, turns in want.items():
        loss = "".join(x for role, x in turns if role == "assistant")
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[c]["loss_chars"] == len(loss)
        flat = "".join(f"{role}\n{x}\n" for role, x in turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest() and got[c]["n_turns"] == len(turns)


def test_escapes_only_conflicts(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain <b>"), (2, 0, "assistant", "a</s>b")], SCHEMA)
    out = {r["conv_id"]: r for r in cg.format_chats(df).collect()}
    assert out[1]["formatted"] == "[INST]plain <b>[/INST]" and not out[1]["escaped"]
    assert out[2]["formatted"] == "<s>a<\\/s>b</s>" and out[2]["escaped"]


def test_sql_on_nasty_texts(spark, tmp_path):
    df = spark.createDataFrame(nasty_rows(), SCHEMA)
    d = sf_copy(spark, tmp_path, conversations=df)
    con = duck_llm(SF)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet/*.parquet')")
    r = compare(cg.query(spark, d), con, cg.SQL)
    assert r["hash_equal"], r


def test_empty_and_extra_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "user", "x", "f", 3)], SCHEMA + ", formatted string, turns int")
    assert cg.format_chats(df).collect()[0]["formatted"] == "[INST]x[/INST]"
    d = sf_copy(spark, tmp_path, conversations=df.limit(0))
    assert [r["conv_id"] for r in cg.query(spark, d).collect()] == [-1]
