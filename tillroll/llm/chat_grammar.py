"""Operator 5: chat formatting with a grammar round trip (DataFrame functions only).

Grammar of the rendered text, one production per turn, nothing between turns:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    any other  [ROLE]role[TEXT]text[/ROLE]

The parser is deterministic: it reads turns from the left, each up to the first
closing mark of its kind.  Rendering first leaves texts as they are, reparses
the result and compares the recovered turns with the source.  Conversations
whose turns differ are rendered again with their conflicting content escaped --
a backslash enters every control string, after its bracket (``[/INST]`` ->
``[\\/INST]``, ``[\\/INST]`` -> ``[\\\\/INST]``) -- and reparsed; a conversation that
still differs is an error.  The parser removes one such backslash, so escaping
is reversible, and marks found by the parser are always real ones.

The loss mask lists the spans of assistant texts (as rendered) in code points.

Defined cases: a null text or role is the empty string; turns are ordered by
``turn`` (null first), then role, then text, so repeated rows stay repeated
turns; a null ``conv_id`` is a conversation of its own; an empty table gives an
empty result.  A conversation is one output value and so one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import table

# The control strings of the grammar.
OPENING = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSING = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
# After "<" or "[" and backslashes, what makes a control string of it.
_TAILS = r"<SYS>>|</SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\]"
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"
TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[TEXT\].*?\[/ROLE\]"
TURN_TYPE = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _wrap(role: Column, text: Column, plain_role: Column) -> Column:
    out = None
    for name, mark in OPENING.items():
        piece = F.concat(F.lit(mark), text, F.lit(CLOSING[name]))
        out = F.when(plain_role == name, piece) if out is None else out.when(plain_role == name, piece)
    return out.otherwise(F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2])))


def render(turns: Column, escaped: bool) -> Column:
    """Array of rendered turns of an array of ``(role, text)``."""
    fix = escape if escaped else (lambda c: c)
    return F.transform(turns, lambda t: _wrap(fix(t["role"]), fix(t["text"]), t["role"]))


def _inner(piece: Column, opening: str, closing: str) -> Column:
    return F.substring(piece, F.lit(len(opening) + 1), F.length(piece) - len(opening) - len(closing))


def _read_turn(piece: Column) -> Column:
    out = None
    for name, mark in OPENING.items():
        turn = F.struct(F.lit(name).alias("role"), unescape(_inner(piece, mark, CLOSING[name])).alias("text"))
        here = piece.startswith(mark)
        out = F.when(here, turn) if out is None else out.when(here, turn)
    body = _inner(piece, OTHER[0], OTHER[2])
    at = F.instr(body, OTHER[1])
    return out.otherwise(
        F.struct(
            unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(body, at + len(OTHER[1]), F.length(body))).alias("text"),
        )
    )


def pieces_of(formatted: Column) -> Column:
    """The rendered turns that the parser finds, from the left."""
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def parse(formatted: Column) -> Column:
    """Recovered ``(role, text)`` turns; null if anything lies between turns."""
    pieces = pieces_of(formatted)
    return F.when(F.array_join(pieces, "") == formatted, F.transform(pieces, _read_turn))


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, escaped, loss_mask``
    (``start, length`` spans of assistant texts, zero-based code points)."""
    kept = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    chats = (
        kept.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "role", "text"))).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )
    plain = chats.withColumn("formatted", F.array_join(render(F.col("turns"), escaped=False), ""))
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    tried = plain.withColumn("escaped", ~same).withColumn(
        "formatted", F.when(F.col("escaped"), F.array_join(render(F.col("turns"), escaped=True), "")).otherwise(F.col("formatted"))
    )
    round_trip = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    done = tried.withColumn(
        "formatted",
        F.when(~F.col("escaped") | round_trip, F.col("formatted")).otherwise(
            F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
        ),
    )
    opening, closing = OPENING["assistant"], CLOSING["assistant"]
    spans = F.aggregate(
        pieces_of(F.col("formatted")),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p)).alias("at"),
            F.when(
                p.startswith(opening),
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + len(opening)).alias("start"),
                            (F.length(p) - len(opening) - len(closing)).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return done.select("conv_id", "formatted", "escaped", spans.alias("loss_mask"))


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests, all read back from ``formatted`` and ``loss_mask``."""
    back = chats.select(
        "conv_id",
        "formatted",
        parse(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(
                "loss_mask",
                lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
            ),
            "",
        ).alias("loss"),
    )
    nl = F.lit("\n")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, plus conversation -1 whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(says).alias("text"),
    )
    return digests(format_chats(turns.unionByName(probe)))


def _sql() -> str:
    def wrap(text: str, role: str) -> str:
        cases = " ".join(f"WHEN x.role = '{r}' THEN '{o}' || {text} || '{CLOSING[r]}'" for r, o in OPENING.items())
        return f"CASE {cases} ELSE '{OTHER[0]}' || {role} || '{OTHER[1]}' || {text} || '{OTHER[2]}' END"

    def inner(opening: str, closing: str) -> str:
        return f"p[{len(opening) + 1} : length(p) - {len(closing)}]"

    def undo(text: str) -> str:
        return f"regexp_replace({text}, '{UNESCAPE}', '\\1\\2\\3', 'g')"

    def esc(text: str) -> str:
        return f"regexp_replace({text}, '{ESCAPE}', '\\1\\\\\\2\\3', 'g')"

    body = inner(OTHER[0], OTHER[2])
    roles = " ".join(f"WHEN starts_with(p, '{o}') THEN '{r}'" for r, o in OPENING.items())
    texts = " ".join(f"WHEN starts_with(p, '{o}') THEN {undo(inner(o, CLOSING[r]))}" for r, o in OPENING.items())
    read = f"""{{'role': CASE {roles} ELSE {undo(f"split_part({body}, '{OTHER[1]}', 1)")} END,
      'text': CASE {texts} ELSE {undo(f"({body})[instr({body}, '{OTHER[1]}') + {len(OTHER[1])} :]")} END}}"""
    return f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) AS r(t)),
chat AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns FROM src GROUP BY conv_id),
plain AS (SELECT *, list_aggregate(list_transform(turns, lambda x: {wrap("x.text", "x.role")}), 'string_agg', '') AS f0 FROM chat),
parsed AS (SELECT *, regexp_extract_all(f0, '{TURN}') AS p0 FROM plain),
judged AS (
  SELECT *, coalesce(list_aggregate(p0, 'string_agg', '') = f0 AND list_transform(p0, lambda p: {read}) = turns, false) AS same FROM parsed),
done AS (
  SELECT *, CASE WHEN same THEN f0 ELSE list_aggregate(list_transform(turns, lambda x: {wrap(esc("x.text"), esc("x.role"))}), 'string_agg', '') END AS f FROM judged),
loss AS (
  SELECT *, coalesce(list_aggregate(list_transform(list_filter(turns, lambda x: x.role = 'assistant'), lambda x: x.text), 'string_agg', ''), '') AS l FROM done)
SELECT conv_id, len(turns)::BIGINT AS n_turns,
  sha256(list_aggregate(list_transform(turns, lambda x: x.role || chr(10) || x.text || chr(10)), 'string_agg', '')) AS turns_sha256,
  length(l)::BIGINT AS loss_chars, sha256(l) AS loss_sha256, length(f)::BIGINT AS formatted_chars
FROM loss
"""


SQL = _sql()
