"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written and reread as the next one's ``docs``.
All but the last return the columns of ``documents``.

Defined cases beside those of the operators: a document that line dedup leaves
without any line goes (its text is elsewhere in the corpus, line by line); one
that had no line to begin with stays; ``n_chars`` follows a changed text; rows
that repeat an id stay or go together in near-dedup, and rows without an id stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.adaptive_quality import quality_filter
from tillroll.llm.common import table, written
from tillroll.llm.line_edit_join import dedup_lines
from tillroll.llm.minhash_forest import near_duplicates
from tillroll.llm.packing import digests, pack
from tillroll.llm.temperature_mix import mix


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed and the adaptive rules."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier in the corpus."""
    cut = dedup_lines(docs).filter("n_removed = 0 or n_removed < n_lines")
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and ordered by the temperature mix of their sources."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row each."""
    return digests(pack(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Edit distances over lines, MinHash groups and tokenizing cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
