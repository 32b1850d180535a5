"""The training-data pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read back as the next stage's ``docs``. All but the last
return the columns of ``documents``; rows and texts only ever go, or get shorter,
by a stage's decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.decontaminate import stage_decontaminate
from starloom.llm.jaccard import stage_jaccard
from starloom.llm.langid import stage_language_id
from starloom.llm.linededup import stage_line_dedup
from starloom.llm.pieces import stage_sentencepiece
from starloom.llm.scratch import stored

STAGES = [
    ("language_id", stage_language_id),
    ("line_dedup", stage_line_dedup),
    ("jaccard_join", stage_jaccard),
    ("decontaminate", stage_decontaminate),
    ("sentencepiece", stage_sentencepiece),
]

#: Models, and the iterative components of links, have no SQL; the tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


__all__ = ["STAGES", "ORACLE_SQL", "run"]
