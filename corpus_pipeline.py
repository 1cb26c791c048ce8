"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. ``toxicity`` drops the documents that the string-kernel SVM rejects.
2. ``near_duplicates`` keeps one document of each class of linked documents.
3. ``decontamination`` drops the documents that hold a benchmark window.
4. ``mixing`` repeats or leaves out documents to meet the sources' targets.
5. ``sharding`` adds shard and slot, equal texts together.

Every stage works on all rows it is given, with null or empty texts too (they
score the base rate of no words, link to none, hold no benchmark window, have
size 0 in the mix and a shard); columns other than those a stage needs, and
names that clash with a stage's own, pass through.  An empty input gives an
empty output at every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadwright.llm.common import materialise, table  # noqa: E402
from loadwright.llm.op5_decontaminate import decontaminate  # noqa: E402
from loadwright.llm.op7_toxicity import THRESHOLD, fit_model, toxicity  # noqa: E402
from loadwright.llm.op8_mixing import mix  # noqa: E402
from loadwright.llm.op9_jaccard import drop_near_duplicates  # noqa: E402
from loadwright.llm.op10_sharding import shard_documents  # noqa: E402


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity(docs, model, "__toxicity")
    return scored.where(scored["__toxicity"] < THRESHOLD).select(*docs.columns)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def stage_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("mixing", stage_mixing),
    ("sharding", stage_sharding),
]

# A trained model decides the first stage, so no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
