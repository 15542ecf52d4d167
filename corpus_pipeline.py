"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

A stage's result must be written before the next stage is called, which deletes the
intermediate tables of the one before it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._store import clear, materialise, own_folder, table, written
from tidemark.llm.decontamination import contaminated
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.mixing import deal_shards, mix_sources
from tidemark.llm.quality_rules import fit_field, judge_quality
from tidemark.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Intermediate tables of the stage that was called last.
_left: list[str] = []


def _stage(function):
    """A stage that first deletes what the one before it left: by then that one's result has been written."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear(_left)
        before = set(written())
        out = function(spark, docs, sf_dir)
        _left[:] = [path for path in written() if path not in before]
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality verdict is to keep them.

    A null or empty text has no words and goes. Each row is judged by its text alone, whatever its
    doc_id (null and repeated ones stay as they are); an empty table gives an empty result; further columns are not passed on.
    """
    field = fit_field(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, field, COLUMNS).where("kept").select(*COLUMNS)


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic.

    A null or empty text is not toxic and stays. Each row is scored by its text alone, whatever its
    doc_id; an empty table gives an empty result; further columns are not passed on.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, COLUMNS).where("predicted = 0").select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a written ``row_id``, which is never null and never repeats."""
    return materialise(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_id")), "numbered")


def _as_documents(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("row_id").alias("doc_id"), "text")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest doc_id (null last), of equal ones the first row.

    Rows are told apart by a written row id, so doc_ids may be null or repeat. Texts without words
    are near nothing and all stay; an empty table gives an empty result.
    """
    rows = _numbered(docs)
    groups = jaccard_components(_as_documents(rows)).select(F.col("doc_id").alias("row_id"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    kept = rows.select("row_id", "doc_id").join(groups, "row_id").groupBy("component_id").agg(F.min(order).getField("row_id").alias("row_id"))
    return rows.join(kept.select("row_id"), "row_id", "left_semi").select(*COLUMNS)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, cut off or whole.

    Rows are told apart by a written row id, so doc_ids may be null or repeat. Texts without words
    hold no passage and stay; an empty table, of documents or of items, takes nothing away.
    """
    rows = _numbered(docs)
    leaks = contaminated(_as_documents(rows), table(spark, sf_dir, "benchmark"), short=True).select(F.col("doc_id").alias("row_id")).distinct()
    return rows.join(leaks, "row_id", "left_anti").select(*COLUMNS)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix draws, dealt into shuffled shards: the documents' columns with ``size``, ``source_size``, ``target``, ``shard``, ``taken`` (words of this copy) and ``place``.

    A null source is a source of its own; a document without words is never drawn; repeated rows
    are drawn as documents of their own; an empty table gives an empty result.
    """
    return deal_shards(mix_sources(docs, COLUMNS))


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

#: Trained models and a drawn mix have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage wrote for itself, and the result it started from, are deleted once its own is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        result = own_folder(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(result)
        clear(_left)
        clear(before)
        docs, before = spark.read.parquet(result), [result]
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
