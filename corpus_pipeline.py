"""The corpus pipeline: quality rules, near duplicates, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as the
next stage's documents. All stages but the last return the columns of ``documents``.

A stage begins when the one before is written, so it first gives back what that one left: its scratch tables, and the
shuffle files of finished jobs. A stage's own scratch has to stay until its result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import mixing, near_duplicates, packing, quality, substrings
from depotlens.llm.names import keeps_columns
from depotlens.llm.queries import documents, tokenizer_path
from depotlens.llm.storage import drop_written, release_shuffles
from depotlens.session import drop_paths, materialize, recorded_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch of the last stage begun, per application.
_SCRATCH: dict[str, list[str]] = {}


def stage(first: bool = False) -> Callable[[Stage], Stage]:
    """A stage that gives back its predecessor's scratch; the first one leaves earlier runs alone."""

    def tidy(work: Stage) -> Stage:
        @wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            app = spark.sparkContext.applicationId
            if not first:
                drop_paths(spark, _SCRATCH.get(app, []))
                release_shuffles(spark)
            with recorded_scratch() as made:
                out = work(spark, docs, sf_dir)
            _SCRATCH[app] = made
            return out

        return run_stage

    return tidy


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with ``n_chars`` of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


@stage(first=True)
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.judge(docs).where("kept").select(*(F.col(f"`{c}`") for c in docs.columns))


@stage()
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8) stays, and all without words.

    Groups are found over row numbers, so repeated, shared and missing ids are no obstacle. The row with the
    smallest doc_id stays, the first of them if several have it; a null comes last.
    """
    return _one_of_each(docs)


@keeps_columns(("doc_id", "text"), ())
def _one_of_each(docs: DataFrame) -> DataFrame:
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    numbered = rows.select(F.col("_row").alias("doc_id"), "text", F.col("doc_id").alias("_named"))
    found = near_duplicates.near_duplicates(numbered)
    first = F.min(F.struct(F.isnull("_named"), "_named", F.col("doc_id").alias("_row"))).alias("first")
    first = found.groupBy("component_id").agg(first).select("first._row")
    return rows.join(first, "_row", "left_semi").select(*docs.columns)


@stage()
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again anywhere are cut out; every document stays."""
    return _counted(substrings.remove_repeats(docs), docs.columns)


@stage()
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source's words come to its target: documents are left out or repeated, one per source is cut."""
    mixed, _ = mixing.mix(docs)
    return _counted(mixing.repeat_taken(mixed), docs.columns)


@stage()
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the encoded documents and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("source mix", mix_sources),
    ("packing", pack),
]

#: MinHash, shared passages and token ids have no SQL form; a brute-force version stands in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for number, (_, work) in enumerate(STAGES, 1):
        docs = materialize(work(spark, docs, sf_dir), f"stage-{number}")
        if before is not None:
            drop_written(before)  # the stage behind it is written
        before = docs
    return docs
