"""The corpus pipeline: what is left of the documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps. Stages but the
last return the columns of ``docs``; other columns pass through unchanged. A row with
a null id is judged by its text alone and never deduplicated. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import decontaminate, jaccard, linededup, pieces, toxicity
from pagelake.session import scratch_dir, written

REJECT = 0.5  # toxicity score from which on a document goes


def _new(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``REJECT``."""
    score = _new(docs, "_score")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_score(docs, model, out=score)
    return scored.filter(F.col(score) < REJECT).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines and of long single lines.
    A document that is such copies as a whole goes. ``n_chars``, if there, is that of the
    text that is left.
    """
    n, gone = _new(docs, "_n"), _new(docs, "_gone")
    out = linededup.dedup_lines(
        docs, n_lines=n, n_deleted=gone, long_words=linededup.LONG_WORDS
    )
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, changed).otherwise(F.col("n_chars")))
    emptied = (F.col(gone) > 0) & (F.col("text") == "")
    return out.filter(~F.coalesce(emptied, F.lit(False))).drop(n, gone)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; of rows
    with one id, one.
    """
    found = jaccard.near_duplicates(docs.select("doc_id", "text"))
    first = found.groupBy("doc_id").agg(F.min("component_id").alias("c"))
    kept = first.filter("c = doc_id").select("doc_id")
    named = docs.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    single = named.dropDuplicates(["doc_id"])
    return single.unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item's window occurs."""
    return decontaminate.drop_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids, and whether these spell the text again."""
    ids, exact, decoded = (_new(docs, x) for x in ("ids", "exact", "_decoded"))
    coded = pieces.with_text(pieces.with_ids(docs, ids), decoded, ids)
    return coded.withColumn(exact, F.col(decoded).eqNullSafe(F.col("text"))).drop(decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

# A trained score and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages leave of the documents. Each stage's rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), scratch_dir(spark, name))
    return docs


QUERIES = {"pipeline": run}
