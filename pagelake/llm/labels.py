"""Labelled rows to learn from: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.session import scratch_dir, written

FOLDS = 5


def held_out(doc_id: str | Column) -> Column:
    """True for the fifth of the ids that nothing may be learnt from."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % FOLDS == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """At most ``per_class`` texts of each label 0 and 1, as ``(label, text)``.

    Rows are chosen by the hash of their id among the labels alone, so what is
    broadcast has at most ``2 * per_class`` rows; then the texts are read. Equal
    texts count once. Unlabelled, null-labelled and held-out rows are left out.
    The rows are written below the shared scratch folder, as they are read again.
    """
    own = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
    own = own.filter(F.col("id").isNotNull() & ~held_out("id"))
    part = [
        own.filter(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(per_class)
        for v in (0, 1)
    ]
    chosen = part[0].union(part[1]).dropDuplicates(["id"])
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select(
        "label", F.coalesce("text", F.lit("")).alias("text")
    )
    once = rows.dropDuplicates(["text", "label"])
    return written(once, scratch_dir(docs.sparkSession, f"sample-{label}"))
