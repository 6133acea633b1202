"""Line dedup: a suffix array over line numbers by prefix doubling, in SQL alone.

Every line gets the rank of its content among the lines that occur twice or more; a
line that occurs once can be in no repeated run and leaves the table. Then ranks of
blocks double: a block of ``2k`` lines is the pair of ranks of its two halves, pairs
that occur once leave, and the others are ranked in the order of the pairs. So after
each round, suffixes that start with the same block stand together under one rank, an
interval of the suffix array whose members have at least that many lines in common.
Rounds end when no interval has two members; their number is the logarithm of the
longest repeated run.

The first member of an interval, by document and line, is the original. Every later
member marks its block as a later copy. The marks of a document overlap to its maximal
repeated runs, and these lines are deleted.

Ranks come from sorted ranges of *distinct* pairs, so a line that a third of all
documents share is one row there; counts are combined before the shuffle, and the
join back is on a key whose other side has one row. Each round's table is written.

A run is judged by its lines: ``min_lines`` or more. With ``long_words``, one line of
that many words or more is a run as well, whatever stands around it.

Lines are compared without spaces at their ends, and blank lines take no part. Lines
are known by two 64-bit hashes. Defined cases: a null text has no lines and stays
null; a text without deletions stays as it is, one with deletions becomes its kept
lines that are not blank, apart by a line feed; rows that are repeated exactly get the
same deletions, and do not count as copies of one another; rows with a null id come
back unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.session import scratch_dir, written

MIN_LINES = 2  # a run of fewer lines is not a repeated run
LONG_WORDS = 50  # words from which on one line may count as a run
KEY = ["doc", "t"]


def _lines(text: Column) -> Column:
    return F.filter(
        F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != ""
    )


def _ranked(rows: DataFrame, pair: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc, t, pos, rank, later, *keep)`` of the rows whose pair occurs twice or more.

    ``rank`` follows the order of the pairs; ``later`` tells that an earlier row has
    the same pair.
    """
    spark = rows.sparkSession
    place = F.struct("doc", "t", "pos")
    pairs = (
        rows.groupBy(*pair)
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
    )
    # Distinct pairs in range partitions: ids grow from partition to partition.
    ordered = pairs.repartitionByRange(*pair).sortWithinPartitions(*pair)
    ranks = written(
        ordered.select(*pair, "first", F.monotonically_increasing_id().alias("rank")),
        scratch_dir(spark, "ranks"),
    )
    found = rows.join(ranks, pair).select(
        *KEY, "pos", "rank", (place > F.col("first")).alias("later"), *keep
    )
    return written(found, scratch_dir(spark, "suffixes"))


def _place(rows: DataFrame, size: int) -> DataFrame:
    return rows.select(*KEY, "pos", F.lit(size).cast("int").alias("size"))


def repeated_blocks(
    docs: DataFrame, min_lines: int = MIN_LINES, long_words: int | None = None
) -> DataFrame:
    """``(doc, t, pos, size)``: the ``size`` lines from ``pos`` are a later copy.

    ``docs`` has ``doc``, ``t`` and an array ``lines``, and one row for each key.
    """
    each = docs.select(*KEY, F.posexplode("lines").alias("pos", "line"))
    named = each.select(
        *KEY,
        "pos",
        F.xxhash64("line").alias("a"),
        F.xxhash64(F.concat("line", F.lit("\x01"))).alias("b"),
        *(["line"] if long_words is not None else []),
    )
    keep = ()
    if long_words is not None:
        words = F.filter(F.split("line", r"\s+"), lambda w: w != "")
        named = named.withColumn("long", F.size(words) >= long_words).drop("line")
        keep = ("long",)
    now, size, marks = _ranked(named, ["a", "b"], keep), 1, []
    if keep:
        marks.append(_place(now.filter("later AND long"), 1))
        now = now.drop("long")
    while True:
        if size >= min_lines:
            marks.append(_place(now.filter("later"), size))
        if now.isEmpty():
            break
        step = min(size, min_lines - size) if size < min_lines else size
        right = now.select(*KEY, (F.col("pos") - step).alias("pos"), F.col("rank").alias("b"))
        both = now.withColumnRenamed("rank", "a").drop("later").join(right, [*KEY, "pos"])
        now, size = _ranked(both, ["a", "b"]), size + step
    out = marks[0] if marks else _place(now, 0)
    for more in marks[1:]:
        out = out.union(more)
    return out.groupBy(*KEY, "pos").agg(F.max("size").alias("size"))


def merged_runs(blocks: DataFrame) -> DataFrame:
    """``(doc, t, start, stop)``: blocks that overlap or touch, as one run of lines.

    A document has no more runs than lines, whatever the number of its blocks.
    """
    stop = F.col("pos") + F.col("size")
    in_order = Window.partitionBy(*KEY).orderBy("pos")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(stop).over(before)
    begins = F.coalesce(F.col("pos") > reach, F.lit(True)).cast("int")
    runs = blocks.filter("size > 0").withColumn("begins", begins)
    runs = runs.withColumn("run", F.sum("begins").over(in_order))
    return runs.groupBy(*KEY, "run").agg(
        F.min("pos").alias("start"), F.max(stop).alias("stop")
    ).drop("run")


def dedup_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_lines: int = MIN_LINES,
    n_lines: str = "n_lines",
    n_deleted: str = "n_deleted",
    long_words: int | None = None,
) -> DataFrame:
    """``docs`` with later copies of repeated runs of lines deleted from ``text``, and
    the columns ``n_lines`` and ``n_deleted``. Clashing names raise ``ValueError``.
    """
    clash = {n_lines, n_deleted} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist")
    own = docs.select(
        F.col(id).cast("bigint").alias("doc"),
        F.xxhash64(text).alias("t"),
        F.struct(*docs.columns).alias("row"),
    )
    body = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    once = own.filter("doc IS NOT NULL").select(*KEY, _lines(body).alias("lines"))
    blocks = repeated_blocks(once.dropDuplicates(KEY), min_lines, long_words)
    gone = merged_runs(blocks).groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"),
        F.sum(F.col("stop") - F.col("start")).alias("n_gone"),
    )
    joined = own.join(gone, KEY, "left").withColumn("lines", _lines(body))
    n = F.size("lines")
    # What stands before each deleted run, and after the last one.
    n_runs = F.size("gone")
    stay = F.transform(
        F.sequence(F.lit(0), n_runs),
        lambda k: F.struct(
            F.when(k == 0, 0).otherwise(F.get("gone", k - 1)["stop"]).alias("start"),
            F.when(k == n_runs, n).otherwise(F.get("gone", k)["start"]).alias("stop"),
        ),
    )
    parts = F.transform("stay", lambda s: F.slice("lines", s["start"] + 1, s["stop"] - s["start"]))
    kept = joined.withColumn("stay", stay).select(
        *(
            F.when(F.col("gone").isNull(), F.col(f"row.{c}"))
            .otherwise(F.array_join(F.flatten(parts), "\n"))
            .alias(c)
            if c == text
            else F.col(f"row.{c}").alias(c)
            for c in docs.columns
        ),
        n.cast("bigint").alias(n_lines),
        F.coalesce("n_gone", F.lit(0)).cast("bigint").alias(n_deleted),
    )
    return kept
