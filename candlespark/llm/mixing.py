"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Each source is a queue of its documents in a shuffled order, then of the same
documents again, as often as a document may repeat. An entry's virtual finish
time is the tokens of its source up to and with it, divided by the source's
target. All entries are dealt into ranges of finish time, and the order is cut
where the running total of tokens passes the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlespark.llm.running import buckets_for, hex_bucket, with_running_total
from candlespark.llm.staging import PLACE, at_places, free, from_files, located, staged

#: Ranges of virtual finish time: so many to one unit, the last open-ended.
RANGES, LAST_RANGE = 4096, 4096 * 16

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """(source, rank, source_size, target) from one row (source, source_size) for each source.

    Sources by code point, null last, take the weights in turn and share
    ``share`` times all tokens. A target stops at ``repeats`` times its source's
    size; what is over goes to the others by weight. The water level at which
    none is above is found in one pass over the sources by cap / weight.
    """
    everything, by_name = Window.partitionBy(), Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.partitionBy().orderBy("ratio", "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = sizes.withColumn("rank", F.row_number().over(by_name))
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(repeats)).withColumn("ratio", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    rows = rows.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
    rows = rows.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")))
    return rows.select("source", "rank", "source_size", target.alias("target"))


def _cut_queue(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The queue with the copies taken: doc_id, size, source_size, target, rank, upto, copies, __doc_file, __doc_row."""
    at = located(docs)
    sized = at.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        "__doc_file",
        "__doc_row",
    )
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string")))
    sized = staged(sized.withColumn("key", key), "mix-sizes")
    targets = staged(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats), "mix-targets")
    n_buckets = buckets_for(sized.count())
    known = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(sized["*"], "rank", "source_size", "target").withColumn("bucket", hex_bucket(F.col("key"), n_buckets))
    order = [F.col(c) for c in ("key", "doc_id", "size", "__doc_file", "__doc_row")]
    queued = staged(with_running_total(known, "rank", "bucket", order, "size", "upto"), "mix-queue")

    def finish(copy: int):
        """Virtual finish time of the document's entry after ``copy`` passes of its source."""
        return (F.col("source_size") * copy + F.col("upto")).cast("double") / F.col("target")

    entries = queued.filter("size > 0").select("size", "rank", F.explode(F.array(*[finish(c) for c in range(repeats)])).alias("finish"))
    entries = entries.withColumn("range", F.least(F.floor(F.col("finish") * RANGES), F.lit(LAST_RANGE)))
    ranges = entries.groupBy("range").agg(F.sum("size").alias("words"))
    by_range = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    budget = targets.agg(F.lit(float(share)) * F.sum("source_size")).first()[0] or 0.0
    # one row: the range in which the budget runs out
    cut = ranges.withColumn("upto", F.sum("words").over(by_range)).filter(F.col("upto") > F.lit(budget)).orderBy("range").limit(1).first()
    if cut is None:
        copies = F.when(F.col("size") > 0, F.lit(repeats)).otherwise(0)
    else:
        last = Window.partitionBy("range").orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
        inside = entries.filter(F.col("range") == cut["range"]).withColumn("total", F.sum("size").over(last) + (cut["upto"] - cut["words"]))
        end = inside.filter(F.col("total") <= F.lit(budget)).agg(F.max(F.struct("finish", "rank")).alias("end")).first()["end"]
        start = cut["range"] / RANGES
        if end is None:
            taken = [finish(c) < F.lit(start) for c in range(repeats)]
        else:
            taken = [(finish(c) < F.lit(end["finish"])) | ((finish(c) == F.lit(end["finish"])) & (F.col("rank") <= F.lit(end["rank"]))) for c in range(repeats)]
        copies = F.when(F.col("size") > 0, sum((t.cast("int") for t in taken), F.lit(0))).otherwise(0)
    return queued.select("doc_id", "size", "source_size", "target", "rank", "upto", copies.cast("bigint").alias("copies"), "__doc_file", "__doc_row")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, __doc_file, __doc_row.

    The size of a document is its words (null: 0). It is taken whole, ``copies``
    times, from 0 to ``repeats``; ``taken`` are its words times that. The order
    comes from a hash of identifier and size, so that reruns agree; rows with
    both equal are interchangeable and ordered by their place in the files. A
    null source is a source of its own. Documents without words are never
    taken. An empty table gives no rows. Other columns are ignored.
    """
    cut = _cut_queue(docs, weights, share, repeats, id_col, text_col, source_col)
    return cut.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "__doc_file", "__doc_row")


def mix_order(docs: DataFrame, **options) -> DataFrame:
    """The taken entries in fair-queueing order: doc_id, size, copy (from 0), finish, rank, __doc_file, __doc_row.

    Sorted by finish time, then rank, over range partitions; the options are
    those of mix_sources.
    """
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    entries = _cut_queue(docs, **options).filter("copies > 0").select("*", copy)
    finish = (F.col("source_size") * F.col("copy") + F.col("upto")).cast("double") / F.col("target")
    return entries.select("doc_id", "size", "copy", finish.alias("finish"), "rank", "__doc_file", "__doc_row").orderBy("finish", "rank")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with all its columns."""
    docs = from_files(docs)
    chosen = staged(mix_sources(docs, **options).filter("copies > 0").select(*PLACE, "copies"), "mix-chosen")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(free(docs, "copies"))))
    return at_places(docs, chosen, "inner").select(*docs.columns, copies.alias(free(docs, "copy"))).select(*docs.columns)


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), keyed AS (
  SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)) AS key FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, source_size * 2 AS cap FROM sources
), leveled AS (
  SELECT *, cap / weight AS ratio, CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS BIGINT) AS budget FROM weighed
), levels AS (
  SELECT *, (budget - CAST(coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
    / sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM leveled
), targets AS (
  SELECT source, rank, source_size, budget,
    least(weight * (SELECT level FROM levels l WHERE l.level <= l.ratio ORDER BY ratio, rank LIMIT 1), CAST(cap AS DOUBLE)) AS target FROM levels
), queue AS (
  SELECT k.doc_id, k.size, k.key, t.source_size, t.target, t.rank, t.budget,
    sum(k.size) OVER (PARTITION BY t.rank ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
), entries AS (
  SELECT *, CAST(CAST(source_size * pass + upto AS BIGINT) AS DOUBLE) / target AS finish FROM queue, (VALUES (0), (1)) p(pass) WHERE size > 0
), ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) AS total FROM entries
), counted AS (
  SELECT doc_id, count(*) AS copies FROM ordered WHERE total <= budget GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(c.copies, 0) AS taken FROM queue q LEFT JOIN counted c ON q.doc_id = c.doc_id
"""
