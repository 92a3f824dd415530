"""Exact deduplication by a stateful stream (DataFrame operations only).

The stream keeps, for each content digest ever seen and without expiry, the
identifier and the content locator (file and row) of the document that stays,
the locator of the first that was seen, and how many there were. The state lives
in RocksDB on the executors' disks and in a folder that may outlive the call:
documents of a later call then meet those of earlier ones. On a hit the full
normalised bytes decide: a digest under which different texts met is resolved by
the texts themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark.llm.staging import PLACE, at_places, discard, from_files, located, names, scratch, staged

WHITE_SPACE = r"[\x20\x09-\x0D]+"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def best() -> Column:
    """The least of these stays: most code points, smallest identifier (null last), first place."""
    return F.struct((-F.col("n_chars")).alias("less_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("__doc_file").alias("file"), F.col("__doc_row").alias("row"))


STATE = "digest binary, keeper struct<less_chars: bigint, no_id: boolean, doc_id: bigint, file: string, row: bigint>, witness struct<turn: bigint, file: string, row: bigint>, n bigint"


def stateful_keepers(spark: SparkSession, stream: DataFrame, root: str) -> DataFrame:
    """Run a stream of digest rows to its end; the STATE of each digest that it changed, or of all if it changed none.

    Each micro-batch writes the keys it changed to a folder of its own, so that a
    batch that is run again replaces what it wrote.
    """
    batches: list[int] = []

    def write(frame: DataFrame, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{root}/updates/batch={batch}")
        batches.append(batch)

    witness = F.min(F.struct("turn", F.col("__doc_file").alias("file"), F.col("__doc_row").alias("row"))).alias("witness")
    changed = stream.groupBy("digest").agg(F.min(best()).alias("keeper"), witness, F.count(F.lit(1)).alias("n"))
    query = changed.writeStream.outputMode("update").option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    found = sorted(set(batches)) or sorted(int(name.partition("=")[2]) for name in names(spark, f"{root}/updates") if name.startswith("batch="))
    if not found:
        return spark.createDataFrame([], STATE)
    numbered = [spark.read.schema(STATE).parquet(f"{root}/updates/batch={b}").withColumn("_batch", F.lit(b)) for b in found]
    states = numbered[0]
    for more in numbered[1:]:
        states = states.unionByName(more)
    if len(numbered) > 1:  # a key's last change is its state
        states = states.groupBy("digest").agg(F.max_by(F.struct("keeper", "witness", "n"), "_batch").alias("last")).select("digest", "last.*")
    return states.select("digest", "keeper", "witness", "n")


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, whose streams keep their state in RocksDB."""
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a store reserves megabytes on disk otherwise, however little it holds
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return session


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    digest: Callable[[Column], Column] = sha256,
    bytes_per_batch: int = 32 << 30,
    state: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, __doc_file, __doc_row.

    Texts are equal when they are identical without ASCII white space. Of equal
    texts the one with the most code points stays, then the smallest identifier
    (null last), then the first in file order: of repeated rows one is kept. A
    null text is an empty one; an empty table gives no rows. Other columns are
    ignored, whatever their names.

    Parameters
    ----------
    digest
        What keys the state. Two texts with one digest are told apart by their bytes.
    bytes_per_batch
        Bytes of digest rows in a micro-batch; bounds what a batch shuffles.
    state
        A folder that keeps what was seen, for ever; without one it goes with
        the session. Documents then also meet those of earlier calls, whose
        files must still be there: keep_id may name one of them, kept says which
        of these documents stay now, and group_size counts all.
    run
        Names the documents of this call. A call with a name that the state
        knows counts nothing again, as after a crash.
    """
    spark = docs.sparkSession
    root = state.rstrip("/") if state else scratch(spark, "dedup-state")
    source = located(docs if {id_col, text_col} == {"doc_id", "text"} else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    texts = source.select("doc_id", "__doc_file", "__doc_row", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"), normalised(F.col("text")).alias("norm"))
    known = names(spark, f"{root}/digests")
    run = run or uuid.uuid4().hex
    turn = known.index(run) if run in known else len(known)
    own = f"{root}/digests/{run}"
    digests = texts.select("doc_id", "__doc_file", "__doc_row", "n_chars", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("sha"), F.lit(turn).cast("bigint").alias("turn"))
    if "_SUCCESS" not in names(spark, own):
        digests.write.mode("overwrite").parquet(own)
    rows = spark.read.schema(digests.schema).parquet(own)
    stream = streaming_session(spark).readStream.schema(rows.schema).option("maxBytesPerTrigger", str(bytes_per_batch)).option("recursiveFileLookup", "true").parquet(f"{root}/digests")
    states = stateful_keepers(spark, stream, root)
    many = staged(states.filter("n > 1"), "dedup-hits")
    decided = rows.drop("turn").join(many.drop("witness"), "digest", "left").select(*rows.drop("turn").columns, "keeper", "n")
    # the bytes of all texts under a digest are equal when the least and the greatest are
    held = scratch(spark, "dedup-texts")
    texts.withColumn("digest", digest(F.col("norm"))).join(many.select("digest").hint("merge"), "digest").select("digest", "norm").write.parquet(held)
    hits = spark.read.schema("digest binary, norm string").parquet(held)
    if state:
        hits = hits.unionByName(earlier_texts(many, turn, text_col))
    clashes = staged(hits.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("most")).filter("least != most").select("digest"), "dedup-clashes")
    discard(spark, held)
    if not clashes.isEmpty():
        if state:
            raise ValueError("texts with one digest differ, and those of earlier calls can't be grouped anew; use another digest")
        odd = staged(texts.withColumn("digest", digest(F.col("norm"))).join(clashes, "digest").withColumn("sha", F.sha2("norm", 256)), "dedup-odd")
        groups = odd.groupBy("digest", "norm").agg(F.min(best()).alias("keeper"), F.count(F.lit(1)).alias("n"))
        apart = odd.join(groups, ["digest", "norm"]).select(*decided.columns)
        decided = decided.join(clashes, "digest", "left_anti").select(*decided.columns).unionByName(apart)
    alone = F.col("keeper").isNull()
    return decided.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | ((F.col("keeper.file") == F.col("__doc_file")) & (F.col("keeper.row") == F.col("__doc_row")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "__doc_file",
        "__doc_row",
    )


def earlier_texts(hits: DataFrame, turn: int, text_col: str) -> DataFrame:
    """(digest, norm) of the first document of each digest that an earlier call saw, from where it lies."""
    spark = hits.sparkSession
    seen = hits.filter(F.col("witness.turn") < turn).select("digest", F.col("witness.file").alias("__doc_file"), F.col("witness.row").alias("__doc_row"))
    files = [r[0] for r in seen.select("__doc_file").distinct().collect()]  # at most the files of earlier calls
    if not files:
        return spark.createDataFrame([], "digest binary, norm string")
    there = located(spark.read.parquet(*files)).select("__doc_file", "__doc_row", normalised(F.col(text_col)).alias("norm"))
    return there.join(seen, ["__doc_file", "__doc_row"]).select("digest", "norm")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; nulls, ties, repeated rows and empty tables as in exact_dedup."""
    docs = from_files(docs)
    dropped = staged(exact_dedup(docs, id_col, text_col).filter("not kept").select(*PLACE), "dedup-dropped")
    return at_places(docs, dropped, "left_anti").select(*docs.columns)
