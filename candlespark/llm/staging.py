"""Written tables that cut lineage, in the folder that the cluster shares.

The folder is what the session names in ``spark.checkpoint.dir``. Only a local
session without that setting falls back to a folder of this machine.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of text that Spark hands to a Python worker at once; both sides hold a whole batch.
TEXT_BATCH_BYTES = 4 << 20
#: What names a row's place in the files that it is read from.
PLACE = ["__doc_file", "__doc_row"]


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and every executor can read and write, as a URI."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{LOCAL_FOLDER}"
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    _named.append(path)
    return path


#: The paths that scratch has named, for sweep.
_named: list[str] = []


def sweep(spark: SparkSession, since: int, *kept: DataFrame) -> None:
    """Delete the written tables named since ``_named`` was ``since`` long, but for what ``kept`` reads: nothing else reads them any more."""
    held = {file.rpartition("/")[0].rpartition("/")[2] for frame in kept for file in frame.inputFiles()[:1]}  # a table's files are in one folder
    for path in _named[since:]:
        if path.rpartition("/")[2] not in held:
            discard(spark, path)
    _named[since:] = [path for path in _named[since:] if path.rpartition("/")[2] in held]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done with.

    It does so when the driver's JVM collects them, which may be long after
    their disk is needed for the next shuffle.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, from the oldest; none if it isn't there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(at) if fs.exists(at) else []
    return [name for _, name in sorted((s.getModificationTime(), s.getPath().getName()) for s in found)]


def staged(df: DataFrame, name: str, codec: str | None = None, batch_bytes: int | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it from there.

    With ``batch_bytes`` its Arrow batches have about so many bytes, or one row,
    whatever the session sets; the session's own setting holds again afterwards.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.option("compression", codec) if codec else df.write
    if batch_bytes is None:
        writer.parquet(path)
    else:
        before = spark.conf.get(ARROW_BATCH)
        spark.conf.set(ARROW_BATCH, str(batch_bytes))
        try:
            writer.parquet(path)
        finally:
            spark.conf.set(ARROW_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def _place(df: DataFrame) -> list[Column]:
    meta = df.metadataColumn("_metadata")
    return [meta["file_path"].alias(PLACE[0]), meta["row_index"].alias(PLACE[1])]


def from_files(df: DataFrame) -> DataFrame:
    """df itself if it is a plain read of Parquet files, else written to such files and read again."""
    try:
        df.select(*_place(df)).schema  # noqa: B018  resolves the columns
    except AnalysisException:
        return staged(df, "documents")
    return df


def located(df: DataFrame) -> DataFrame:
    """df, read from files, with PLACE, which names a row's place in them; columns of df's own by these names are left out."""
    plain = from_files(df)
    if {c.lower() for c in plain.columns} & set(PLACE):
        plain = plain.drop(*PLACE)
    return plain.select("*", *_place(plain))


def free(df: DataFrame, name: str) -> str:
    """name, after as many underscores as it takes not to be a column of df."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def at_places(df: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """df, read from files, joined by place with ``places``, whose columns get names that are free in df."""
    plain = from_files(df)
    renamed = {c: free(plain, c) for c in places.columns}
    there = plain.select("*", *[c.alias(renamed[p]) for c, p in zip(_place(plain), PLACE, strict=True)])
    return there.join(places.withColumnsRenamed(renamed), [renamed[p] for p in PLACE], how)
