"""Tables on a file system: candles, the trade log, dead letters, checkpoints.

A table is a list of folders for each of its partitions, which a manifest names.
A commit writes new folders for the partitions that it changes, whole, and then a
manifest of the next number; a reader sees all of a commit or nothing of it, and
the work follows what changes, not what is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from candlespark.operators.dedup import KEY, not_in_log
from candlespark.operators.merge import guarded_upsert, overwrite
from candlespark.schemas import CANDLE, CANDLE_KEY, TRADE

DAY_MS, WEEK_MS = 86_400_000, 604_800_000
TRADE_RETENTION_DAYS = 7
CHECKPOINT = StructType([StructField("symbol", StringType()), StructField("watermark", LongType())])
LETTER = StructType([StructField(c, StringType()) for c in ("source", "reason", "payload", "detail", "stage", "at")])
SCHEMAS = {"candles": CANDLE, "trades": TRADE, "dead_letters": LETTER, "checkpoints": CHECKPOINT}
#: What sorts a partition's rows, so that files are pruned by their statistics.
ORDER = {"candles": ["symbol", "time"], "trades": ["symbol", "ts_ms"], "dead_letters": ["source", "at"]}


def parts_of(table: str) -> dict[str, Column]:
    """The columns that a table is partitioned by: candles by timeframe and week, trades by day, dead letters by reason."""
    week, day = F.floor(F.col("time") / WEEK_MS), F.floor(F.col("ts_ms") / DAY_MS)
    return {"candles": {"p_tf": F.col("tf"), "p_week": week}, "trades": {"p_day": day}, "dead_letters": {"p_reason": F.col("reason")}}.get(table, {})


@dataclass
class Changes:
    """What a commit does: folders that replace partitions, folders that are added, partitions that go."""

    replaced: dict[str, DataFrame] = field(default_factory=dict)
    added: dict[str, DataFrame] = field(default_factory=dict)
    dropped: dict[str, list[str]] = field(default_factory=dict)


class Store:
    """The tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.known = spark, root.rstrip("/"), -1
        self.migrate()

    # folders and manifests
    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, path: str) -> list[str]:
        return sorted(status.getPath().getName() for status in self._fs().listStatus(self._path(path)))

    def migrate(self) -> None:
        """Make the layout; again is no harm."""
        self._fs().mkdirs(self._path("versions"))
        found = [int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json") and not n.startswith(".")]
        self.known = max(found, default=-1)

    def manifest(self) -> dict:
        """The last one; from the last that was seen it looks ahead, so old ones cost nothing."""
        while self._fs().exists(self._path(f"versions/{self.known + 1}.json")):
            self.known += 1
        if self.known < 0:
            return {"version": -1, "batch": -1, "tables": {}}
        return json.loads(self.spark.read.text(f"{self.root}/versions/{self.known}.json", wholetext=True).first()[0])

    def _written(self, table: str, rows: DataFrame, folder: str) -> dict[str, str]:
        """Write rows to a folder of their own; the folder of each partition."""
        parts = parts_of(table)
        for name, value in parts.items():
            rows = rows.withColumn(name, value)
        if parts:
            rows = rows.repartition(*parts, *ORDER[table][:1]).sortWithinPartitions(*parts, *ORDER[table])
        rows.write.partitionBy(*parts).option("compression", "zstd").parquet(f"{self.root}/{folder}")
        found = [""]
        for _ in parts:
            found = [f"{at}/{name}" for at in found for name in self._names(folder + at) if "=" in name]
        return {at.strip("/"): folder + at for at in found}

    def commit(self, changes: Changes, batch: int | None = None) -> bool:
        """Make the changes, all at once; a batch that has been committed is passed over.

        A replaced table's frame holds the whole of every partition that it has
        rows for. A manifest's number is taken by moving its file there, which
        fails for the second of two writers.
        """
        now = self.manifest()
        if batch is not None and batch <= now["batch"]:
            return False
        version, tables = now["version"] + 1, {name: dict(parts) for name, parts in now["tables"].items()}
        own = f"{version}-{uuid.uuid4().hex[:12]}"  # of two writers of a version neither writes over the other
        for name, parts in changes.dropped.items():
            tables[name] = {part: folders for part, folders in tables.get(name, {}).items() if part not in parts}
        for name, rows in changes.replaced.items():
            tables.setdefault(name, {}).update({part: [folder] for part, folder in self._written(name, rows, f"{name}/v{own}").items()})
        for name, rows in changes.added.items():
            held = tables.setdefault(name, {})
            for part, folder in self._written(name, rows, f"{name}/a{own}").items():
                held[part] = [*held.get(part, []), folder]
        text = json.dumps({"version": version, "batch": batch if batch is not None else now["batch"], "tables": tables})
        temporary, final = self._path(f"versions/.{version}.tmp"), self._path(f"versions/{version}.json")
        out = self._fs().create(temporary, True)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs().exists(final) or not self._fs().rename(temporary, final):
            raise RuntimeError(f"version {version} was committed by another writer")
        return True

    def read(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or those of its partitions."""
        held = self.manifest()["tables"].get(table, {})
        wanted = held if parts is None else [p for p in parts if p in held]
        folders = [f"{self.root}/{folder}" for part in wanted for folder in held[part]]
        schema = SCHEMAS[table]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def touched(self, table: str, rows: DataFrame) -> list[str]:
        """The partitions that rows fall into: as many as the rows span weeks or days."""
        parts = parts_of(table)
        found = rows.select(*[value.cast("string").alias(name) for name, value in parts.items()]).distinct().collect()
        return ["/".join(f"{name}={value}" for name, value in zip(parts, r, strict=True)) for r in found]

    # the tables
    def candles(self, tf: str | None = None, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
        """Candles; of one timeframe and of the weeks of [start, end) if given."""

        def wanted(part: str) -> bool:
            of, week = (p.partition("=")[2] for p in part.split("/"))
            return (tf is None or of == tf) and (start_ms is None or (int(week) + 1) * WEEK_MS > start_ms) and (end_ms is None or int(week) * WEEK_MS < end_ms)

        return self.read("candles", [p for p in self.manifest()["tables"].get("candles", {}) if wanted(p)])

    def trades(self) -> DataFrame:
        return self.read("trades")

    def dead_letters(self) -> DataFrame:
        return self.read("dead_letters")

    def watermarks(self, symbols: Sequence[str] | None = None) -> DataFrame:
        marks = self.read("checkpoints")
        return marks if symbols is None else marks.filter(F.col("symbol").isin(*symbols))

    def not_logged(self, trades: DataFrame) -> DataFrame:
        """Trades that the log doesn't hold, each once. A trade's copies have its time, so the log is read for their days alone."""
        return not_in_log(trades, self.read("trades", self.touched("trades", trades)), KEY).select(*TRADE.fieldNames())

    def apply(self, *, candles: DataFrame | None = None, trades: DataFrame | None = None, letters: DataFrame | None = None, marks: DataFrame | None = None, order: str = "seq", batch: int | None = None) -> bool:
        """One commit: candle snapshots (guarded, in ``order``), trades that aren't logged, dead letters, watermarks."""
        if batch is not None and batch <= self.manifest()["batch"]:
            return False
        changes = Changes()
        if candles is not None:
            changes.replaced["candles"] = guarded_upsert(self.read("candles", self.touched("candles", candles)), candles, order)
        if trades is not None:
            changes.added["trades"] = self.not_logged(trades)
        if letters is not None:
            at = F.col("at") if "at" in letters.columns else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
            changes.added["dead_letters"] = letters.withColumn("at", at).select(*LETTER.fieldNames())
        if marks is not None:
            changes.replaced["checkpoints"] = self.watermarks().join(marks, "symbol", "left_anti").unionByName(marks.select("symbol", "watermark"))
        return self.commit(changes, batch)

    def insert_trades(self, batch: DataFrame) -> DataFrame:
        """Add the trades that the log doesn't hold; what was added."""
        self.commit(Changes(added={"trades": self.not_logged(batch)}))
        last = f"trades/a{self.manifest()['version']}-"
        folders = [f"{self.root}/{f}" for held in self.manifest()["tables"]["trades"].values() for f in held if f.startswith(last)]
        return self.spark.read.schema(TRADE).parquet(*folders) if folders else self.spark.createDataFrame([], TRADE)

    def upsert_candles(self, changes: DataFrame, order: str = "seq") -> None:
        self.apply(candles=changes, order=order)

    def put_candles(self, rows: DataFrame) -> None:
        """Write candles over those of the same key."""
        rows = rows.select(*CANDLE.fieldNames())
        self.commit(Changes(replaced={"candles": overwrite(self.read("candles", self.touched("candles", rows)), rows, CANDLE_KEY)}))

    def save_watermarks(self, marks: DataFrame) -> None:
        self.apply(marks=marks)

    # upkeep
    def prune(self, now_ms: int, days: int = TRADE_RETENTION_DAYS) -> None:
        """Drop the trades of days that ended before the retention: their folders go from the manifest, no row is read."""
        held = self.manifest()["tables"].get("trades", {})
        self.commit(Changes(dropped={"trades": [p for p in held if (int(p.partition("=")[2]) + 1) * DAY_MS <= now_ms - days * DAY_MS]}))

    def compact(self, table: str, most: int = 8) -> None:
        """Write partitions that lie in more than ``most`` folders anew, each in one."""
        many = [part for part, folders in self.manifest()["tables"].get(table, {}).items() if len(folders) > most]
        if many:
            self.commit(Changes(replaced={table: self.read(table, many)}))

    def vacuum(self) -> list[str]:
        """Delete what the last manifest doesn't name, older manifests too; not while others read or write."""
        now = self.manifest()
        kept = {folder for parts in now["tables"].values() for folders in parts.values() for folder in folders}
        gone = []

        def sweep(at: str) -> None:
            if at in kept:
                return
            if any(folder.startswith(f"{at}/") for folder in kept):
                for name in self._names(at):
                    if "=" in name:
                        sweep(f"{at}/{name}")
                return
            self._fs().delete(self._path(at), True)
            gone.append(at)

        for table in SCHEMAS:
            if self._fs().exists(self._path(table)):
                for name in self._names(table):
                    sweep(f"{table}/{name}")
        for name in self._names("versions"):
            if name.endswith(".json") and int(name.removesuffix(".json")) < now["version"]:
                self._fs().delete(self._path(f"versions/{name}"), False)
        return gone


def retained(trades: DataFrame, now_ms: int, days: int = TRADE_RETENTION_DAYS) -> DataFrame:
    """Trades of days that hadn't ended ``days`` ago: whole days go, as partitions do."""
    return trades.filter((F.floor(F.col("ts_ms") / DAY_MS) + 1) * DAY_MS > now_ms - days * DAY_MS)
