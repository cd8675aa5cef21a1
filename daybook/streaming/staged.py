"""Staging from a stream: the latest record per date and key, and the four files of each date as it closes."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import fields as fx
from daybook.operators.staging import staging_latest
from daybook.sources import files
from daybook.sources.buckets import BucketVersions

BUCKETS = 16


class StagingStream:
    """The latest full record per batch date and key; use ``on_batch`` with ``foreachBatch``.

    The table is kept in buckets of (date, key) and a micro-batch rewrites those it touches. Version n follows the
    newest one before n and replaces what an earlier try of batch n wrote, so a batch run again changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], order: list[str], buckets: int = BUCKETS):
        self.spark, self.keys, self.order, self.columns = spark, keys, order, schema.names
        self.table = BucketVersions(spark, folder, schema, ["batch_date", *keys], buckets)
        files.make_directory(spark, self.table.folder)

    def _manifest(self, before: int | None = None) -> str | None:
        named = [int(n[:-5]) for n in files.names(self.spark, self.table.folder) if n.endswith(".json")]
        last = max((n for n in named if before is None or n < before), default=None)
        return None if last is None else f"{self.table.folder}/{last}.json"

    def on_batch(self, batch: DataFrame, number: int) -> None:
        arrived = batch.select(*self.columns)

        def merged(current: DataFrame) -> DataFrame:
            return staging_latest(current.unionByName(arrived), self.keys, self.order)

        self.table.write(self._manifest(number), str(number), arrived, merged)

    def rows(self) -> DataFrame:
        return self.table.rows(self._manifest())


class ClosedDates:
    """Publishes the files of each business date exactly once, when it closes; use ``on_batch`` with ``foreachBatch``.

    Takes a stream stamped by the keyed clock. Records wait in one directory per batch and date. A control that moves
    the active date closes the dates before it: ``lines`` says for each record type which lines records give, as
    ``batch_date``, sort keys and ``value``. One job a record type writes the files of all dates that close, sorted by
    range. Each appears by one rename and is never replaced; a receipt follows a date's last one. A batch run again finds
    receipts, or finishes the files that are not there yet.
    """

    def __init__(self, spark: SparkSession, folder: str, output: str, lines: dict[str, Callable[[DataFrame], DataFrame]]):
        self.spark, self.lines = spark, lines
        self.folder, self.output = folder.rstrip("/"), output.rstrip("/")
        for name in ("waiting", "active", "published"):
            files.make_directory(spark, f"{self.folder}/{name}")

    def _active(self, before: int) -> dt.date | None:
        found = [int(n) for n in files.names(self.spark, f"{self.folder}/active")]
        last = max((n for n in found if n < before), default=None)
        return dt.date.fromisoformat(files.read_text(self.spark, f"{self.folder}/active/{last}")) if last is not None else None

    def _unpublished(self, upto: int, active: dt.date) -> dict[dt.date, list[str]]:
        """Closed dates without a receipt, with the directories of their records: a few names for each open date."""
        receipts = set(files.names(self.spark, f"{self.folder}/published"))
        found: dict[dt.date, list[str]] = {}
        for batch in files.names(self.spark, f"{self.folder}/waiting"):
            if int(batch.removeprefix("batch=")) > upto:
                continue
            for name in files.names(self.spark, f"{self.folder}/waiting/{batch}"):
                if name.removeprefix("batch_date=") not in receipts and dt.date.fromisoformat(name.removeprefix("batch_date=")) < active:
                    found.setdefault(dt.date.fromisoformat(name.removeprefix("batch_date=")), []).append(f"{self.folder}/waiting/{batch}/{name}")
        return found

    def on_batch(self, batch: DataFrame, number: int) -> None:
        spark = self.spark
        data = batch.where(~F.col("control")).drop("control")
        data.repartition("batch_date").write.mode("overwrite").partitionBy("batch_date").parquet(f"{self.folder}/waiting/batch={number}")
        moved = batch.where("control").agg(F.max("batch_date").alias("d")).first()["d"]
        active = max((d for d in (self._active(number), moved) if d), default=None)
        if active is None:
            return
        files.delete(spark, f"{self.folder}/active/{number}")
        files.create_file(spark, f"{self.folder}/active/{number}", active.isoformat())
        closing = self._unpublished(number, active)
        if closing:
            paths = [path for found in closing.values() for path in found]
            rows = spark.read.schema(data.schema).option("basePath", f"{self.folder}/waiting").parquet(*paths)
            self._publish(rows.select(*data.columns), sorted(closing))

    def _publish(self, rows: DataFrame, dates: list[dt.date]) -> None:
        spark = self.spark
        files.make_directory(spark, self.output)
        for record, make in self.lines.items():
            target = {d: f"{self.output}/{record}_{fx.compact(d)}.dat" for d in dates}
            lacking = [d for d in dates if not files.exists(spark, target[d])]
            if not lacking:
                continue
            lines = make(rows.where(F.col("batch_date").isin(lacking)))
            order = ["batch_date", *(c for c in lines.columns if c not in ("batch_date", "value"))]
            ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order).select("batch_date", "value")
            working = f"{self.output}/.{record}.{uuid.uuid4().hex}.tmp"
            ranged.write.partitionBy("batch_date").text(working)
            for date in lacking:
                written = f"{working}/batch_date={date.isoformat()}"
                if files.exists(spark, written):
                    files.rename(spark, written, target[date])
                else:
                    files.create_file(spark, target[date])
            files.delete(spark, working)
        for date in dates:
            files.create_file(spark, f"{self.folder}/published/{date.isoformat()}", json.dumps(sorted(self.lines)))
