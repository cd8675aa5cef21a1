"""Published versions of the ledger's tables: new directories, made visible by one small log entry each.

Rows are written first, checked, and become visible only when their log entry is created. An entry's name is the
next number, created only if absent, so of two writers one fails and nothing is half visible. A failed attempt
leaves unreferenced directories and no trace in the tables.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas
from daybook.schemas import LAYOUTS, RUN_COUNTS
from daybook.session import local_rows
from daybook.sources import files
from daybook.sources.buckets import BucketedTable, BucketVersions

#: Buckets of the ledger and of each current-state table, fixed when a ledger is created. As many as keep a bucket's
#: part of the ledger within a task.
BUCKETS = 16
#: Log entries after which the log is joined to a checkpoint.
ENTRIES_APART = 64
TO_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

EVENT = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("kind", T.StringType()),  # ingested, run, exported or job
    T.StructField("batch_date", T.DateType()),
    T.StructField("batch_run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType()),
    *[T.StructField(name, T.LongType()) for name in RUN_COUNTS],
    T.StructField("record_count", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("paths", T.MapType(T.StringType(), T.StringType())),
])

STATE_SCHEMAS = {
    "customer": T.StructType(schemas.CUSTOMER.schema.fields + schemas.AUDIT),
    "account": T.StructType(schemas.ACCOUNT.schema.fields + schemas.AUDIT),
    "relationship": T.StructType(schemas.RELATIONSHIP.schema.fields + schemas.AUDIT),
    "balance": schemas.BALANCE,
}
STATE_KEYS = {name: list(LAYOUTS[name].keys) if name in LAYOUTS else ["account_id"] for name in STATE_SCHEMAS}
SNAPSHOT = T.StructType([
    T.StructField("account_id", T.LongType()),
    T.StructField("balance", T.LongType()),
    T.StructField("batch_date", T.DateType()),
    T.StructField("batch_run_id", T.StringType()),
])


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self._read: tuple[list[str], list[Row]] = ([], [])
        for name in ("log", "checkpoints", "ledger", "snapshot"):
            files.make_directory(spark, f"{self.root}/{name}")
        layout = f"{self.root}/layout.json"
        if not files.exists(spark, layout):
            files.create_file(spark, layout, json.dumps({"buckets": buckets}))
        self.buckets: int = json.loads(files.read_text(spark, layout))["buckets"]
        by = ("batch_date", "batch_run_id")
        self.posted = BucketedTable(spark, f"{self.root}/ledger", schemas.LEDGER, ["transaction_id"], self.buckets, by)

    def entries(self) -> list[Row]:
        """The log's events in order, a few per batch date.

        What was read before is kept, so an added entry costs one small file; a store that is opened reads the newest
        checkpoint and the entries after it.
        """
        names = files.names(self.spark, f"{self.root}/log")
        known, rows = self._read
        if not known and (saved := files.names(self.spark, f"{self.root}/checkpoints")):
            known = [n for n in names if n <= saved[-1]]
            rows = self._events_of([f"{self.root}/checkpoints/{saved[-1]}"])
        fresh = [n for n in names if not known or n > known[-1]]
        if fresh:
            rows = rows + self._events_of([f"{self.root}/log/{n}" for n in fresh])
        self._read = (names, rows)
        return rows

    def _events_of(self, paths: list[str]) -> list[Row]:
        return self.spark.read.schema(EVENT).json(paths).orderBy("number").collect()

    def _save_checkpoint(self) -> None:
        """Join the entries so far to one file, named by the last of them. Entries stay; a writer that fails here loses
        nothing."""
        rows, (names, _) = self.entries(), self._read
        saved = files.names(self.spark, f"{self.root}/checkpoints")
        if sum(not saved or n > saved[-1] for n in names) < ENTRIES_APART:
            return
        text = self.spark.createDataFrame(rows, EVENT).orderBy("number").select(F.to_json(F.struct(*EVENT.names), TO_JSON).alias("line"))
        lines = [r["line"] for r in text.collect()]  # the log itself, which the store holds anyway
        files.create_file(self.spark, f"{self.root}/checkpoints/{names[-1]}", "\n".join(lines) + "\n")

    def events(self) -> DataFrame:
        return local_rows(self.spark, [e.asDict() for e in self.entries()], EVENT)

    def append(self, *events: dict) -> None:
        """Publish events together, in order, as one log entry."""
        known = self.entries()
        last = known[-1]["number"] if known else 0
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        lines = []
        for number, event in enumerate(events, last + 1):
            entry = {"at": now, **event, "number": number}
            lines.append(json.dumps({k: str(v) if isinstance(v, dt.date) else v for k, v in entry.items()}))
        files.create_file(self.spark, f"{self.root}/log/{last + 1:012d}.json", "\n".join(lines) + "\n")
        self._save_checkpoint()

    def runs(self) -> DataFrame:
        from daybook.operators.admission import current_runs

        return current_runs(self.events().where(F.col("kind") == "run"))

    def receipts(self) -> DataFrame:
        return self.events().where(F.col("kind") == "ingested").select(
            "batch_date", F.col("at").alias("ingested_at")
        )

    def jobs(self) -> DataFrame:
        """Launches of whole dates: started, then completed or failed."""
        return self.events().where(F.col("kind") == "job").select("number", "batch_date", "status")

    def unfinished(self) -> set[dt.date]:
        """Dates whose last posting attempt failed or whose last launch did not end well."""
        runs = {e["batch_date"]: e["status"] for e in self.entries() if e["kind"] == "run" and e["status"] != "RUNNING"}
        jobs = {e["batch_date"]: e["status"] for e in self.entries() if e["kind"] == "job"}
        return {d for d, s in runs.items() if s == "FAILED"} | {d for d, s in jobs.items() if s != "COMPLETED"}

    def exported(self) -> DataFrame:
        return self.events().where(F.col("kind") == "exported").select("batch_date").distinct()

    def snapshot_headers(self) -> DataFrame:
        return self.events().where((F.col("kind") == "run") & (F.col("status") == "COMPLETED")).select(
            "batch_date", "batch_run_id", "record_count"
        )

    def completed(self, date: dt.date) -> Row | None:
        return next((e for e in self._completed_runs() if e["batch_date"] == date), None)

    def _completed_runs(self) -> list[Row]:
        return [e for e in self.entries() if e["kind"] == "run" and e["status"] == "COMPLETED"]

    def active_status(self, date: dt.date) -> str | None:
        """COMPLETED or RUNNING when an attempt of the date is neither absent nor failed."""
        of_date = [e for e in self.entries() if e["kind"] == "run" and e["batch_date"] == date]
        ended = {e["batch_run_id"] for e in of_date if e["status"] != "RUNNING"}
        if any(e["status"] == "COMPLETED" for e in of_date):
            return "COMPLETED"
        return "RUNNING" if any(e["batch_run_id"] not in ended for e in of_date) else None

    def ingested(self, date: dt.date) -> Row | None:
        """The last ingestion of a date, with its counts and paths."""
        return next((e for e in reversed(self.entries()) if e["kind"] == "ingested" and e["batch_date"] == date), None)

    def state_paths(self) -> dict[str, str]:
        done = self._completed_runs()
        return dict(done[-1]["paths"] or {}) if done else {}

    def _versions(self, name: str) -> BucketVersions:
        return BucketVersions(self.spark, f"{self.root}/state/{name}", STATE_SCHEMAS[name], STATE_KEYS[name], self.buckets)

    def state(self, name: str, manifest: str | None = None) -> DataFrame:
        """A version of a current-state table, by default the last published one; empty before the first."""
        return self._versions(name).rows(manifest or self.state_paths().get(name))

    def write_state(self, name: str, run: str, changed: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> str:
        """Write a new version of a current-state table, of the buckets that ``changed`` touches; returns its manifest."""
        return self._versions(name).write(self.state_paths().get(name), run, changed, merged)

    def _published(self, folder: str, schema: T.StructType) -> DataFrame:
        completed = self.snapshot_headers().select("batch_run_id", "batch_date")
        return (
            self.spark.read.schema(schema)
            .parquet(f"{self.root}/{folder}")
            .join(completed, ["batch_run_id", "batch_date"], "left_semi")
            .select(*schema.names)
        )

    def ledger(self) -> DataFrame:
        """Posted transactions, bucketed by their ID. Only published runs are declared, so others are not read."""
        self.posted.declare([(e["batch_date"], e["batch_run_id"]) for e in self._completed_runs()])
        return self.posted.rows()

    def snapshots(self) -> DataFrame:
        return self._published("snapshot", SNAPSHOT)

    def staged(self, record: str, date: dt.date) -> DataFrame:
        """The staged rows of a date with their source lines."""
        from daybook.sources.fixed_width import accepted, number_lines

        layout = LAYOUTS[record]
        ingested = self.ingested(date)
        path = dict(ingested["paths"] or {}).get(record) if ingested else None
        if path is None:
            return local_rows(self.spark, [], schemas.staged_schema(layout))
        lines = self.spark.read.parquet(f"{path}/lines")
        splits = self.spark.read.parquet(f"{path}/splits")
        # A backfill stages the files of many dates together.
        return accepted(number_lines(lines, splits).where(F.col("batch_date") == F.lit(date)), layout)
