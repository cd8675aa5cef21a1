"""One business date at a time: ingest files, post the batch, export its balance file, or all three."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas
from daybook.functions import fields as fx
from daybook.operators import admission, audits, merge, posting, references, rules
from daybook.operators.staging import staged_counts
from daybook.plans import backfill
from daybook.plans.store import BUCKETS, SNAPSHOT, Store
from daybook.schemas import LAYOUTS, Layout
from daybook.session import durable, local_rows
from daybook.sources import files, fixed_width
from daybook.sources.buckets import write_bucketed


class BatchRefused(RuntimeError):
    """The date may not be worked on now; nothing was recorded."""


class BatchRejected(RuntimeError):
    """The batch breaks a rule; the attempt was recorded as failed and nothing was applied."""


class BadInput(ValueError):
    """An input file is missing or holds a malformed line; nothing was staged."""


class Ledger:
    """A ledger below one root folder that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.store = Store(spark, root, buckets)

    # Ingest

    def ingest(self, directory: str, date: dt.date | str) -> dict[str, int]:
        """Replace the staged rows of a date by its four files, all of them or none."""
        date = fx.batch_date(date)
        directory = directory.rstrip("/")
        status = self.store.active_status(date)
        if status:
            raise BatchRefused(f"cannot replace staging for {status} batch {date}")
        listing = files.list_directory(self.spark, directory)
        missing = admission.missing_input_files(self._one_date(date), listing).orderBy("name").first()
        if missing:
            raise BadInput(f"missing input file: {directory}/{missing['name']}")
        load = uuid.uuid4().hex
        with ThreadPoolExecutor(len(LAYOUTS)) as pool:
            loads = {
                record: pool.submit(self._load, layout, [f"{directory}/{record}_{fx.compact(date)}.dat"], load)
                for record, layout in LAYOUTS.items()
            }
        paths, counts = {}, {}
        for record, loaded in loads.items():
            path, counts[record], fault = loaded.result()
            if fault:
                raise BadInput(fault)
            if path:
                paths[record] = path
        event = dict(kind="ingested", batch_date=date, paths=paths)
        self.store.append(event | {f"{r}_count": n for r, n in counts.items()})
        return counts

    def _load(self, layout: Layout, names: list[str], load: str) -> tuple[str | None, int, str | None]:
        """Parse files into a new staging directory: its path, its lines, and the first fault if any."""
        names = [name for name in names if files.octets(self.spark, name) > 0]
        if not names:
            return None, 0, None
        path = f"{self.store.root}/staging/{layout.record}/{load}"
        numbered = self._stage(layout, names, path)
        place = F.struct("source_file", "source_line")
        found = numbered.agg(
            F.count(F.lit(1)).alias("lines"), F.min(F.when(F.col("reject_reason").isNotNull(), place)).alias("bad")
        ).first()
        if found["bad"]:
            at = (F.col("source_file") == found["bad"][0]) & (F.col("source_line") == found["bad"][1])
            why = fixed_width.rejects(numbered.where(at), layout).first()["reject_reason"]
            return path, found["lines"], f"{found['bad'][0]}:{found['bad'][1]}: {why}"
        if not found["lines"]:
            return path, 0, f"{names[0]}: no line in a file that is not empty"
        return path, found["lines"], None

    def _stage(self, layout: Layout, names: list[str], path: str) -> DataFrame:
        lines = fixed_width.positioned_lines(self.spark, names, layout)
        lines.write.parquet(f"{path}/lines")
        written = self.spark.read.schema(lines.schema).parquet(f"{path}/lines")
        fixed_width.split_table(written).write.parquet(f"{path}/splits")
        return fixed_width.number_lines(written, self.spark.read.parquet(f"{path}/splits"))

    # Process

    def process(self, date: dt.date | str) -> dict[str, int]:
        """Post a staged date: validate, merge, append, balance, snapshot; all of it or none."""
        date = fx.batch_date(date)
        done = self.store.completed(date)
        if done:
            return {record: done[f"{record}_count"] for record in LAYOUTS}
        decision = self._admission(date)["process"]
        if decision != "run":
            raise BatchRefused(f"batch {date}: {decision}")
        run_id = uuid.uuid4().hex
        attempt = dict(kind="run", batch_date=date, batch_run_id=run_id)
        self.store.append(attempt | dict(status="RUNNING"))
        try:
            counts, record_count, paths = self._post(date, run_id)
        except Exception as failure:
            self.store.append(attempt | dict(status="FAILED", error_message=str(failure)))
            raise
        applied = {f"{r}_count": n for r, n in counts.items()}
        self.store.append(attempt | dict(status="COMPLETED", record_count=record_count, paths=paths) | applied)
        return counts

    def _post(self, date: dt.date, run_id: str) -> tuple[dict[str, int], int, dict[str, str]]:
        store = self.store
        staged = rules.Staged(date, **{record: store.staged(record, date) for record in LAYOUTS})
        state = self._state()
        # The ledger is met once: validation and the append use the same written matches.
        marked = references.with_posted(staged.transaction, state.ledger, store.buckets)
        worst = rules.first_violation(rules.violations(staged, state, marked)).first()
        if worst:
            raise BatchRejected(worst["message"])

        paths, ingested, counts = store.state_paths(), store.ingested(date), {}
        for record in ("customer", "account", "relationship"):
            counts[record] = ingested[f"{record}_count"]
            if counts[record]:
                paths[record] = self._merge_state(record, run_id, staged.table(record))

        unposted = references.fresh(marked)
        partition = f"batch_date={date}/batch_run_id={run_id}"
        appended = posting.ledger_rows(unposted, run_id).drop("batch_date", "batch_run_id")
        posted_path = f"{store.root}/ledger/{partition}"
        gate = audits.Gate("transaction")
        write_bucketed(gate.watch(appended), posted_path, ["transaction_id"], store.buckets)
        posted = self.spark.read.schema(appended.schema).parquet(posted_path)
        counts["transaction"] = posted.count()
        if counts["transaction"]:  # Spark leaves the counts out of a plan that it knows to be empty
            gate.close()

        new_accounts = durable(merge.new_keys(staged.account, state.account, ["account_id"]), "new-accounts")
        members = durable(posting.snapshot_members(new_accounts, posted), "members")
        record_count = members.count()
        paths["balance"] = self._move_balances(run_id, new_accounts, posted, members)
        snapshot = posting.balance_snapshot(members, store.state("balance", paths["balance"]))
        written = self.spark.read.parquet(self._write(snapshot, f"snapshot/{partition}"))
        if written.count() != record_count:
            raise BatchRejected("Missing balance for output account")
        return counts, record_count, paths

    def _merge_state(self, record: str, run: str, staged: DataFrame) -> str:
        """The manifest of a current-state table after a merge of ``staged`` into the buckets it touches."""
        keys, gate = list(LAYOUTS[record].keys), audits.Gate(record)

        def merged(current: DataFrame) -> DataFrame:
            return gate.watch(merge.upsert_audited(current, staged, keys))

        manifest = self.store.write_state(record, run, staged, merged)
        gate.close()
        return manifest

    def _move_balances(self, run: str, created: DataFrame, posted: DataFrame, moved: DataFrame) -> str:
        """The manifest of the balances after postings; ``moved`` holds the accounts created or posted to."""
        deltas = posting.account_deltas(posted)

        def after(current: DataFrame) -> DataFrame:
            return posting.balances_after(current.unionByName(merge.initial_balances(created)), deltas)

        return self.store.write_state("balance", run, moved, after)

    def _state(self) -> rules.State:
        names = ("customer", "account", "relationship", "balance")
        current = {name: self.store.state(name).drop("created_at", "updated_at") for name in names}
        return rules.State(**current, ledger=self.store.ledger())

    def _write(self, df: DataFrame, path: str) -> str:
        path = f"{self.store.root}/{path}"
        df.write.parquet(path)
        return path

    # Export

    def export(self, directory: str, date: dt.date | str, as_parts: bool = False) -> str:
        """Publish the balance file of a completed date. The same file again is left alone, another is refused.

        It is one plain file joined from sorted parts, or with ``as_parts`` a directory of that name with the parts in
        order, which no single process writes.
        """
        date = fx.batch_date(date)
        header = (
            admission.exportable_snapshots(self.store.snapshot_headers(), self.store.runs())
            .where(F.col("batch_date") == fx.day(date))
            .first()
        )
        if header is None:
            raise BatchRefused(f"no completed balance snapshot for {date}")
        rows = self.store.snapshots().where(F.col("batch_date") == fx.day(date))
        if rows.count() != header["record_count"]:
            raise RuntimeError(f"snapshot record count mismatch for {date}")
        lines = rows.select("account_id", fx.balance_line(F.col("account_id"), F.col("balance")).alias("value"))
        target = f"{directory.rstrip('/')}/balance_{fx.compact(date)}.dat"
        empty = not header["record_count"]
        if files.exists(self.spark, target):
            copy = f"{self.store.root}/export/{uuid.uuid4().hex}/balance.dat"
            files.publish_lines(lines, ["account_id"], copy, empty, as_parts)
            if not files.same_lines(self.spark, target, copy):
                raise FileExistsError(f"output already exists with other contents: {target}")
        else:
            files.publish_lines(lines, ["account_id"], target, empty, as_parts)
        self.store.append(dict(kind="exported", batch_date=date))
        return target

    # All three

    def run(self, input_directory: str, output_directory: str, date: dt.date | str) -> dict[str, int]:
        """Ingest, post and export a date. After a committed posting only the export is repeated.

        A launch that fails, be it for its input, is recorded and blocks later dates until the date is repeated.
        """
        date = fx.batch_date(date)
        listing = files.list_directory(self.spark, input_directory)
        missing = admission.missing_input_files(self._one_date(date), listing)
        decision = self._admission(date, missing)["job"]
        job = dict(kind="job", batch_date=date)
        if decision == "missing_input":
            self.store.append(job | dict(status="STARTED"), job | dict(status="FAILED", error_message=decision))
        if decision not in ("run", "noop", "export_only"):
            raise BatchRefused(f"batch {date}: {decision}")
        if decision == "noop":
            return self.process(date)
        self.store.append(job | dict(status="STARTED"))
        try:
            if decision == "run":
                self.ingest(input_directory, date)
            counts = self.process(date)
            self.export(output_directory, date)
        except Exception as failure:
            self.store.append(job | dict(status="FAILED", error_message=str(failure)))
            raise
        self.store.append(job | dict(status="COMPLETED"))
        return counts

    # Many dates

    def backfill(self, directory: str, dates: list[dt.date | str]) -> list[dt.date]:
        """Post every date before the first that fails, in one plan, as a loop over ``run`` without its exports.

        A date that breaks a rule has its receipt and a failed attempt; one whose files are missing or malformed has
        neither, as nothing of it was staged. Either blocks later dates. Returns the posted dates.
        """
        spark, store = self.spark, self.store
        directory = directory.rstrip("/")
        dates = sorted({fx.batch_date(d) for d in dates})
        wanted = self._dates(dates)
        refused = (
            admission.batch_admission(
                wanted, store.runs(), store.receipts(), store.exported(), wanted.limit(0), store.jobs()
            )
            .where(F.col("job") != "run")
            .orderBy("batch_date")
            .first()
        )
        if refused and refused["job"] != "blocked_by_earlier":
            raise BatchRefused(f"batch {refused['batch_date']}: {refused['job']}")
        if refused and min(store.unfinished()) not in dates:
            raise BatchRefused(f"batch {refused['batch_date']}: {refused['job']}")

        listing = files.list_directory(spark, directory)
        stops = [admission.missing_input_files(wanted, listing).select(F.lit("missing_input").alias("rule"), "batch_date")]
        filled = {r["name"] for r in listing.where(F.col("is_regular") & (F.col("length") > 0)).collect()}
        load, feeds, loaded = uuid.uuid4().hex, {}, {}
        for record, layout in LAYOUTS.items():
            names = [n for n in (f"{record}_{fx.compact(d)}.dat" for d in dates) if n in filled]
            if not names:
                feeds[record] = local_rows(spark, [], schemas.staged_schema(layout))
                continue
            numbered = self._stage(
                layout, [f"{directory}/{n}" for n in names], f"{store.root}/staging/{record}/{load}"
            )
            loaded[record] = f"{store.root}/staging/{record}/{load}"
            stops.append(
                numbered.where(F.col("reject_reason").isNotNull()).select(F.lit("bad_input").alias("rule"), "batch_date")
            )
            feeds[record] = fixed_width.accepted(numbered, layout)
        state = self._state()
        staged = backfill.on_state(backfill.Feeds(**feeds), state, store.buckets)
        stops.append(backfill.failing_dates(staged, state.balance))
        stop = reduce(DataFrame.unionByName, stops).orderBy("batch_date", "rule").first()
        posted_dates = [d for d in dates if stop is None or d < stop["batch_date"]]
        if posted_dates:
            self._post_many(posted_dates, load, loaded, staged, state)
        if stop is not None:
            date, why = stop["batch_date"], dict(status="FAILED", error_message=stop["rule"])
            events = [dict(kind="job", batch_date=date) | why]
            if stop["rule"] not in ("missing_input", "bad_input"):
                attempt = dict(kind="run", batch_date=date, batch_run_id=f"{load}-{date}")
                received = staged_counts({r: staged.table(r).where(F.col("batch_date") == fx.day(date)) for r in LAYOUTS})
                counts = {f"{r['record']}_count": r["rows"] for r in received.where(F.col("batch_date") == fx.day(date)).collect()}
                receipt = dict(kind="ingested", batch_date=date, paths=loaded)
                zero = {f"{r}_count": 0 for r in LAYOUTS}
                events = [receipt | zero | counts, attempt | dict(status="RUNNING"), attempt | why, *events]
            store.append(*events)
        return posted_dates

    def _post_many(self, dates, load: str, loaded: dict[str, str], staged: backfill.Feeds, state: rules.State) -> None:
        store = self.store
        within = F.col("batch_date").between(fx.day(dates[0]), fx.day(dates[-1]))
        run_id = F.concat(F.lit(f"{load}-"), F.col("batch_date").cast("string")).alias("batch_run_id")
        postings = backfill.winners(staged.transaction).where(within)
        ledger = f"{store.root}/staging/ledger/{load}"
        write_bucketed(
            postings.select("transaction_id", "account_id", "type", "amount", "batch_date", run_id),
            ledger, ["transaction_id"], store.buckets, ("batch_date", "batch_run_id"),
        )
        posted = self.spark.read.schema(schemas.LEDGER).parquet(ledger)
        accounts = staged.account.where(F.col("batch_date") <= fx.day(dates[-1]))
        # Ranges of (date, ID) keep a task to few partitions and cut a date that holds most of the rows.
        snapshot = f"{store.root}/staging/snapshot/{load}"
        (
            backfill.snapshots_all_dates(posted, accounts, state.balance)
            .select("account_id", "balance", "batch_date", run_id)
            .repartitionByRange("batch_date", "account_id")
            .write.partitionBy("batch_date", "batch_run_id")
            .parquet(snapshot)
        )
        members = self.spark.read.schema(SNAPSHOT).parquet(snapshot)

        paths = store.state_paths()
        for record in ("customer", "account", "relationship"):
            layout = LAYOUTS[record]
            sent = staged.table(record).where(within)
            last = merge.latest_record(sent, list(layout.keys), ["batch_date", "source_line"]).select(*layout.columns)
            paths[record] = self._merge_state(record, load, durable(last, "last-records"))
        created = durable(merge.new_keys(accounts.where(within), state.account, ["account_id"]), "new-accounts")
        moved = durable(posting.snapshot_members(created, posted), "members")
        paths["balance"] = self._move_balances(load, created, posted, moved)
        per_date = self._counts_per_date(dates, staged, posted, members)
        entries = []
        for date in dates:
            attempt = dict(kind="run", batch_date=date, batch_run_id=f"{load}-{date}")
            counts = {f"{r}_count": per_date.get((date, r), 0) for r in LAYOUTS}
            staged_counts = counts | dict(transaction_count=per_date.get((date, "staged"), 0))
            entries.append(dict(kind="ingested", batch_date=date, paths=loaded) | staged_counts)
            entries.append(attempt | dict(status="RUNNING"))
            done = dict(status="COMPLETED", record_count=per_date.get((date, "snapshot"), 0), paths=paths)
            entries.append(attempt | done | counts)
        files.adopt_partitions(self.spark, ledger, f"{store.root}/ledger")
        files.adopt_partitions(self.spark, snapshot, f"{store.root}/snapshot")
        store.append(*entries)

    def _counts_per_date(self, dates, staged: backfill.Feeds, posted: DataFrame, members: DataFrame) -> dict:
        """Row counts per date and table: at most a handful of small rows per date."""
        tables = {r: staged.table(r) for r in ("customer", "account", "relationship")}
        tables |= {"transaction": posted, "staged": staged.transaction, "snapshot": members}
        counted = staged_counts(tables).where(F.col("batch_date").between(fx.day(dates[0]), fx.day(dates[-1])))
        return {(r["batch_date"], r["record"]): r["rows"] for r in counted.collect()}

    # Control rows

    def _dates(self, dates: list[dt.date]) -> DataFrame:
        schema = T.StructType([schemas.LINEAGE["batch_date"]])
        return local_rows(self.spark, [{"batch_date": d} for d in dates], schema)

    def _one_date(self, date: dt.date) -> DataFrame:
        return self._dates([date])

    def _admission(self, date: dt.date, missing: DataFrame | None = None):
        dates = self._one_date(date)
        missing = dates.limit(0) if missing is None else missing
        store = self.store
        return admission.batch_admission(
            dates, store.runs(), store.receipts(), store.exported(), missing, store.jobs()
        ).first()
