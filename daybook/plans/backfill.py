"""Many dates in one plan, with the results of running them one after the other.

Rows are first reduced to one per (account, date) or per transaction ID with map-side partial aggregation, so a
window over an account sees at most one row per business date however many transactions the account has.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.operators.merge import first_record, latest_record
from daybook.operators.posting import signed_amounts
from daybook.operators.references import CONTENTS, posted_matches
from daybook.operators.rules import State, duplicates
from daybook.schemas import LAYOUTS
from daybook.session import durable

_PLACE = ["batch_date", "source_line"]


def _before() -> Column:
    """Stands for the published state: the day before the first date that Python, and so a batch, can name."""
    return F.date_sub(fx.day(dt.date.min), 1)


def _by_contents(feed: DataFrame) -> DataFrame:
    """Occurrences combined per transaction ID and contents: the first place and how often."""
    return feed.groupBy("transaction_id", *CONTENTS).agg(
        F.min(F.struct(*_PLACE)).alias("place"), F.count(F.lit(1)).alias("times")
    )


def first_postings(feed: DataFrame) -> DataFrame:
    """One row per transaction ID: the posting that wins, and how often it came again, same or different."""
    per_id = _by_contents(feed).groupBy("transaction_id").agg(
        F.min(F.struct("place", *CONTENTS, "times")).alias("first"), F.sum("times").alias("times")
    )
    return per_id.select(
        "transaction_id",
        "first.place.*",
        *[F.col(f"first.{c}").alias(c) for c in CONTENTS],
        (F.col("first.times") - 1).alias("replays"),
        (F.col("times") - F.col("first.times")).alias("conflicts"),
    )


def winners(feed: DataFrame) -> DataFrame:
    """The postings a date-by-date run would make: the first occurrence of every transaction ID."""
    return first_record(feed.select("transaction_id", *_PLACE, *CONTENTS), ["transaction_id"], _PLACE)


def first_two_contents(feed: DataFrame) -> DataFrame:
    """Per transaction ID the posting that wins (turn 1) and the first occurrence of other contents (turn 2)."""
    turn = F.row_number().over(W.partitionBy("transaction_id").orderBy("place"))
    return (
        _by_contents(feed)
        .withColumn("turn", turn)
        .where(F.col("turn") <= 2)
        .select("transaction_id", "place.*", *CONTENTS, "turn")
    )


def daily_deltas(postings: DataFrame) -> DataFrame:
    return (
        signed_amounts(postings.select("account_id", "batch_date", "type", "amount"))
        .groupBy("account_id", "batch_date")
        .agg(F.sum("signed").alias("delta"))
    )


def _running_totals(deltas: DataFrame) -> DataFrame:
    so_far = W.partitionBy("account_id").orderBy("batch_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return deltas.withColumn("total", F.sum("delta").over(so_far))


def closing_balances(postings: DataFrame) -> DataFrame:
    """Closing balance per account and date with postings."""
    return _running_totals(daily_deltas(postings)).select(
        "account_id", "batch_date", fx.checked_cents(F.col("total")).alias("balance")
    )


def first_seen(feed: DataFrame, key: str) -> DataFrame:
    """The date a key first came, from which on it exists."""
    return feed.groupBy(key).agg(F.min("batch_date").alias("first_date"))


def effective_accounts(feed: DataFrame) -> DataFrame:
    """Account records with the dates they hold: from their batch date to the next record's, exclusive."""
    per_date = latest_record(feed, ["account_id", "batch_date"], ["source_line"])
    next_date = F.lead("batch_date").over(W.partitionBy("account_id").orderBy("batch_date"))
    return per_date.select(
        "account_id",
        F.col("batch_date").alias("valid_from"),
        next_date.alias("valid_to"),
        "start_date",
        "end_date",
        "account_type",
    )


def snapshots_all_dates(
    postings: DataFrame, account_feed: DataFrame, opening: DataFrame | None = None
) -> DataFrame:
    """The balance snapshot of every date: accounts first seen or posted to that day, at closing balance.

    New accounts join the daily deltas as zero, and opening balances as a date before all others, so membership
    and running totals come out of one aggregation and one window.
    """
    created = first_seen(account_feed, "account_id").select(
        "account_id",
        F.col("first_date").alias("batch_date"),
        F.lit(0).cast("decimal(29,0)").alias("delta"),
    )
    rows = daily_deltas(postings).unionByName(created)
    if opening is not None:
        rows = rows.unionByName(_opening_deltas(opening))
    members = rows.groupBy("account_id", "batch_date").agg(F.sum("delta").alias("delta"))
    return (
        _running_totals(members)
        .where(F.col("batch_date") > _before())
        .select("batch_date", "account_id", fx.checked_cents(F.col("total")).alias("balance"))
    )


def ledger_reconciliation(ledger: DataFrame, balances: DataFrame) -> DataFrame:
    """Accounts whose stored balance is not the sum of their ledger: (account_id, ledger_total, balance)."""
    sums = (
        signed_amounts(ledger.select("account_id", "type", "amount"))
        .groupBy("account_id")
        .agg(F.sum("signed").alias("ledger_total"))
    )
    zero = F.lit(0).cast("decimal(29,0)")
    return (
        sums.join(balances, "account_id", "full_outer")
        .where(~F.coalesce("ledger_total", zero).eqNullSafe(F.col("balance").cast("decimal(29,0)")))
        .select("account_id", F.coalesce("ledger_total", zero).alias("ledger_total"), "balance")
    )


@dataclass(frozen=True)
class Feeds:
    """Staged rows of many dates."""

    customer: DataFrame
    account: DataFrame
    relationship: DataFrame
    transaction: DataFrame

    def table(self, record: str) -> DataFrame:
        return getattr(self, record)


def _unknown(rows: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """Dates on which a key is used before it was first seen; keys and dates only."""
    used = rows.groupBy(key).agg(F.min("batch_date").alias("batch_date"))
    return used.join(first_seen(feed, key), key, "left").where(
        F.col("first_date").isNull() | (F.col("first_date") > F.col("batch_date"))
    )


def _barred_dates(postings: DataFrame, account_feed: DataFrame) -> DataFrame:
    """(account, date) pairs with a new posting on an account that takes none that day.

    An as-of join: pairs and records are at most one per account and date, so the window that carries the last
    record forward stays small for any account.
    """
    nothing = F.lit(None).cast("boolean")
    records = latest_record(
        account_feed.select("account_id", "batch_date", "source_line", "start_date", "end_date"),
        ["account_id", "batch_date"],
        ["source_line"],
    ).select(
        "account_id",
        "batch_date",
        F.struct("start_date", F.col("end_date").isNotNull().alias("closed")).alias("record"),
        nothing.alias("posted"),
    )
    pairs = postings.select("account_id", "batch_date").distinct().select(
        "account_id", "batch_date", F.lit(None).cast(records.schema["record"].dataType).alias("record"), F.lit(True).alias("posted")
    )
    merged = (
        records.unionByName(pairs)
        .groupBy("account_id", "batch_date")
        .agg(F.max("record").alias("record"), F.max("posted").alias("posted"))
    )
    as_of = W.partitionBy("account_id").orderBy("batch_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    state = merged.withColumn("state", F.last("record", ignorenulls=True).over(as_of))
    return state.where(
        F.col("posted") & (F.col("state.closed") | (F.col("state.start_date") > F.col("batch_date")))
    )


def _opening_deltas(balances: DataFrame) -> DataFrame:
    return balances.select(
        "account_id", _before().alias("batch_date"), F.col("balance").cast("decimal(29,0)").alias("delta")
    )


def _as_records(current: DataFrame, feed: DataFrame) -> DataFrame:
    lineage = {"batch_date": _before(), "source_file": F.lit("")}
    columns = [
        lineage[c].alias(c) if c in lineage else F.monotonically_increasing_id().alias(c) if c == "source_line" else F.col(c)
        for c in feed.columns
    ]
    return current.select(*columns)


def on_state(feeds: Feeds, state: State, buckets: int | None = None) -> Feeds:
    """The feeds with the published state in front: what is on file, and the ledger rows of the same IDs."""
    posted = posted_matches(feeds.transaction, state.ledger, buckets).select("transaction_id", "posted.*")
    return Feeds(
        customer=feeds.customer.unionByName(_as_records(state.customer, feeds.customer)),
        account=feeds.account.unionByName(_as_records(state.account, feeds.account)),
        relationship=feeds.relationship,
        transaction=feeds.transaction.unionByName(_as_records(posted, feeds.transaction)),
    )


def failing_dates(feeds: Feeds, opening: DataFrame | None = None) -> DataFrame:
    """The first failing date of each rule: (rule, batch_date). Later dates of a rule do not matter.

    Evaluated as if no earlier date had failed, which is exact for the first failing date overall. With published
    state, pass the feeds ``on_state`` and the opening balances.
    """
    turns = durable(first_two_contents(feeds.transaction), "turns")
    postings = turns.where((F.col("turn") == 1) & (F.col("batch_date") > _before()))
    deltas = daily_deltas(postings)
    if opening is not None:
        deltas = deltas.unionByName(_opening_deltas(opening))
    deltas = _running_totals(deltas)
    found = {
        "account_dates": feeds.account.where(F.col("end_date") < F.col("start_date")),
        "conflicting_replay": turns.where(F.col("turn") == 2),
        "missing_account_relationship": _unknown(feeds.relationship, feeds.account, "account_id"),
        "missing_account_transaction": _unknown(feeds.transaction, feeds.account, "account_id"),
        "missing_customer": _unknown(feeds.relationship, feeds.customer, "customer_id"),
        "ineligible_transaction": _barred_dates(postings, feeds.account),
        "balance_overflow": deltas.where(~fx.in_cents_range(F.col("total"))),
    }
    for record, layout in LAYOUTS.items():
        found[f"duplicate_{record}"] = duplicates(feeds.table(record), list(layout.keys))
    dates = [rows.select(F.lit(rule).alias("rule"), "batch_date") for rule, rows in found.items()]
    return reduce(DataFrame.unionByName, dates).groupBy("rule").agg(F.min("batch_date").alias("batch_date"))


def postable_prefix(dates: DataFrame, feeds: Feeds) -> DataFrame:
    """Dates strictly before the first failing date."""
    stop = failing_dates(feeds).agg(F.min("batch_date").alias("stop")).scalar()
    return (
        dates.select("batch_date").distinct().where(F.coalesce(F.col("batch_date") < stop, F.lit(True)))
    )
