"""Joins of staged rows with the ledger, accounts and customers.

Each check reduces the staged rows to their distinct keys, combined on the map side so that a key with a large
share of the rows costs one row per task, and joins keys with keys. The offending keys are written: few or none
in a sound batch, so Spark knows their size, broadcasts them, and the staged rows are not shuffled at all. Should
they be many, the join that fetches their rows has a plain shuffle on either side, which is the form adaptive
skew handling can split.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.session import durable
from daybook.sources.buckets import matching

CONTENTS = ["account_id", "type", "amount"]


def rows_of(staged: DataFrame, keys: DataFrame) -> DataFrame:
    """Staged rows with one of ``keys``, a written table that holds each key once."""
    return staged.join(keys, keys.columns).select(*staged.columns)


def unknown_keys(staged: DataFrame, known: list[DataFrame], key: str) -> DataFrame:
    """Distinct staged keys that none of ``known`` holds."""
    lacking = staged.select(key).distinct()
    for keys in known:
        lacking = lacking.join(keys.select(key), key, "left_anti")
    return lacking


def posted_matches(staged: DataFrame, ledger: DataFrame, buckets: int | None = None) -> DataFrame:
    """The ledger rows that share an ID with the batch, as ``(transaction_id, posted)``.

    The ledger is reduced by the batch's IDs before anything else sees it. If it is laid out in ``buckets`` of its ID it
    is not moved: a small batch opens the buckets of its IDs, a large one is dealt to the same buckets. Otherwise a
    small batch is broadcast against the ledger scan, and a large one shuffles IDs and contents of the ledger once.
    """
    found = matching(ledger.select("transaction_id", *CONTENTS), staged, "transaction_id", buckets)
    return found.select("transaction_id", F.struct(*CONTENTS).alias("posted"))


def with_posted(staged: DataFrame, ledger: DataFrame, buckets: int | None = None) -> DataFrame:
    """Staged transactions with the ledger's contents of the same ID, null where there is none.

    The matches are written, so the ledger is met once however often the result is used.
    """
    matches = durable(posted_matches(staged, ledger, buckets), "posted-matches")
    return staged.join(matches, "transaction_id", "left").select(*staged.columns, "posted")


def _same_contents() -> Column:
    return F.col("posted").eqNullSafe(F.struct(*CONTENTS))


def conflicting(marked: DataFrame) -> DataFrame:
    """Rows of ``with_posted`` whose ID is posted with other contents."""
    return marked.where(F.col("posted").isNotNull() & ~_same_contents())


def replayed(marked: DataFrame) -> DataFrame:
    """Rows of ``with_posted`` that repeat a posted transaction exactly; they are skipped silently."""
    return marked.where(F.col("posted").isNotNull() & _same_contents()).drop("posted")


def fresh(marked: DataFrame) -> DataFrame:
    """Rows of ``with_posted`` that are not posted yet."""
    return marked.where(F.col("posted").isNull()).drop("posted")


def missing_accounts(staged: DataFrame, current: DataFrame, staged_accounts: DataFrame) -> DataFrame:
    return rows_of(staged, durable(unknown_keys(staged, [current, staged_accounts], "account_id"), "missing"))


def missing_customers(staged: DataFrame, current: DataFrame, staged_customers: DataFrame) -> DataFrame:
    return rows_of(staged, durable(unknown_keys(staged, [current, staged_customers], "customer_id"), "missing"))


def missing_balances(staged: DataFrame, balances: DataFrame) -> DataFrame:
    return rows_of(staged, durable(unknown_keys(staged, [balances], "account_id"), "missing"))


def is_barred(date: Column) -> Column:
    """Accounts that take no new transactions: any end date, even a future one, or a start after the date."""
    return F.col("end_date").isNotNull() | (F.col("start_date") > date)


def barred_keys(unposted: DataFrame, accounts: DataFrame, date: dt.date) -> DataFrame:
    """Accounts of the batch's new transactions that take none on the date."""
    barred = accounts.where(is_barred(fx.day(date))).select("account_id")
    return unposted.select("account_id").distinct().join(barred, "account_id", "left_semi")


def ineligible(unposted: DataFrame, accounts: DataFrame, date: dt.date) -> DataFrame:
    """Transactions not yet posted on accounts that are barred once the batch's accounts are merged."""
    return rows_of(unposted, durable(barred_keys(unposted, accounts, date), "barred"))


def eligible_accounts(accounts: DataFrame, date: dt.date) -> DataFrame:
    return accounts.where(~is_barred(fx.day(date))).select("account_id")
