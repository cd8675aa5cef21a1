"""The set rules of a batch as one plan of violations, in the order a batch is judged."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.operators import merge, posting, references
from daybook.schemas import LAYOUTS
from daybook.session import durable

COLUMNS = ["rule_rank", "rule", "batch_date", "source_file", "source_line", "key", "message"]

# The order of the rules; the first that fails names the failure of the batch.
RULES = (
    "duplicate_customer",
    "duplicate_account",
    "duplicate_relationship",
    "duplicate_transaction",
    "account_dates",
    "conflicting_replay",
    "missing_account_relationship",
    "missing_account_transaction",
    "missing_customer",
    "ineligible_transaction",
    "balance_overflow",
    "missing_balance",
)


@dataclass(frozen=True)
class Staged:
    """The staged rows of one batch date."""

    date: dt.date
    customer: DataFrame
    account: DataFrame
    relationship: DataFrame
    transaction: DataFrame

    def table(self, record: str) -> DataFrame:
        return getattr(self, record)


@dataclass(frozen=True)
class State:
    """The published state a batch is judged against."""

    customer: DataFrame
    account: DataFrame
    relationship: DataFrame
    balance: DataFrame
    ledger: DataFrame


def duplicates(staged: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys that occur more than once within a date, with their first line."""
    return (
        staged.groupBy("batch_date", *keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min("source_line").alias("first_line"))
        .where(F.col("copies") > 1)
    )


def bad_account_dates(staged_accounts: DataFrame) -> DataFrame:
    return staged_accounts.where(F.col("end_date") < F.col("start_date"))


def effective_accounts(current: DataFrame, staged_accounts: DataFrame) -> DataFrame:
    """Account state once the batch is merged. Of duplicated records, themselves a violation, the first counts."""
    return merge.upsert(current, merge.first_copy(staged_accounts, ["account_id"]), ["account_id"])


def _key(columns: list[str]) -> Column:
    return F.concat_ws(",", *[F.col(c).cast("string") for c in columns])


def _violation(rows: DataFrame, rule: str, keys: list[str], message: Column, line: str = "source_line") -> DataFrame:
    source = F.col("source_file") if "source_file" in rows.columns else F.lit("")
    number = F.col(line) if line in rows.columns else F.lit(0)
    return rows.select(
        F.lit(RULES.index(rule) + 1).cast("bigint").alias("rule_rank"),
        F.lit(rule).alias("rule"),
        "batch_date",
        source.alias("source_file"),
        number.cast("bigint").alias("source_line"),
        _key(keys).alias("key"),
        message.alias("message"),
    )


def _at(text: str) -> Column:
    return F.concat(F.lit(f"{text} at "), "source_file", F.lit(":"), F.col("source_line").cast("string"))


def violations(staged: Staged, state: State, marked: DataFrame | None = None) -> DataFrame:
    """Every violation of every rule. An empty result means the batch may be posted.

    ``marked`` is the staged transactions with their ledger matches (``references.with_posted``); a pipeline
    passes the one it also posts from, so the ledger is met once.
    """
    if marked is None:
        marked = references.with_posted(staged.transaction, state.ledger)
    found = []
    for record, layout in LAYOUTS.items():
        keys = list(layout.keys)
        message = F.concat(
            F.lit(f"Duplicate {record} business key; first source line "), F.col("first_line").cast("string")
        )
        found.append(
            _violation(duplicates(staged.table(record), keys), f"duplicate_{record}", keys, message, "first_line")
        )
    found.append(
        _violation(
            bad_account_dates(staged.account),
            "account_dates",
            ["account_id"],
            _at("Account end date precedes start date"),
        )
    )
    found.append(
        _violation(
            references.conflicting(marked),
            "conflicting_replay",
            ["transaction_id"],
            _at("Conflicting transaction ID"),
        )
    )
    accounts = effective_accounts(state.account, staged.account)
    unposted = references.fresh(marked)
    opening = state.balance.unionByName(
        merge.initial_balances(merge.new_keys(staged.account, state.account, ["account_id"]))
    )
    overflow = posting.overflowing(opening, posting.account_deltas(unposted)).withColumn(
        "batch_date", fx.day(staged.date)
    )
    found.append(
        _violation(
            overflow,
            "balance_overflow",
            ["account_id"],
            F.concat(F.lit("Balance out of range for account "), F.col("account_id").cast("string")),
        )
    )
    # The offending keys of all reference rules are found and written by one job.
    on_file = [state.account, staged.account]
    offending = {
        "missing_account_relationship": references.unknown_keys(staged.relationship, on_file, "account_id"),
        "missing_account_transaction": references.unknown_keys(staged.transaction, on_file, "account_id"),
        "missing_customer": references.unknown_keys(
            staged.relationship, [state.customer, staged.customer], "customer_id"
        ),
        "ineligible_transaction": references.barred_keys(unposted, accounts, staged.date),
        "missing_balance": references.unknown_keys(staged.transaction, [opening], "account_id"),
    }
    keys = durable(
        reduce(
            DataFrame.unionByName,
            [df.select(F.lit(rule).alias("rule"), F.col(df.columns[0]).alias("key")) for rule, df in offending.items()],
        ),
        "offending-keys",
    )

    def offenders(rule: str, rows: DataFrame, on: str, shown: str, message: Column) -> DataFrame:
        of_rule = keys.where(F.col("rule") == rule).select(F.col("key").alias(on))
        return _violation(references.rows_of(rows, of_rule), rule, [shown], message)

    account, customer, transaction = "account_id", "customer_id", "transaction_id"
    no_account, no_customer = _at("Missing account"), _at("Missing customer")
    no_balance = F.lit("Missing balance for transaction account")
    found += [
        offenders("missing_account_relationship", staged.relationship, account, account, no_account),
        offenders("missing_account_transaction", staged.transaction, account, account, no_account),
        offenders("missing_customer", staged.relationship, customer, customer, no_customer),
        offenders("ineligible_transaction", unposted, account, transaction, _at("Ineligible transaction")),
        offenders("missing_balance", staged.transaction, account, account, no_balance),
    ]
    return reduce(DataFrame.unionByName, found)


def first_violation(found: DataFrame) -> DataFrame:
    """The headline: the lowest rule, then the lowest line."""
    return found.orderBy("rule_rank", "source_line", "source_file", "key").limit(1)
