"""Posting: signed amounts, the ledger append, exact balances and the dated snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.fields import checked_cents, in_cents_range, signed_amount

LEDGER_COLUMNS = ["transaction_id", "account_id", "type", "amount", "batch_date", "batch_run_id"]


def signed_amounts(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("signed", signed_amount(F.col("type"), F.col("amount")))


def account_deltas(transactions: DataFrame) -> DataFrame:
    """Net signed sum per account, exact past 64 bits; partial sums keep hot accounts cheap."""
    return (
        signed_amounts(transactions.select("account_id", "type", "amount"))
        .groupBy("account_id")
        .agg(F.sum("signed").alias("delta"))
    )


def ledger_rows(unposted: DataFrame, run_id: str) -> DataFrame:
    return unposted.withColumn("batch_run_id", F.lit(run_id)).select(*LEDGER_COLUMNS)


def _totals(balances: DataFrame, deltas: DataFrame) -> DataFrame:
    total = F.col("balance").cast("decimal(38,0)") + F.coalesce(F.col("delta"), F.lit(0).cast("decimal(29,0)"))
    return balances.join(deltas, "account_id", "left").withColumn("total", total)


def balances_after(balances: DataFrame, deltas: DataFrame) -> DataFrame:
    """Balances plus deltas; a final balance outside 64 bits stops the job, an intermediate one does not."""
    return _totals(balances, deltas).select("account_id", checked_cents(F.col("total")).alias("balance"))


def overflowing(balances: DataFrame, deltas: DataFrame) -> DataFrame:
    """Accounts whose final balance would leave 64 bits, as a report."""
    return _totals(balances, deltas).where(~in_cents_range(F.col("total"))).select("account_id", "total")


def snapshot_members(new_accounts: DataFrame, posted: DataFrame) -> DataFrame:
    """Accounts created by the batch and accounts with at least one new posting, each once."""
    return new_accounts.select("account_id").union(posted.select("account_id")).distinct()


def balance_snapshot(members: DataFrame, balances: DataFrame) -> DataFrame:
    return members.join(balances.select("account_id", "balance"), "account_id")


def snapshot_header(members: DataFrame) -> DataFrame:
    return members.agg(F.count(F.lit(1)).alias("record_count"))


def applied_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows applied per record type, one small row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("applied")).select(F.lit(record).alias("record"), "applied")
        for record, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
