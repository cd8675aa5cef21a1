"""The given tables seen as a ledger.

Customers become accounts and customers, orders become transactions, events become arrivals. Every source row
takes part; what state a row is in follows from its own attributes (opening date, segment, order date, status),
and the faults a validator must find are planted by attribute too.

One-date book (batch date 1998-01-01): accounts opened before July 1997 are on file; those opened until the end
of 1998 arrive with the batch, together with full-record updates of the MACHINERY segment; those opened later
never arrive. Orders before the batch date on accounts on file are posted; later ones are staged, and the two
months before the batch date are sent again. Many-date book: every account is first sent in 1994, sent again
with the other type, and closed in 2000 when its balance attribute is low; 30 days after low-priority finished
orders the same transaction is sent again, from 1998 on with another amount when it is large.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.operators import merge, references

BATCH_DATE = dt.date(1998, 1, 1)
# Second copies of a record are this many lines further down.
COPY = 1_000_000_000_000


def _copies(extra: Column) -> Column:
    """Copy numbers of a record: 0, and 1 where ``extra`` holds."""
    return F.explode(F.when(extra, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _opened(key: Column) -> Column:
    return F.date_add(fx.day("1994-01-01"), ((key * 37) % 2000).cast("int"))


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


class Book:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.posted: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # One date: reference data

    @cached_property
    def accounts(self) -> DataFrame:
        opened = _opened(F.col("c_custkey"))
        return self.table("customer").select(
            "c_custkey",
            "c_mktsegment",
            "c_nationkey",
            (F.col("c_custkey") + 1).alias("account_id"),
            opened.alias("start_date"),
            F.when(F.col("c_acctbal") < -500, F.date_add(opened, 2000)).alias("end_date"),
            F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "SAVINGS")
            .otherwise("CHECKING")
            .alias("account_type"),
            (opened < fx.day("1997-07-01")).alias("on_file"),
            (
                ((opened >= fx.day("1997-07-01")) & (opened < fx.day("1999-01-01")))
                | ((opened < fx.day("1997-07-01")) & (F.col("c_mktsegment") == "MACHINERY"))
            ).alias("sent"),
        )

    @cached_property
    def core_account(self) -> DataFrame:
        return self.accounts.where("on_file").select("account_id", "start_date", "end_date", "account_type")

    @cached_property
    def stg_account(self) -> DataFrame:
        new, nation = ~F.col("on_file"), F.col("c_nationkey")
        return (
            self.accounts.where("sent")
            .withColumn("copy", _copies(new & (nation == 3)))
            .select(
                fx.day(BATCH_DATE).alias("batch_date"),
                F.lit("account_19980101.dat").alias("source_file"),
                (F.col("account_id") + F.col("copy") * F.lit(COPY)).alias("source_line"),
                "account_id",
                "start_date",
                F.when(new & (nation == 7), F.date_sub("start_date", 1))
                .when(~new & (nation < 5), F.lit(None))
                .otherwise(F.col("end_date"))
                .alias("end_date"),
                F.when(new, F.col("account_type")).otherwise("CHECKING").alias("account_type"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.table("customer")
            .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            .withColumn("on_file", _opened(F.col("c_custkey")) < fx.day("1997-07-01"))
            .withColumn(
                "sent",
                F.when(F.col("on_file"), F.col("c_mktsegment") == "MACHINERY").otherwise(
                    _opened(F.col("c_custkey")) < fx.day("1999-01-01")
                ),
            )
            .join(nation, "c_nationkey")
            .select(
                "c_nationkey",
                "on_file",
                "sent",
                (F.col("c_custkey") + 1).alias("customer_id"),
                F.substring("c_name", 1, 8).alias("first_name"),
                F.substring("c_name", 10, 9).alias("last_name"),
                F.col("c_name").alias("address_line1"),
                F.col("c_mktsegment").alias("city"),
                F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("province"),
                F.concat(F.lit("Z"), F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0")).alias(
                    "postal_code"
                ),
                F.col("n_name").alias("country"),
            )
        )

    CUSTOMER_VALUES = ["first_name", "last_name", "address_line1", "city", "province", "postal_code", "country"]

    @cached_property
    def core_customer(self) -> DataFrame:
        return self.customers.where("on_file").select("customer_id", *self.CUSTOMER_VALUES)

    @cached_property
    def stg_customer(self) -> DataFrame:
        return (
            self.customers.where("sent")
            .withColumn("copy", _copies(~F.col("on_file") & (F.col("c_nationkey") == 5)))
            .select(
                fx.day(BATCH_DATE).alias("batch_date"),
                F.lit("customer_19980101.dat").alias("source_file"),
                (F.col("customer_id") + F.col("copy") * F.lit(COPY)).alias("source_line"),
                "customer_id",
                F.when(F.col("on_file"), "Jo").otherwise(F.col("first_name")).alias("first_name"),
                *self.CUSTOMER_VALUES[1:],
            )
        )

    @cached_property
    def core_relationship(self) -> DataFrame:
        return self.accounts.where("on_file").select(
            "account_id", F.col("account_id").alias("customer_id"), F.lit("PRIMARY").alias("type")
        )

    @cached_property
    def stg_relationship(self) -> DataFrame:
        nation = F.col("c_nationkey")
        copies = F.when(nation == 8, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(0), F.lit(1))
        )
        second = F.col("copy") == 1
        return (
            self.accounts.where("sent")
            .withColumn("copy", F.explode(copies))
            .select(
                fx.day(BATCH_DATE).alias("batch_date"),
                F.lit("relationship_19980101.dat").alias("source_file"),
                (F.col("account_id") * 10 + F.col("copy")).alias("source_line"),
                "account_id",
                F.when(second & (nation == 9), F.col("account_id") + 900000000)
                .when(second, F.col("account_id") + 1)
                .otherwise(F.col("account_id"))
                .alias("customer_id"),
                F.when(second, "SECONDARY").otherwise("PRIMARY").alias("type"),
            )
        )

    # One date: transactions and balances

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderdate").cast("date").alias("batch_date"),
            (F.col("o_orderkey") + 1).alias("transaction_id"),
            (F.col("o_custkey") + 1).alias("account_id"),
            F.when(F.col("o_orderstatus") == "F", "DR").otherwise("CR").alias("type"),
            _cents(F.col("o_totalprice")).alias("amount"),
            (_opened(F.col("o_custkey")) < fx.day("1997-07-01")).alias("on_file"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def core_transaction(self) -> DataFrame:
        return self.transactions.where((F.col("batch_date") < fx.day(BATCH_DATE)) & F.col("on_file")).select(
            "transaction_id", "account_id", "type", "amount", "batch_date"
        )

    @cached_property
    def stg_transaction(self) -> DataFrame:
        fresh = F.col("batch_date") >= fx.day(BATCH_DATE)
        resent = (F.col("batch_date") >= fx.day("1997-11-01")) & F.col("on_file")
        twice = fresh & (F.col("status") == "P") & (F.col("priority") == "1-URGENT") & (F.col("amount") > 40000000)
        changed = ~fresh & (F.col("status") == "P") & (F.col("priority") == "5-LOW")
        return (
            self.transactions.where(fresh | resent | ~F.col("on_file"))
            .withColumn("copy", _copies(twice))
            .select(
                fx.day(BATCH_DATE).alias("batch_date"),
                F.lit("transaction_19980101.dat").alias("source_file"),
                (F.col("transaction_id") + F.col("copy") * F.lit(COPY)).alias("source_line"),
                "transaction_id",
                "account_id",
                "type",
                F.when(changed, F.col("amount") + 1).otherwise(F.col("amount")).alias("amount"),
            )
        )

    @cached_property
    def core_balance(self) -> DataFrame:
        sums = (
            self.core_transaction.select("account_id", fx.signed_amount(F.col("type"), F.col("amount")).alias("signed"))
            .groupBy("account_id")
            .agg(F.sum("signed").alias("total"))
        )
        return (
            self.core_account.select("account_id")
            .join(sums, "account_id", "left")
            .select("account_id", F.coalesce(F.col("total").cast("bigint"), F.lit(0)).alias("balance"))
        )

    # One date: the part of the batch that can be posted

    @cached_property
    def clean_customer(self) -> DataFrame:
        return self.stg_customer.where(F.col("source_line") < COPY)

    @cached_property
    def clean_account(self) -> DataFrame:
        return self.stg_account.where(
            (F.col("source_line") < COPY)
            & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("start_date")))
        )

    @cached_property
    def clean_relationship(self) -> DataFrame:
        known = self.core_customer.select("customer_id").union(self.clean_customer.select("customer_id")).distinct()
        valid = self.stg_relationship.join(known, "customer_id", "left_semi")
        unique = valid.groupBy("batch_date", "source_file", "account_id", "customer_id", "type").agg(
            F.min("source_line").alias("source_line")
        )
        return unique.join(self.effective_clean_account.select("account_id"), "account_id", "left_semi").select(
            *self.stg_relationship.columns
        )

    @cached_property
    def effective_clean_account(self) -> DataFrame:
        return merge.upsert(self.core_account, self.clean_account, ["account_id"])

    @cached_property
    def clean_marked(self) -> DataFrame:
        """Postable staged transactions with the ledger's contents of the same ID."""
        once = self.stg_transaction.where(F.col("source_line") < COPY)
        marked = references.with_posted(once, self.core_transaction)
        open_accounts = self.effective_clean_account.where(
            F.col("end_date").isNull() & (F.col("start_date") <= fx.day(BATCH_DATE))
        ).select("account_id", F.lit(True).alias("open"))
        same = F.col("posted").eqNullSafe(F.struct("account_id", "type", "amount"))
        return (
            marked.join(open_accounts, "account_id", "left")
            .where(same | (F.col("posted").isNull() & F.col("open")))
            .select(*marked.columns)
        )

    @cached_property
    def clean_transaction(self) -> DataFrame:
        return self.clean_marked.drop("posted")

    # Many dates

    @cached_property
    def account_feed(self) -> DataFrame:
        key = F.col("c_custkey")
        opened = F.date_add(fx.day("1994-03-01"), ((key * 37) % 300).cast("int"))
        closed = F.date_add(fx.day("2000-01-01"), ((key * 7) % 200).cast("int"))
        saving = F.col("c_mktsegment").isin("MACHINERY", "BUILDING")
        first = F.when(saving, "SAVINGS").otherwise("CHECKING")
        second = F.when(saving, "CHECKING").otherwise("SAVINGS")
        nothing = F.lit(None).cast("date")

        def sent(day: Column, end: Column, kind: Column) -> Column:
            return F.struct(
                day.alias("batch_date"), opened.alias("start_date"), end.alias("end_date"), kind.alias("account_type")
            )

        always = [sent(opened, nothing, first), sent(F.date_add(opened, 400), nothing, second)]
        records = F.when(
            F.col("c_acctbal") < -500, F.array(*always, sent(closed, closed, second))
        ).otherwise(F.array(*always))
        return self.table("customer").select(
            (key + 1).alias("account_id"), F.inline(records)
        ).select(
            "batch_date",
            F.concat(F.lit("account_"), F.date_format("batch_date", "yyyyMMdd"), F.lit(".dat")).alias("source_file"),
            F.col("account_id").alias("source_line"),
            "account_id",
            "start_date",
            "end_date",
            "account_type",
        )

    @cached_property
    def customer_feed(self) -> DataFrame:
        opened = F.date_add(fx.day("1994-03-01"), ((F.col("c_custkey") * 37) % 300).cast("int"))
        return self.table("customer").select(
            opened.alias("batch_date"),
            (F.col("c_custkey") + 1).alias("source_line"),
            (F.col("c_custkey") + 1).alias("customer_id"),
        )

    @cached_property
    def transaction_feed(self) -> DataFrame:
        again = (F.col("status") == "F") & (F.col("priority") == "5-LOW")
        changed = (F.col("amount") > 45000000) & (F.col("batch_date") >= fx.day("1998-01-01"))
        copy = F.col("copy")
        return (
            self.transactions.withColumn("copy", _copies(again))
            .withColumn("amount", F.when((copy == 1) & changed, F.col("amount") + 1).otherwise(F.col("amount")))
            .withColumn("batch_date", F.date_add("batch_date", copy * 30))
            .select(
                "batch_date",
                F.concat(F.lit("transaction_"), F.date_format("batch_date", "yyyyMMdd"), F.lit(".dat")).alias(
                    "source_file"
                ),
                (F.col("transaction_id") + copy * F.lit(COPY)).alias("source_line"),
                "transaction_id",
                "account_id",
                "type",
                "amount",
            )
        )

    @cached_property
    def line_items(self) -> DataFrame:
        """Line items as transactions of one date: the same order line may come several times."""
        return self.table("lineitem").select(
            fx.day(BATCH_DATE).alias("batch_date"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 1).alias("transaction_id"),
            (F.col("l_partkey") * 10000 + F.col("l_suppkey") + 1).alias("source_line"),
        )

    @cached_property
    def arrivals(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_type").alias("topic"),
            (F.col("user_id") % 4).alias("part"),
            F.col("event_id").alias("off"),
            (F.col("user_id") + 1).alias("account_id"),
            F.when(F.col("event_type") == "signup", F.col("ts").cast("date")).alias("control_date"),
            _cents(F.col("value")).alias("amount"),
        )

    # Control tables, one row per business date with orders

    @cached_property
    def business_dates(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("batch_date"))
            .agg(F.count(F.lit(1)).alias("orders"))
        )

    @cached_property
    def attempts(self) -> DataFrame:
        """Attempts per date: on the 15th the first fails and a second follows; July 2001 is open, with a failure
        on the 10th; dates on the 28th were never started."""
        date, k = F.col("batch_date"), F.col("k")
        july = fx.day("2001-07-01")
        return (
            self.business_dates.where(F.dayofmonth(date) != 28)
            .withColumn("k", F.explode(F.when(F.dayofmonth(date) == 15, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .where((date < july) | ((date == fx.day("2001-07-10")) & (k == 1)))
            .select(
                "batch_date",
                F.concat(F.date_format(date, "yyyyMMdd"), F.lit("-"), k.cast("string")).alias("batch_run_id"),
                F.when(((k == 1) & (F.dayofmonth(date) == 15)) | (date >= july), "FAILED")
                .otherwise("COMPLETED")
                .alias("status"),
                "k",
                "orders",
            )
        )

    @cached_property
    def run_events(self) -> DataFrame:
        """Each attempt as its two log events."""
        begun = F.timestamp_seconds(F.unix_date("batch_date") * 86400 + F.col("k") * 3600)
        ended = F.timestamp_seconds(F.unix_date("batch_date") * 86400 + F.col("k") * 3600 + 60)
        done = F.col("status") == "COMPLETED"

        def event(status: Column, at: Column, count: Column, message: Column) -> Column:
            return F.struct(status.alias("status"), at.alias("at"), count.alias("count"), message.alias("message"))

        none = F.lit(0).cast("bigint")
        start = event(F.lit("RUNNING"), begun, none, F.lit(None).cast("string"))
        finish = event(
            F.col("status"), ended, F.when(done, F.col("orders")).otherwise(none), F.when(~done, F.lit("rejected"))
        )
        events = self.attempts.select("batch_run_id", "batch_date", F.explode(F.array(start, finish)).alias("e"))
        return events.select(
            "batch_run_id",
            "batch_date",
            "e.status",
            "e.at",
            none.alias("customer_count"),
            none.alias("account_count"),
            none.alias("relationship_count"),
            F.col("e.count").alias("transaction_count"),
            F.col("e.message").alias("error_message"),
        )
