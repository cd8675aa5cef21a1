"""Registered queries: every operator over the book's views, with its SQL beside it.

Each function takes the book and returns a DataFrame; ``QUERIES`` and ``SQL`` are keyed alike. Dates are shown as
ISO text so that both sides compare as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import fields as fx
from daybook.functions.ranking import with_position
from daybook.operators import admission, audits, generate, merge, posting, references, rules, staging
from daybook.plans import backfill
from daybook.plans.book import BATCH_DATE, Book
from daybook.plans.oracle import statement
from daybook.plans.store import BUCKETS
from daybook.schemas import ACCOUNT, ACCOUNT_TYPES, CUSTOMER, LAYOUTS, LEDGER, RELATIONSHIP, RELATIONSHIP_TYPES, TRANSACTION, TRANSACTION_TYPES, Layout
from daybook.session import durable, scratch_path
from daybook.sources import files, fixed_width
from daybook.sources.buckets import BucketedTable
from daybook.sources.values import read_values
from daybook.streaming import balances as balance_stream
from daybook.streaming import clock, keyed_clock, offsets, staged

QUERIES: dict[str, Callable[[Book], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(make: Callable[[Book], DataFrame]):
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = statement(sql)
        return make

    return register


def shown(df: DataFrame) -> DataFrame:
    """Dates as ISO text."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields
    ])


def run(name: str, spark, sf_dir: str) -> DataFrame:
    return shown(QUERIES[name](Book(spark, sf_dir)))


def _staged(book: Book) -> rules.Staged:
    return rules.Staged(BATCH_DATE, book.stg_customer, book.stg_account, book.stg_relationship, book.stg_transaction)


def _state(book: Book) -> rules.State:
    return rules.State(
        book.core_customer, book.core_account, book.core_relationship, book.core_balance, book.core_transaction
    )


def _feeds(book: Book) -> backfill.Feeds:
    return backfill.Feeds(
        customer=book.customer_feed,
        account=book.account_feed,
        relationship=book.customer_feed.select(
            "batch_date", "source_line", F.col("customer_id").alias("account_id"), "customer_id"
        ),
        transaction=book.transaction_feed,
    )


def _clean_new_accounts(book: Book) -> DataFrame:
    return merge.new_keys(book.clean_account, book.core_account, ["account_id"])


def _clean_posted(book: Book) -> DataFrame:
    """The new postings of the batch, met with the ledger once and written, as a run does."""
    if book.posted is None:
        book.posted = durable(references.fresh(book.clean_marked), "posted")
    return book.posted


def _clean_balances(book: Book) -> DataFrame:
    opening = book.core_balance.unionByName(merge.initial_balances(_clean_new_accounts(book)))
    return posting.balances_after(opening, posting.account_deltas(_clean_posted(book)))


def _clean_members(book: Book) -> DataFrame:
    return posting.snapshot_members(_clean_new_accounts(book), _clean_posted(book))


def _clean_snapshot(book: Book) -> DataFrame:
    return posting.balance_snapshot(_clean_members(book), _clean_balances(book))


# Posting

@query("account_deltas", """
    SELECT account_id, CAST(sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS BIGINT) AS delta
    FROM txn_all GROUP BY account_id""")
def account_deltas(book):
    return posting.account_deltas(book.transactions).select("account_id", fx.checked_cents(F.col("delta")).alias("delta"))


@query("signed_amounts", """
    SELECT transaction_id, account_id, CASE WHEN type = 'CR' THEN amount ELSE -amount END AS signed FROM txn_all""")
def signed_amounts(book):
    return posting.signed_amounts(book.transactions).select(
        "transaction_id", "account_id", F.col("signed").cast("bigint").alias("signed")
    )


@query("balance_snapshot", "SELECT account_id, balance FROM clean_snapshot")
def balance_snapshot(book):
    return _clean_snapshot(book)


@query("snapshot_headers", "SELECT '1998-01-01' AS batch_date, count(*) AS record_count FROM clean_snapshot")
def snapshot_headers(book):
    return posting.snapshot_header(_clean_members(book)).select(fx.day(BATCH_DATE).alias("batch_date"), "record_count")


@query("balance_file_lines", """
    SELECT row_number() OVER (ORDER BY account_id) AS line_number,
           lpad(CAST(account_id AS VARCHAR), 19, ' ') || lpad(CAST(balance AS VARCHAR), 20, ' ') AS line
    FROM clean_snapshot""")
def balance_file_lines(book):
    """The published file, read back with its line numbers."""
    rows = durable(_clean_snapshot(book), "snapshot")
    lines = rows.select("account_id", fx.balance_line(F.col("account_id"), F.col("balance")).alias("value"))
    target = f"{scratch_path(book.spark, 'output')}/balance_19980101.dat"
    files.publish_lines(lines, ["account_id"], target, empty=rows.isEmpty(), as_parts=True)
    return fixed_width.plain_lines(book.spark, target).select(
        F.col("source_line").alias("line_number"), F.col("value").alias("line")
    )


@query("balances_after_run", "SELECT account_id, balance FROM clean_balance_after")
def balances_after_run(book):
    return _clean_balances(book)


@query("initial_balances", "SELECT account_id, CAST(0 AS BIGINT) AS balance FROM clean_new_account")
def initial_balances(book):
    return merge.initial_balances(_clean_new_accounts(book))


@query("new_accounts", "SELECT account_id FROM new_account")
def new_accounts(book):
    return merge.new_keys(book.stg_account, book.core_account, ["account_id"])


@query("ledger_append", """
    SELECT transaction_id, account_id, type, amount, CAST(batch_date AS VARCHAR) AS batch_date,
           'run-1' AS batch_run_id FROM clean_posted""")
def ledger_append(book):
    marked = references.with_posted(book.clean_transaction, book.core_transaction)
    return posting.ledger_rows(references.fresh(marked), "run-1")


@query("applied_counts", """
    SELECT 'customer' AS record, count(*) AS applied FROM clean_customer
    UNION ALL SELECT 'account', count(*) FROM clean_account
    UNION ALL SELECT 'relationship', count(*) FROM clean_relationship
    UNION ALL SELECT 'transaction', count(*) FROM clean_posted""")
def applied_counts(book):
    return posting.applied_counts({
        "customer": book.clean_customer,
        "account": book.clean_account,
        "relationship": book.clean_relationship,
        "transaction": _clean_posted(book),
    })


# Merges

@query("upsert_customer", """
    SELECT customer_id, first_name, last_name, address_line1, city, province, postal_code, country FROM clean_customer
    UNION ALL SELECT * FROM core_customer c
    WHERE NOT EXISTS (SELECT 1 FROM clean_customer s WHERE s.customer_id = c.customer_id)""")
def upsert_customer(book):
    return merge.upsert(book.core_customer, book.clean_customer, ["customer_id"])


@query("upsert_account", """
    SELECT account_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, account_type
    FROM effective_clean_account""")
def upsert_account(book):
    return book.effective_clean_account


@query("upsert_relationship", """
    SELECT account_id, customer_id, type FROM clean_relationship
    UNION ALL SELECT * FROM core_relationship c
    WHERE NOT EXISTS (SELECT 1 FROM clean_relationship s
                      WHERE s.account_id = c.account_id AND s.customer_id = c.customer_id)""")
def upsert_relationship(book):
    return merge.upsert(book.core_relationship, book.clean_relationship, ["account_id", "customer_id"])


# Duplicates

_DUPLICATES = """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, {keys}, count(*) AS copies, min(source_line) AS first_line
    FROM {view} GROUP BY batch_date, {keys} HAVING count(*) > 1"""


@query("dup_customer", _DUPLICATES.format(keys="customer_id", view="stg_customer"))
def dup_customer(book):
    return rules.duplicates(book.stg_customer, ["customer_id"])


@query("dup_account", _DUPLICATES.format(keys="account_id", view="stg_account"))
def dup_account(book):
    return rules.duplicates(book.stg_account, ["account_id"])


@query("dup_relationship", _DUPLICATES.format(keys="account_id, customer_id", view="stg_relationship"))
def dup_relationship(book):
    return rules.duplicates(book.stg_relationship, ["account_id", "customer_id"])


@query("dup_transaction", _DUPLICATES.format(keys="transaction_id", view="stg_transaction"))
def dup_transaction(book):
    return rules.duplicates(book.stg_transaction, ["transaction_id"])


@query("dup_transaction_lines", _DUPLICATES.format(keys="transaction_id", view="line_item_txn"))
def dup_transaction_lines(book):
    return rules.duplicates(book.line_items, ["transaction_id"])


# References and rules

@query("missing_accounts", """
    SELECT record, source_file, source_line, account_id
    FROM (SELECT 'relationship' AS record, source_file, source_line, account_id FROM stg_relationship
          UNION ALL SELECT 'transaction', source_file, source_line, account_id FROM stg_transaction) t
    WHERE NOT EXISTS (SELECT 1 FROM core_account a WHERE a.account_id = t.account_id)
      AND NOT EXISTS (SELECT 1 FROM stg_account a WHERE a.account_id = t.account_id)""")
def missing_accounts(book):
    parts = [
        references.missing_accounts(rows, book.core_account, book.stg_account).select(
            F.lit(record).alias("record"), "source_file", "source_line", "account_id"
        )
        for record, rows in (("relationship", book.stg_relationship), ("transaction", book.stg_transaction))
    ]
    return parts[0].unionByName(parts[1])


@query("missing_customers", """
    SELECT source_file, source_line, customer_id FROM stg_relationship t
    WHERE NOT EXISTS (SELECT 1 FROM core_customer a WHERE a.customer_id = t.customer_id)
      AND NOT EXISTS (SELECT 1 FROM stg_customer a WHERE a.customer_id = t.customer_id)""")
def missing_customers(book):
    return references.missing_customers(book.stg_relationship, book.core_customer, book.stg_customer).select(
        "source_file", "source_line", "customer_id"
    )


@query("missing_balances", """
    SELECT source_line, transaction_id, account_id FROM stg_transaction t
    WHERE NOT EXISTS (SELECT 1 FROM opening_balance b WHERE b.account_id = t.account_id)""")
def missing_balances(book):
    opening = book.core_balance.unionByName(merge.initial_balances(new_accounts(book)))
    return references.missing_balances(book.stg_transaction, opening).select(
        "source_line", "transaction_id", "account_id"
    )


@query("bad_account_dates", """
    SELECT source_line, account_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
    FROM stg_account WHERE end_date < start_date""")
def bad_account_dates(book):
    return rules.bad_account_dates(book.stg_account).select("source_line", "account_id", "start_date", "end_date")


@query("conflicting_replays", """
    SELECT source_line, transaction_id, amount, posted_amount
    FROM stg_transaction SEMI JOIN (
      SELECT transaction_id, account_id, type, amount FROM stg_transaction
      EXCEPT SELECT transaction_id, account_id, type, amount FROM core_transaction) AS unlike
      USING (transaction_id, account_id, type, amount)
    JOIN (SELECT transaction_id, amount AS posted_amount FROM core_transaction) AS kept USING (transaction_id)""")
def conflicting_replays(book):
    marked = references.with_posted(book.stg_transaction, book.core_transaction)
    return references.conflicting(marked).select(
        "source_line", "transaction_id", "amount", F.col("posted.amount").alias("posted_amount")
    )


@query("replayed_transactions", """
    SELECT t.source_line, t.transaction_id
    FROM stg_transaction t JOIN core_transaction o ON t.transaction_id = o.transaction_id
    WHERE t.account_id = o.account_id AND t.type = o.type AND t.amount = o.amount""")
def replayed_transactions(book):
    marked = references.with_posted(book.stg_transaction, book.core_transaction)
    return references.replayed(marked).select("source_line", "transaction_id")


@query("bucketed_ledger_matches", """
    SELECT t.source_line, t.transaction_id,
           CASE WHEN o.transaction_id IS NULL THEN 'new'
                WHEN t.account_id = o.account_id AND t.type = o.type AND t.amount = o.amount THEN 'replayed'
                ELSE 'conflicting' END AS standing
    FROM stg_transaction t LEFT JOIN core_transaction o ON t.transaction_id = o.transaction_id""")
def bucketed_ledger_matches(book):
    """The ledger as two runs of a bucketed table, even and odd IDs; the batch meets it where it is."""
    root = scratch_path(book.spark, "ledger")
    table = BucketedTable(book.spark, root, LEDGER, ["transaction_id"], BUCKETS, ("batch_date", "batch_run_id"))
    posted = book.core_transaction.select("transaction_id", "account_id", "type", "amount")
    for parity in (0, 1):
        table.append(posted.where(F.col("transaction_id") % 2 == parity), (BATCH_DATE, f"run-{parity}"))
    marked = references.with_posted(book.stg_transaction, table.rows(), BUCKETS)
    same = F.col("posted").eqNullSafe(F.struct(*references.CONTENTS))
    standing = F.when(F.col("posted").isNull(), "new").when(same, "replayed").otherwise("conflicting")
    return marked.select("source_line", "transaction_id", standing.alias("standing"))


# A transaction that is not in the ledger needs an open account that has begun: what is left over is ineligible.
_INELIGIBLE = """
    SELECT t.source_file, t.source_line, t.transaction_id, t.account_id
    FROM stg_transaction t
    WHERE t.transaction_id IN (SELECT transaction_id FROM stg_transaction EXCEPT SELECT transaction_id FROM core_transaction)
      AND t.account_id IN (SELECT account_id FROM effective_account)
      AND t.account_id NOT IN (SELECT account_id FROM effective_account WHERE end_date IS NULL AND start_date <= t.batch_date)"""


@query("ineligible_transactions", _INELIGIBLE)
def ineligible_transactions(book):
    unposted = references.fresh(references.with_posted(book.stg_transaction, book.core_transaction))
    accounts = rules.effective_accounts(book.core_account, book.stg_account)
    return references.ineligible(unposted, accounts, BATCH_DATE).select(
        "source_file", "source_line", "transaction_id", "account_id"
    )


def _duplicate_rule(rank: int, record: str, keys: str, key: str) -> str:
    return f"""
    SELECT {rank} AS rule_rank, 'duplicate_{record}' AS rule, batch_date, '' AS source_file,
           min(source_line) AS source_line, {key} AS key,
           'Duplicate {record} business key; first source line ' || CAST(min(source_line) AS VARCHAR) AS message
    FROM stg_{record} GROUP BY batch_date, {keys} HAVING count(*) > 1"""


def _line_rule(rank: int, rule: str, text: str, key: str, source: str) -> str:
    return f"""
    SELECT {rank}, '{rule}', batch_date, source_file, source_line, CAST({key} AS VARCHAR),
           '{text} at ' || source_file || ':' || CAST(source_line AS VARCHAR)
    FROM ({source}) s"""


_UNKNOWN = """SELECT * FROM stg_{0} WHERE {1}_id IN (
    SELECT {1}_id FROM stg_{0} EXCEPT (SELECT {1}_id FROM core_{1} UNION SELECT {1}_id FROM stg_{1}))"""

_VIOLATIONS = " UNION ALL ".join([
    _duplicate_rule(1, "customer", "customer_id", "CAST(customer_id AS VARCHAR)"),
    _duplicate_rule(2, "account", "account_id", "CAST(account_id AS VARCHAR)"),
    _duplicate_rule(
        3, "relationship", "account_id, customer_id",
        "CAST(account_id AS VARCHAR) || ',' || CAST(customer_id AS VARCHAR)",
    ),
    _duplicate_rule(4, "transaction", "transaction_id", "CAST(transaction_id AS VARCHAR)"),
    _line_rule(
        5, "account_dates", "Account end date precedes start date", "account_id",
        "SELECT * FROM stg_account WHERE end_date < start_date",
    ),
    _line_rule(
        6, "conflicting_replay", "Conflicting transaction ID", "transaction_id",
        """SELECT * FROM stg_transaction WHERE transaction_id IN (SELECT transaction_id FROM core_transaction)
           AND (transaction_id, account_id, type, amount) NOT IN (
             SELECT (transaction_id, account_id, type, amount) FROM core_transaction)""",
    ),
    _line_rule(7, "missing_account_relationship", "Missing account", "account_id", _UNKNOWN.format("relationship", "account")),
    _line_rule(8, "missing_account_transaction", "Missing account", "account_id", _UNKNOWN.format("transaction", "account")),
    _line_rule(
        9, "missing_customer", "Missing customer", "customer_id",
        _UNKNOWN.format("relationship", "customer"),
    ),
    _line_rule(
        10, "ineligible_transaction", "Ineligible transaction", "transaction_id",
        _INELIGIBLE.replace("t.source_file,", "t.batch_date, t.source_file,"),
    ),
    """
    SELECT 11, 'balance_overflow', DATE '1998-01-01', '', 0, CAST(b.account_id AS VARCHAR),
           'Balance out of range for account ' || CAST(b.account_id AS VARCHAR)
    FROM opening_balance b JOIN (
      SELECT account_id, sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS delta FROM stg_transaction t
      WHERE NOT EXISTS (SELECT 1 FROM core_transaction o WHERE o.transaction_id = t.transaction_id)
      GROUP BY account_id) d ON b.account_id = d.account_id
    WHERE b.balance + d.delta NOT BETWEEN -9223372036854775808 AND 9223372036854775807""",
    """
    SELECT 12, 'missing_balance', batch_date, source_file, source_line, CAST(account_id AS VARCHAR),
           'Missing balance for transaction account'
    FROM stg_transaction t
    WHERE NOT EXISTS (SELECT 1 FROM opening_balance b WHERE b.account_id = t.account_id)""",
])

_VIOLATION_COLUMNS = """CAST(rule_rank AS BIGINT) AS rule_rank, rule, CAST(batch_date AS VARCHAR) AS batch_date,
    source_file, CAST(source_line AS BIGINT) AS source_line, key, message"""


@query("violations_report", f"SELECT {_VIOLATION_COLUMNS} FROM ({_VIOLATIONS}) v")
def violations_report(book):
    return rules.violations(_staged(book), _state(book))


@query("first_violation", f"""
    SELECT {_VIOLATION_COLUMNS} FROM ({_VIOLATIONS}) v ORDER BY rule_rank, source_line, source_file, key LIMIT 1""")
def first_violation(book):
    return rules.first_violation(violations_report(book))


# Audits

@query("fk_audit", """
    SELECT 'relationship_account' AS constraint_name, CAST(account_id AS VARCHAR) AS key, count(*) AS rows
    FROM stg_relationship c WHERE NOT EXISTS (SELECT 1 FROM effective_account p WHERE p.account_id = c.account_id)
    GROUP BY account_id
    UNION ALL
    SELECT 'relationship_customer', CAST(customer_id AS VARCHAR), count(*) FROM stg_relationship c
    WHERE NOT EXISTS (SELECT 1 FROM cust_all p WHERE p.customer_id = c.customer_id AND (on_file OR sent))
    GROUP BY customer_id
    UNION ALL
    SELECT 'balance_account', CAST(account_id AS VARCHAR), count(*) FROM opening_balance c
    WHERE NOT EXISTS (SELECT 1 FROM core_account p WHERE p.account_id = c.account_id) GROUP BY account_id
    UNION ALL
    SELECT 'transaction_account', CAST(account_id AS VARCHAR), count(*) FROM txn_all c
    WHERE NOT EXISTS (SELECT 1 FROM effective_account p WHERE p.account_id = c.account_id) GROUP BY account_id
    UNION ALL
    SELECT 'transaction_run', strftime(batch_date, '%Y%m%d') || '-1,' || CAST(batch_date AS VARCHAR), count(*)
    FROM txn_all c
    WHERE NOT EXISTS (SELECT 1 FROM attempt p WHERE p.batch_date = c.batch_date AND p.k = 1) GROUP BY batch_date
    UNION ALL
    SELECT 'snapshot_header', CAST(batch_date AS VARCHAR), count(*) FROM md_delta c
    WHERE NOT EXISTS (SELECT 1 FROM attempt p WHERE p.batch_date = c.batch_date AND p.status = 'COMPLETED')
    GROUP BY batch_date
    UNION ALL
    SELECT 'snapshot_run', strftime(batch_date, '%Y%m%d') || '-2,' || CAST(batch_date AS VARCHAR), count(*) FROM md_delta c
    WHERE day(batch_date) >= 15
      AND NOT EXISTS (SELECT 1 FROM attempt p WHERE p.batch_date = c.batch_date AND p.k = 2) GROUP BY batch_date""")
def fk_audit(book):
    accounts = rules.effective_accounts(book.core_account, book.stg_account)
    customers = merge.upsert(book.core_customer, book.stg_customer.dropDuplicates(["customer_id"]), ["customer_id"])
    opening = book.core_balance.unionByName(merge.initial_balances(new_accounts(book)))
    first_run = F.concat(F.date_format("batch_date", "yyyyMMdd"), F.lit("-1")).alias("batch_run_id")
    headers = book.attempts.where(F.col("status") == "COMPLETED").select("batch_date")
    second_run = F.concat(F.date_format("batch_date", "yyyyMMdd"), F.lit("-2")).alias("batch_run_id")
    late = backfill.daily_deltas(backfill.winners(book.transaction_feed)).where(F.dayofmonth("batch_date") >= 15)
    return audits.fk_audit([
        ("snapshot_run", late.select(second_run, "batch_date"), book.attempts, ["batch_run_id", "batch_date"]),
        ("relationship_account", book.stg_relationship, accounts, ["account_id"]),
        ("relationship_customer", book.stg_relationship, customers, ["customer_id"]),
        ("balance_account", opening, book.core_account, ["account_id"]),
        ("transaction_account", book.transactions, accounts, ["account_id"]),
        (
            "transaction_run",
            book.transactions.select(first_run, "batch_date"),
            book.attempts,
            ["batch_run_id", "batch_date"],
        ),
        (
            "snapshot_header",
            backfill.daily_deltas(backfill.winners(book.transaction_feed)),
            headers,
            ["batch_date"],
        ),
    ])


@query("pk_audit", """
    SELECT 'customer' AS table_name, CAST(customer_id AS VARCHAR) AS key, count(*) AS rows
    FROM cust_all GROUP BY customer_id HAVING count(*) > 1
    UNION ALL SELECT 'account', CAST(account_id AS VARCHAR), count(*) FROM core_account
    GROUP BY account_id HAVING count(*) > 1
    UNION ALL SELECT 'relationship', CAST(account_id AS VARCHAR) || ',' || CAST(customer_id AS VARCHAR), count(*)
    FROM stg_relationship GROUP BY account_id, customer_id HAVING count(*) > 1
    UNION ALL SELECT 'balance', CAST(account_id AS VARCHAR), count(*) FROM core_balance
    GROUP BY account_id HAVING count(*) > 1
    UNION ALL SELECT 'ledger', CAST(transaction_id AS VARCHAR), count(*) FROM txn_feed
    GROUP BY transaction_id HAVING count(*) > 1
    UNION ALL SELECT 'snapshot', CAST(batch_date AS VARCHAR) || ',' || CAST(account_id AS VARCHAR), count(*)
    FROM md_delta GROUP BY batch_date, account_id HAVING count(*) > 1
    UNION ALL SELECT 'staged_line', CAST(batch_date AS VARCHAR) || ',' || CAST(source_line AS VARCHAR), count(*)
    FROM line_item_txn GROUP BY batch_date, source_line HAVING count(*) > 1""")
def pk_audit(book):
    deltas = durable(backfill.daily_deltas(backfill.winners(book.transaction_feed)), "deltas")
    return audits.pk_audit({
        "customer": (book.customers, ["customer_id"]),
        "account": (book.core_account, ["account_id"]),
        "relationship": (book.stg_relationship, ["account_id", "customer_id"]),
        "balance": (book.core_balance, ["account_id"]),
        "ledger": (book.transaction_feed, ["transaction_id"]),
        "snapshot": (deltas, ["batch_date", "account_id"]),
        "staged_line": (book.line_items, ["batch_date", "source_line"]),
    })


@query("check_audit", """
    SELECT 'opening_credit' AS table_name, 'type_known' AS check_name, CAST(transaction_id AS VARCHAR) AS key
    FROM opening_credit WHERE type NOT IN ('CR', 'DR')
    UNION ALL SELECT 'opening_credit', 'amount_nonnegative', CAST(transaction_id AS VARCHAR)
    FROM opening_credit WHERE amount < 0
    UNION ALL SELECT 'staged_account', 'end_date_order', CAST(account_id AS VARCHAR)
    FROM stg_account WHERE end_date < start_date
    UNION ALL SELECT 'customer', 'last_name_width', CAST(customer_id AS VARCHAR) FROM cust_all WHERE length(last_name) > 10
    UNION ALL SELECT 'supplier', 'first_name_width', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE length(s_name) > 10
    UNION ALL SELECT 'supplier', 'customer_id_positive', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey <= 0
    UNION ALL SELECT 'supplier', 'city_not_null', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0""")
def check_audit(book):
    customer = book.table("customer")
    segment = F.col("c_mktsegment")
    opening = customer.select(
        (F.col("c_custkey") + 1).alias("transaction_id"),
        (F.col("c_custkey") + 1).alias("account_id"),
        F.when(segment == "MACHINERY", "DR").when(segment == "FURNITURE", "credit").otherwise("CR").alias("type"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("amount"),
    )
    supplier = book.table("supplier").select(
        F.col("s_suppkey").cast("bigint").alias("customer_id"),
        F.col("s_name").alias("first_name"),
        F.lit("").alias("last_name"),
        F.lit("").alias("address_line1"),
        F.when(F.col("s_acctbal") >= 0, "").alias("city"),
        *[F.lit("").alias(c) for c in ("province", "postal_code", "country")],
    )
    return audits.check_audit({
        "opening_credit": ("transaction", opening),
        "staged_account": ("account", book.stg_account),
        "staged_relationship": ("relationship", book.stg_relationship),
        "staged_transaction": ("transaction", book.stg_transaction),
        "customer": ("customer", book.customers),
        "supplier": ("customer", supplier),
    })


@query("run_audit", """
    SELECT 'completion_time_state' AS rule, CAST(batch_date AS VARCHAR) AS batch_date, batch_run_id AS key
    FROM attempt WHERE status = 'FAILED' AND month(batch_date) = 5
    UNION ALL SELECT 'completed_before_start', CAST(batch_date AS VARCHAR), batch_run_id
    FROM attempt WHERE month(batch_date) = 7
    UNION ALL SELECT 'message_without_failure', CAST(batch_date AS VARCHAR), batch_run_id
    FROM attempt WHERE status = 'COMPLETED' AND month(batch_date) = 9
    UNION ALL SELECT 'one_active_attempt', CAST(batch_date AS VARCHAR), '2' FROM attempt
    WHERE month(batch_date) = 3 AND status = 'COMPLETED'""")
def run_audit(book):
    """Attempts with a different fault in March, May, July and September."""
    month, failed = F.month("batch_date"), F.col("status") == "FAILED"
    begun = F.timestamp_seconds(F.unix_date("batch_date") * 86400 + F.col("k") * 3600)
    copies = F.when((month == 3) & ~failed, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = F.col("copy") == 1
    runs = book.attempts.withColumn("copy", F.explode(copies)).select(
        F.when(again, F.concat("batch_run_id", F.lit("-again"))).otherwise(F.col("batch_run_id")).alias("batch_run_id"),
        "batch_date",
        "status",
        begun.alias("started_at"),
        F.when(failed & (month == 5), F.lit(None))
        .when(month == 7, begun - F.expr("INTERVAL 1 HOUR"))
        .otherwise(begun + F.expr("INTERVAL 1 HOUR"))
        .alias("completed_at"),
        F.when(failed | (month == 9), F.lit("note")).alias("error_message"),
    )
    return audits.run_audit(runs)


@query("ledger_immutability", """
    SELECT transaction_id, CASE WHEN status = 'P' THEN 'vanished' ELSE 'changed' END AS change FROM txn_all
    WHERE on_file AND batch_date < DATE '1998-01-01'
      AND ((status = 'P' AND priority = '5-LOW') OR (status = 'O' AND priority = '1-URGENT'))""")
def ledger_immutability(book):
    status, priority = F.col("status"), F.col("priority")
    later = book.transactions.where(~((status == "P") & (priority == "5-LOW"))).withColumn(
        "amount", F.when((status == "O") & (priority == "1-URGENT"), F.col("amount") + 1).otherwise(F.col("amount"))
    )
    return audits.immutability(book.core_transaction, later, ["transaction_id"])


SQL_OF_SNAPSHOTS = """
    SELECT CAST(b.batch_date AS VARCHAR) AS batch_date, b.account_id,
           CASE WHEN a.account_id IS NULL THEN 'vanished' ELSE 'changed' END AS change
    FROM (SELECT account_id, batch_date, sum(delta) OVER (PARTITION BY account_id ORDER BY batch_date) AS balance
          FROM md_delta) b
    LEFT JOIN (
      SELECT account_id, batch_date, sum(delta) OVER (PARTITION BY account_id ORDER BY batch_date) AS balance
      FROM (SELECT account_id, batch_date, sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS delta
            FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY batch_date DESC, source_line DESC)
                    AS rn FROM txn_feed) WHERE rn = 1 GROUP BY account_id, batch_date)) a
      ON a.account_id = b.account_id AND a.batch_date = b.batch_date
    WHERE a.account_id IS NULL OR a.balance <> b.balance"""


@query("snapshot_immutability", SQL_OF_SNAPSHOTS)
def snapshot_immutability(book):
    """Snapshots of the first postings against those a last-one-wins rewrite would give."""
    last = merge.latest_record(
        book.transaction_feed.drop("source_file"), ["transaction_id"], ["batch_date", "source_line"]
    )
    return audits.immutability(
        backfill.closing_balances(backfill.winners(book.transaction_feed)),
        backfill.closing_balances(last),
        ["batch_date", "account_id"],
    )


@query("snapshot_immutability_by_digest", SQL_OF_SNAPSHOTS)
def snapshot_immutability_by_digest(book):
    """As ``snapshot_immutability``, with rows compared only where the digests of a date differ."""
    last = merge.latest_record(
        book.transaction_feed.drop("source_file"), ["transaction_id"], ["batch_date", "source_line"]
    )
    before = durable(backfill.closing_balances(backfill.winners(book.transaction_feed)), "snapshots-before")
    after = durable(backfill.closing_balances(last), "snapshots-after")
    return audits.immutability_by_digest(before, after, ["batch_date", "account_id"], ["batch_date"])


# Staging and control

@query("staging_by_date", """
    SELECT transaction_id, account_id, type, amount FROM txn_feed WHERE batch_date = DATE '1998-01-01'""")
def staging_by_date(book):
    return staging.staging_by_date(book.transaction_feed, BATCH_DATE).select(
        "transaction_id", "account_id", "type", "amount"
    )


@query("staged_counts", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, 'account' AS record, count(*) AS rows FROM account_feed GROUP BY 1
    UNION ALL SELECT CAST(batch_date AS VARCHAR), 'transaction', count(*) FROM txn_feed GROUP BY 1
    UNION ALL SELECT CAST(batch_date AS VARCHAR), 'customer', count(*) FROM stg_customer GROUP BY 1
    UNION ALL SELECT CAST(batch_date AS VARCHAR), 'relationship', count(*) FROM stg_relationship GROUP BY 1""")
def staged_counts(book):
    return staging.staged_counts({
        "customer": book.stg_customer,
        "account": book.account_feed,
        "relationship": book.stg_relationship,
        "transaction": book.transaction_feed,
    })


@query("staging_replace", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, transaction_id, amount FROM txn_feed
    WHERE year(batch_date) <> 1998
    UNION ALL
    SELECT CAST(batch_date AS VARCHAR), transaction_id, amount + 5 FROM txn_all
    WHERE batch_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'""")
def staging_replace(book):
    """The dates of 1998 are loaded again: other amounts in the first half, empty files in the second."""
    feed = book.transaction_feed.select("batch_date", "transaction_id", "amount")
    dates = feed.where(F.year("batch_date") == 1998).select("batch_date").distinct()
    first_half = F.col("batch_date").between("1998-01-01", "1998-06-30")
    incoming = book.transactions.where(first_half).select(
        "batch_date", "transaction_id", (F.col("amount") + 5).alias("amount")
    )
    return staging.replace_by_date(feed, incoming, dates)


@query("staging_latest", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, account_id, event_id, amount
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_date, account_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM stamped WHERE batch_date IS NOT NULL) WHERE rn = 1""")
def staging_latest(book):
    rows = _stamped(book).where(F.col("batch_date").isNotNull()).select(
        "batch_date", "account_id", "ts", "event_id", "amount"
    )
    return staging.staging_latest(rows, ["account_id"], ["ts", "event_id"]).drop("ts")


@query("receipts_latest", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ingested_at
    FROM events GROUP BY CAST(ts AS DATE)""")
def receipts_latest(book):
    receipts = book.arrivals.select(F.to_date("ts").alias("batch_date"), F.col("ts").alias("ingested_at"))
    return staging.receipts_latest(receipts).select(
        "batch_date", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at")
    )


@query("run_log", """
    SELECT batch_run_id, CAST(batch_date AS VARCHAR) AS batch_date, status,
           CASE WHEN status = 'COMPLETED' THEN orders ELSE 0 END AS transaction_count,
           CASE WHEN status = 'FAILED' THEN 'rejected' ELSE '' END AS error_message
    FROM attempt""")
def run_log(book):
    return admission.current_runs(book.run_events).select(
        "batch_run_id",
        "batch_date",
        "status",
        "transaction_count",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    )


@query("batch_admission", """
    SELECT CAST(d.batch_date AS VARCHAR) AS batch_date,
           CASE WHEN done THEN 'ingest_locked' ELSE 'ok' END AS ingest,
           CASE WHEN done THEN 'noop' WHEN day(d.batch_date) = 20 THEN 'not_ingested'
                WHEN d.batch_date < (SELECT max(batch_date) FROM attempt WHERE status = 'COMPLETED') THEN 'out_of_order'
                ELSE 'run' END AS process,
           CASE WHEN d.batch_date > DATE '2001-07-10' THEN 'blocked_by_earlier'
                WHEN done AND month(d.batch_date) <> 12 THEN 'noop' WHEN done THEN 'export_only'
                WHEN day(d.batch_date) = 5 THEN 'missing_input'
                WHEN d.batch_date < (SELECT max(batch_date) FROM attempt WHERE status = 'COMPLETED') THEN 'out_of_order'
                ELSE 'run' END AS job
    FROM (SELECT batch_date, EXISTS (SELECT 1 FROM attempt a WHERE a.batch_date = b.batch_date
                                     AND a.status = 'COMPLETED') AS done FROM business_day b) d""")
def batch_admission(book):
    day = F.dayofmonth("batch_date")
    dates = book.business_dates.select("batch_date")
    return admission.batch_admission(
        dates,
        admission.current_runs(book.run_events),
        receipts=dates.where(day != 20),
        exported=book.attempts.where((F.col("status") == "COMPLETED") & (F.month("batch_date") != 12)),
        missing_files=dates.where(day == 5),
    )


_RUNNING_DATE = "(SELECT min(batch_date) FROM attempt WHERE batch_date >= DATE '1999-01-01')"


@query("admission_while_running", f"""
    SELECT CAST(batch_date AS VARCHAR) AS batch_date,
           CASE WHEN done OR batch_date = {_RUNNING_DATE} THEN 'ingest_locked' ELSE 'ok' END AS ingest,
           CASE WHEN done THEN 'noop' ELSE 'blocked_running' END AS process, 'blocked_running' AS job
    FROM (SELECT batch_date, EXISTS (SELECT 1 FROM attempt a WHERE a.batch_date = b.batch_date AND a.status = 'COMPLETED'
                                     AND a.batch_date < DATE '1999-01-01') AS done FROM business_day b) d""")
def admission_while_running(book):
    """The first attempt of 1999 runs, later ones have not begun: it blocks its own date and all others."""
    dates, events = book.business_dates.select("batch_date"), book.run_events
    first = book.attempts.where(F.col("batch_date") >= fx.day("1999-01-01")).agg(F.min("batch_date")).scalar()
    open_run = (F.col("batch_date") == first) & (F.col("status") == "RUNNING") & F.col("batch_run_id").endswith("-1")
    runs = admission.current_runs(events.where((F.col("batch_date") < fx.day("1999-01-01")) | open_run))
    nothing = dates.limit(0)
    return admission.batch_admission(dates, runs, dates, nothing, nothing)


@query("admission_after_failed_launches", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, CASE WHEN done THEN 'ingest_locked' ELSE 'ok' END AS ingest,
           CASE WHEN done THEN 'noop' WHEN batch_date < latest THEN 'out_of_order' ELSE 'run' END AS process,
           CASE WHEN batch_date > unfinished THEN 'blocked_by_earlier' WHEN done THEN 'noop'
                WHEN batch_date < latest THEN 'out_of_order' ELSE 'run' END AS job
    FROM (SELECT batch_date, EXISTS (SELECT 1 FROM attempt a WHERE a.batch_date = b.batch_date AND a.status = 'COMPLETED'
                                     AND a.batch_date < DATE '2000-01-01') AS done,
                 (SELECT max(batch_date) FROM attempt WHERE status = 'COMPLETED' AND batch_date < DATE '2000-01-01') AS latest,
                 (SELECT min(batch_date) FROM business_day WHERE day(batch_date) = 20 AND year(batch_date) >= 2000
                  AND month(batch_date) % 2 = 1) AS unfinished
          FROM business_day b) d""")
def admission_after_failed_launches(book):
    """Launches on the 20th fail from 2000 on; in even months they are repeated and end well, in odd ones they block."""
    date, dates = F.col("batch_date"), book.business_dates.select("batch_date")
    runs = admission.current_runs(book.run_events.where(date < fx.day("2000-01-01")))
    fails = (F.dayofmonth(date) == 20) & (F.year(date) >= 2000)
    ends = F.when(fails & (F.month(date) % 2 == 0), F.array(*map(F.lit, ("STARTED", "FAILED", "STARTED", "COMPLETED"))))
    ends = ends.when(fails, F.array(*map(F.lit, ("STARTED", "FAILED")))).otherwise(F.array(*map(F.lit, ("STARTED", "COMPLETED"))))
    events = dates.select("batch_date", F.posexplode(ends).alias("at", "status"))
    jobs = events.select((F.unix_date(date) * 10 + F.col("at")).cast("bigint").alias("number"), "batch_date", "status")
    return admission.batch_admission(dates, runs, dates, dates, dates.limit(0), jobs)


def _listing(book: Book) -> DataFrame:
    """A directory listing with one trigger per business date, in the state its day suggests."""
    day = F.dayofmonth("batch_date")
    stem = F.concat(F.lit("batch_"), F.date_format("batch_date", "yyyyMMdd"))
    name = (
        F.when(day == 3, F.concat(stem, F.lit(".INPROGRESS.trg")))
        .when(day == 4, F.concat(stem, F.lit(".COMPLETE.trg")))
        .when(day == 5, F.concat(stem, F.lit(".ERROR.trg")))
        .when(day == 6, F.concat(stem, F.lit(".trg.tmp")))
        .when(day == 31, F.concat(F.lit("batch_"), F.date_format("batch_date", "yyyyMM"), F.lit("32.trg")))
        .otherwise(F.concat(stem, F.lit(".trg")))
    )
    return book.business_dates.select(
        F.lit("input").alias("directory"), name.alias("name"), F.lit(0).cast("bigint").alias("length"),
        (day != 7).alias("is_regular"),
    )


@query("ready_batches", """
    SELECT CASE WHEN day(batch_date) = 31 THEN 'batch_' || strftime(batch_date, '%Y%m') || '32.trg'
                ELSE 'batch_' || strftime(batch_date, '%Y%m%d') || '.trg' END AS name,
           CASE WHEN day(batch_date) = 31 THEN '' ELSE CAST(batch_date AS VARCHAR) END AS batch_date,
           CASE day(batch_date) WHEN 7 THEN 'not_regular' WHEN 31 THEN 'bad_date' ELSE 'ready' END AS status
    FROM business_day WHERE day(batch_date) NOT IN (3, 4, 5, 6)""")
def ready_batches(book):
    ready = admission.ready_batches(_listing(book))
    return ready.withColumn("batch_date", F.coalesce(F.col("batch_date").cast("string"), F.lit("")))


@query("missing_input_files", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, r || '_' || strftime(batch_date, '%Y%m%d') || '.dat' AS name
    FROM business_day, (VALUES ('customer'), ('account'), ('relationship'), ('transaction')) f(r)
    WHERE (r = 'customer' AND day(batch_date) = 11) OR (r = 'account' AND orders > 10)
       OR (r = 'transaction' AND orders = 1)""")
def missing_input_files(book):
    """Files of every business date but the customer file on the 11th, the account file of busy dates (listed as
    something other than a file) and the transaction file of dates with one order."""
    record = F.col("record")
    there = book.business_dates.withColumn("record", F.explode(F.array(*[F.lit(r) for r in LAYOUTS]))).where(
        ~((record == "customer") & (F.dayofmonth("batch_date") == 11))
        & ~((record == "transaction") & (F.col("orders") == 1))
    )
    listing = there.select(
        F.lit("input").alias("directory"),
        F.concat(record, F.lit("_"), fx.compact_date(F.col("batch_date")), F.lit(".dat")).alias("name"),
        F.col("orders").alias("length"),
        (~((record == "account") & (F.col("orders") > 10))).alias("is_regular"),
    )
    return admission.missing_input_files(book.business_dates, listing)


@query("exportable_snapshots", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, batch_run_id, orders AS record_count
    FROM attempt WHERE status = 'COMPLETED'""")
def exportable_snapshots(book):
    headers = book.attempts.select("batch_date", "batch_run_id", F.col("orders").alias("record_count"))
    return admission.exportable_snapshots(headers, admission.current_runs(book.run_events))


# Fixed width: formatted from the tables, written below the shared folder, scanned again

def _round_trip(book: Book, records: DataFrame, layout: Layout) -> DataFrame:
    path = scratch_path(book.spark, f"{layout.record}-files")
    fixed_width.format_lines(records, layout).write.text(path)
    return fixed_width.scan(book.spark, path, layout)


@query("scan_customer_fw", """
    SELECT customer_id, first_name, last_name, address_line1, city, province, postal_code, country FROM cust_all""")
def scan_customer_fw(book):
    return _round_trip(book, book.customers, CUSTOMER)


@query("scan_account_fw", """
    SELECT account_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, account_type
    FROM acct_all""")
def scan_account_fw(book):
    return _round_trip(book, book.accounts, ACCOUNT)


@query("scan_relationship_fw", "SELECT account_id, customer_id, type FROM stg_relationship")
def scan_relationship_fw(book):
    return _round_trip(book, book.stg_relationship.drop("batch_date", "source_file"), RELATIONSHIP)


@query("scan_transaction_fw", "SELECT transaction_id, account_id, type, amount FROM txn_all")
def scan_transaction_fw(book):
    return _round_trip(book, book.transactions.drop("batch_date"), TRANSACTION)


@query("staged_with_lineage", """
    SELECT CAST(date_trunc('month', batch_date) AS DATE)::VARCHAR AS batch_date,
           'transaction_' || strftime(batch_date, '%Y%m') || '01.dat' AS source_file,
           row_number() OVER (PARTITION BY date_trunc('month', batch_date) ORDER BY transaction_id) AS source_line,
           transaction_id, account_id, type, amount
    FROM txn_all""")
def staged_with_lineage(book):
    """One dated file per month, in transaction order; a big file is cut into parts like any range."""
    first = F.trunc("batch_date", "month")
    rows = book.transactions.withColumn(
        "source_file", F.concat(F.lit("transaction_"), fx.compact_date(first), F.lit(".dat"))
    )
    ordered = rows.repartitionByRange("source_file", "transaction_id").sortWithinPartitions(
        "source_file", "transaction_id"
    )
    root = scratch_path(book.spark, "dated-files")
    fixed_width.write_dated_files(fixed_width.format_lines(ordered.drop("batch_date"), TRANSACTION), root)
    return fixed_width.accepted(fixed_width.scan_with_lineage(book.spark, root, TRANSACTION), TRANSACTION)


@query("fw_line_quality", """
    SELECT 'account_199801' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || '.dat' AS source_file,
           count(*) AS lines,
           CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT)
             AS malformed_lines,
           CAST(sum(CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END) AS BIGINT) AS crlf_lines,
           c_nationkey < 5 AS has_bom, false AS lacks_last_lf
    FROM acct_all GROUP BY c_nationkey""")
def fw_line_quality(book):
    """A file per nation: carriage returns and malformed bytes by segment, a BOM where the nation is below five."""
    nation = F.col("c_nationkey")
    rows = book.accounts.join(book.table("customer").select("c_custkey", "c_acctbal"), "c_custkey").withColumn(
        "source_file", F.concat(F.lit("account_199801"), F.lpad((nation + 1).cast("string"), 2, "0"), F.lit(".dat"))
    )
    line = F.concat(*[fx.formatted_field(F.col(f.name), f) for f in ACCOUNT.fields])
    segment = F.col("c_mktsegment")
    broken = F.concat(F.unhex(F.lit("C328")), line.cast("binary")).cast("string")
    body = (
        F.when((segment == "BUILDING") & (F.col("c_acctbal") < 0), broken)
        .when(segment == "FURNITURE", F.concat(line, F.lit("\r")))
        .otherwise(line)
    )
    opening = rows.groupBy("source_file").agg(F.min("account_id").alias("first_account"))
    text = rows.join(opening, "source_file").select(
        "source_file",
        "account_id",
        F.when(
            (nation < 5) & (F.col("account_id") == F.col("first_account")), F.concat(F.lit("\ufeff"), body)
        ).otherwise(body).alias("value"),
    )
    root = scratch_path(book.spark, "quality-files")
    ordered = text.repartitionByRange("source_file", "account_id").sortWithinPartitions("source_file", "account_id")
    fixed_width.write_dated_files(ordered, root)
    return fixed_width.line_quality(book.spark, root)


def _by_nation(forms: dict[int, str], otherwise: str):
    """One written form per nation."""
    chain = F
    for nation, text in forms.items():
        chain = chain.when(F.col("c_nationkey") == nation, F.expr(text))
    return chain.otherwise(F.expr(otherwise))


@query("fw_ids", """
    SELECT c_custkey, CASE WHEN c_nationkey IN (1, 2, 3, 4, 5, 6, 7, 8) THEN 'bad'
                           WHEN c_nationkey = 10 THEN '9223372036854775807'
                           ELSE CAST(c_custkey + 1 AS VARCHAR) END AS id
    FROM customer""")
def fw_ids(book):
    raw = _by_nation(
        {
            1: "concat('+', c_custkey + 1)",
            2: "concat('-', c_custkey + 1)",
            3: "'9223372036854775808'",
            4: "lpad('0', 19, '0')",
            5: "concat(c_custkey + 1, 'a')",
            6: "repeat(' ', 19)",
            7: "concat(c_custkey + 1, '.0')",
            8: "concat('1 ', c_custkey)",
            9: "lpad(c_custkey + 1, 19, '0')",
            10: "'9223372036854775807'",
            11: "rpad(c_custkey + 1, 19, ' ')",
        },
        "lpad(c_custkey + 1, 19, ' ')",
    )
    return book.table("customer").select(
        "c_custkey", F.coalesce(fx.id_value(raw).cast("string"), F.lit("bad")).alias("id")
    )


@query("fw_amounts", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '0'
             WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '9223372036854775807'
             WHEN o_orderstatus = 'F' THEN 'bad'
             ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS amount
    FROM orders""")
def fw_amounts(book):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    priority = F.col("o_orderpriority")
    fault = (
        F.when(priority == "1-URGENT", "0")
        .when(priority == "2-HIGH", "09223372036854775807")
        .when(priority == "3-MEDIUM", "99999999999999999999")
        .when(priority == "5-LOW", F.concat(F.lit("-"), cents))
        .otherwise(F.concat(cents, F.lit(".5")))
    )
    raw = F.lpad(F.when(F.col("o_orderstatus") == "F", fault).otherwise(cents), 20, " ")
    return book.table("orders").select(
        "o_orderkey", F.coalesce(fx.digits_value(raw).cast("string"), F.lit("bad")).alias("amount")
    )


@query("fw_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' THEN 'bad'
             WHEN o_orderstatus = 'P' THEN '2024-02-29'
             ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
    FROM orders""")
def fw_dates(book):
    day = F.col("o_orderdate").cast("date")
    priority = F.col("o_orderpriority")
    fault = (
        F.when(priority == "1-URGENT", "2024-02-29")
        .when(priority == "2-HIGH", "2023-02-29")
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy-M-d'   '"))
        .when(priority == "5-LOW", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.concat(F.lit(" "), F.date_format(day, "yyyyMMdd"), F.lit(" ")))
    )
    raw = F.when(F.col("o_orderstatus") == "P", fault).otherwise(day.cast("string"))
    return book.table("orders").select(
        "o_orderkey", F.coalesce(fx.date_value(raw).cast("string"), F.lit("bad")).alias("day")
    )


@query("fw_enums", """
    SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'SAVINGS' WHEN 'BUILDING' THEN 'CHECKING'
                                        ELSE 'bad' END AS account_type
    FROM customer""")
def fw_enums(book):
    segment = F.col("c_mktsegment")
    raw = (
        F.when(segment == "MACHINERY", "SAVINGS ")
        .when(segment == "BUILDING", "CHECKING")
        .when(segment == "FURNITURE", "savings ")
        .when(segment == "HOUSEHOLD", "A1      ")
        .otherwise("        ")
    )
    return book.table("customer").select(
        "c_custkey", F.coalesce(fx.enum_value(raw, ACCOUNT_TYPES), F.lit("bad")).alias("account_type")
    )


@query("fw_nfc_width", r"""
    SELECT doc_id, CAST(length(nfc_normalize(text || lang || 'e' || chr(769))) AS BIGINT) AS code_points,
           regexp_matches(text, '[\x{0000}-\x{001F}\x{007F}-\x{009F}\x{FEFF}\x{2028}\x{2029}]') AS forbidden,
           length(nfc_normalize(text || lang || 'e' || chr(769))) <= 20 AS fits_line
    FROM documents""")
def fw_nfc_width(book):
    """Whole texts, each followed by a letter in decomposed form."""
    text = F.concat("text", "lang", F.lit("e\u0301"))
    return book.table("documents").select("doc_id", fx.normalized(text).alias("line")).select(
        "doc_id",
        F.length("line").cast("bigint").alias("code_points"),
        fx.has_forbidden(F.col("line")).alias("forbidden"),
        (F.length("line") <= 20).alias("fits_line"),
    )


_FAULTY_LINES = """
    SELECT CASE kind
             WHEN 'record_length' THEN substr(line, 2)
             WHEN 'forbidden_character' THEN substr(line, 1, 40) || chr(9) || substr(line, 42)
             WHEN 'bad_transaction_id' THEN lpad('0', 19, ' ') || substr(line, 20)
             WHEN 'bad_account_id' THEN substr(line, 1, 19) || lpad('-1', 19, ' ') || substr(line, 39)
             WHEN 'bad_type' THEN substr(line, 1, 38) || 'CREDIT' || substr(line, 45)
             WHEN 'bad_amount' THEN substr(line, 1, 44) || lpad('+1', 20, ' ')
             ELSE line END AS line, kind
    FROM (SELECT lpad(CAST(transaction_id AS VARCHAR), 19, ' ') || lpad(CAST(account_id AS VARCHAR), 19, ' ')
                   || rpad(type, 6, ' ') || lpad(CAST(amount AS VARCHAR), 20, ' ') AS line,
                 CASE WHEN status <> 'P' THEN '' WHEN priority = '1-URGENT' THEN 'record_length'
                      WHEN priority = '2-HIGH' THEN 'forbidden_character'
                      WHEN priority = '3-MEDIUM' AND amount % 2 = 0 THEN 'bad_transaction_id'
                      WHEN priority = '3-MEDIUM' THEN 'bad_account_id'
                      WHEN priority = '5-LOW' THEN 'bad_type' ELSE 'bad_amount' END AS kind FROM txn_all)"""


@query("fw_rejects", f"SELECT line, kind AS reject_reason FROM ({_FAULTY_LINES}) WHERE kind <> ''")
def fw_rejects(book):
    """Transaction lines of partly shipped orders, each broken in one way by its priority."""
    status, priority = F.col("status"), F.col("priority")
    rows = book.transactions.drop("batch_date").withColumn(
        "line", F.concat(*[fx.formatted_field(F.col(f.name), f) for f in TRANSACTION.fields])
    )
    broken = (
        F.when(status != "P", F.col("line"))
        .when(priority == "1-URGENT", F.expr("substring(line, 2)"))
        .when(priority == "2-HIGH", F.expr("concat(substring(line, 1, 40), '\t', substring(line, 42))"))
        .when(
            (priority == "3-MEDIUM") & (F.col("amount") % 2 == 0),
            F.expr("concat(lpad('0', 19, ' '), substring(line, 20))"),
        )
        .when(
            priority == "3-MEDIUM",
            F.expr("concat(substring(line, 1, 19), lpad('-1', 19, ' '), substring(line, 39))"),
        )
        .when(priority == "5-LOW", F.expr("concat(substring(line, 1, 38), 'CREDIT', substring(line, 45))"))
        .otherwise(F.expr("concat(substring(line, 1, 44), lpad('+1', 20, ' '))"))
    )
    path = scratch_path(book.spark, "faulty-files")
    rows.select(broken.alias("value")).write.text(path)
    parsed = fixed_width.parse_lines(fixed_width.read_lines(book.spark, path, positions=False), TRANSACTION)
    return fixed_width.rejects(parsed, TRANSACTION).select(F.col("value").alias("line"), "reject_reason")


# Many dates

@query("closing_balances", """
    SELECT account_id, CAST(batch_date AS VARCHAR) AS batch_date,
           CAST(sum(delta) OVER (PARTITION BY account_id ORDER BY batch_date) AS BIGINT) AS balance
    FROM md_delta""")
def closing_balances(book):
    return backfill.closing_balances(backfill.winners(book.transaction_feed))


@query("first_postings", """
    SELECT w.transaction_id, CAST(w.batch_date AS VARCHAR) AS batch_date, w.source_line, w.account_id, w.type, w.amount,
           CAST(sum(CASE WHEN (f.account_id, f.type, f.amount) IS NOT DISTINCT FROM (w.account_id, w.type, w.amount)
                         THEN 1 ELSE 0 END) - 1 AS BIGINT) AS replays,
           CAST(sum(CASE WHEN (f.account_id, f.type, f.amount) IS DISTINCT FROM (w.account_id, w.type, w.amount)
                         THEN 1 ELSE 0 END) AS BIGINT) AS conflicts
    FROM winner w JOIN txn_feed f ON w.transaction_id = f.transaction_id
    GROUP BY w.transaction_id, w.batch_date, w.source_line, w.account_id, w.type, w.amount""")
def first_postings(book):
    return backfill.first_postings(book.transaction_feed)


@query("effective_accounts", """
    SELECT account_id, CAST(batch_date AS VARCHAR) AS valid_from,
           CAST(lead(batch_date) OVER (PARTITION BY account_id ORDER BY batch_date) AS VARCHAR) AS valid_to,
           CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, account_type
    FROM account_feed""")
def effective_accounts(book):
    return backfill.effective_accounts(book.account_feed)


@query("first_seen", """
    SELECT 'account' AS record, account_id AS id, CAST(min(batch_date) AS VARCHAR) AS first_date
    FROM account_feed GROUP BY account_id
    UNION ALL
    SELECT 'customer', c_custkey + 1, CAST(DATE '1994-03-01' + CAST((c_custkey * 37) % 300 AS INT) AS VARCHAR)
    FROM customer""")
def first_seen(book):
    accounts = backfill.first_seen(book.account_feed, "account_id")
    customers = backfill.first_seen(book.customer_feed, "customer_id")
    return accounts.select(F.lit("account").alias("record"), F.col("account_id").alias("id"), "first_date").unionByName(
        customers.select(F.lit("customer").alias("record"), F.col("customer_id").alias("id"), "first_date")
    )


@query("snapshots_all_dates", """
    SELECT CAST(m.batch_date AS VARCHAR) AS batch_date, m.account_id,
           CAST(sum(coalesce(d.delta, 0)) OVER (PARTITION BY m.account_id ORDER BY m.batch_date) AS BIGINT) AS balance
    FROM (SELECT account_id, batch_date FROM md_delta
          UNION SELECT account_id, min(batch_date) FROM account_feed GROUP BY account_id) m
    LEFT JOIN md_delta d ON d.account_id = m.account_id AND d.batch_date = m.batch_date""")
def snapshots_all_dates(book):
    return backfill.snapshots_all_dates(backfill.winners(book.transaction_feed), book.account_feed)


@query("postable_prefix", """
    SELECT DISTINCT CAST(batch_date AS VARCHAR) AS batch_date FROM txn_feed
    WHERE batch_date < (SELECT min(f.batch_date) FROM (
        SELECT f.batch_date FROM txn_feed f JOIN winner w ON f.transaction_id = w.transaction_id
        WHERE (f.account_id, f.type, f.amount) IS DISTINCT FROM (w.account_id, w.type, w.amount)
        UNION ALL
        SELECT batch_date FROM txn_feed GROUP BY batch_date, transaction_id HAVING count(*) > 1
        UNION ALL
        SELECT w.batch_date FROM winner w JOIN customer c ON w.account_id = c_custkey + 1
        WHERE (c_acctbal < -500 AND w.batch_date >= DATE '2000-01-01' + CAST((c_custkey * 7) % 200 AS INT))
           OR w.batch_date < DATE '1994-03-01' + CAST((c_custkey * 37) % 300 AS INT)) f)""")
def postable_prefix(book):
    return backfill.postable_prefix(book.transaction_feed, _feeds(book))


@query("failing_dates", """
    SELECT 'conflicting_replay' AS rule, CAST(min(f.batch_date) AS VARCHAR) AS batch_date
    FROM txn_feed f JOIN winner w ON f.transaction_id = w.transaction_id
    WHERE (f.account_id, f.type, f.amount) IS DISTINCT FROM (w.account_id, w.type, w.amount)
    UNION ALL
    SELECT 'ineligible_transaction', CAST(min(w.batch_date) AS VARCHAR)
    FROM winner w JOIN customer c ON w.account_id = c_custkey + 1
    WHERE c_acctbal < -500 AND w.batch_date >= DATE '2000-01-01' + CAST((c_custkey * 7) % 200 AS INT)""")
def failing_dates(book):
    return backfill.failing_dates(_feeds(book))


@query("ledger_reconciliation", """
    SELECT account_id, CAST(sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS BIGINT) AS ledger_total,
           CAST(sum(CASE WHEN status = 'P' AND priority = '1-URGENT' THEN 0
                         WHEN type = 'CR' THEN amount ELSE -amount END) AS BIGINT) AS balance
    FROM txn_all GROUP BY account_id
    HAVING sum(CASE WHEN status = 'P' AND priority = '1-URGENT' THEN amount ELSE 0 END) <> 0""")
def ledger_reconciliation(book):
    """Stored balances that missed the urgent partly shipped orders."""
    lost = (F.col("status") == "P") & (F.col("priority") == "1-URGENT")
    kept = book.transactions.withColumn("amount", F.when(lost, 0).otherwise(F.col("amount")).cast("bigint"))
    stored = posting.account_deltas(kept).select("account_id", fx.checked_cents(F.col("delta")).alias("balance"))
    return backfill.ledger_reconciliation(book.transactions, stored).select(
        "account_id", F.col("ledger_total").cast("bigint").alias("ledger_total"), "balance"
    )


# Generation

@query("eligible_accounts", """
    SELECT account_id FROM acct_all WHERE end_date IS NULL AND start_date <= DATE '1998-01-01'""")
def eligible_accounts(book):
    return references.eligible_accounts(book.accounts, BATCH_DATE)


@query("used_ids", """
    SELECT 'customer' AS record, id FROM (SELECT customer_id AS id FROM core_customer
                                          UNION SELECT customer_id FROM stg_customer)
    UNION ALL SELECT 'account', id FROM (SELECT account_id AS id FROM core_account
                                         UNION SELECT account_id FROM stg_account)
    UNION ALL SELECT 'transaction', id FROM (SELECT transaction_id AS id FROM core_transaction
                                             UNION SELECT transaction_id FROM stg_transaction)""")
def used_ids(book):
    drawn_from = generate.pools(_state(book), _staged(book), BATCH_DATE)
    parts = {
        "customer": drawn_from.used_customers,
        "account": drawn_from.used_accounts,
        "transaction": drawn_from.used_transactions,
    }
    frames = [df.select(F.lit(r).alias("record"), F.col(f"{r}_id").alias("id")) for r, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("generator_pools", """
    SELECT account_id, row_number() OVER (ORDER BY account_id) - 1 AS position
    FROM acct_all WHERE end_date IS NULL AND start_date <= DATE '1998-01-01'""")
def generator_pools(book):
    return with_position(references.eligible_accounts(book.accounts, BATCH_DATE), ["account_id"])


def _generated(book: Book) -> tuple[generate.Request, dict[str, DataFrame]]:
    """A batch as large as the tables: as many customers and accounts as customers, transactions as orders."""
    people, orders = book.table("customer").count(), book.table("orders").count()
    request = generate.Request(BATCH_DATE, people, people, people, orders, seed=42)
    return request, generate.generate(book.spark, generate.pools(_state(book), _staged(book), BATCH_DATE), request)


@query("gen_batch", """
    SELECT 'customer' AS record, count(*) AS lines, count(*) AS keys FROM customer
    UNION ALL SELECT 'account', count(*), count(*) FROM customer
    UNION ALL SELECT 'relationship', count(*), count(*) FROM customer
    UNION ALL SELECT 'transaction', count(*), count(*) FROM orders""")
def gen_batch(book):
    """The published files of a generated batch, scanned again: lines and distinct business keys."""
    request, batch = _generated(book)
    paths = generate.write_batch(book.spark, batch, scratch_path(book.spark, "generated"), request, as_parts=True)
    parts = [
        fixed_width.scan(book.spark, path, layout).agg(
            F.lit(record).alias("record"),
            F.count(F.lit(1)).alias("lines"),
            F.count_distinct(*layout.keys).alias("keys"),
        )
        for (record, layout), path in zip(LAYOUTS.items(), paths)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("gen_batch_values", """
    SELECT 'first_name' AS field, substr(r_name, 1, 10) AS value, NULL::BIGINT AS customers FROM region
    UNION ALL SELECT DISTINCT 'last_name', substr(c_mktsegment, 1, 10), NULL::BIGINT FROM customer
    UNION ALL SELECT 'address_line1', 'Pier', count(*) FROM customer""")
def gen_batch_values(book):
    """Customers generated from lists of the given tables: each value of the lists that was drawn, streets from a list of one."""
    lists = [
        book.table("region").select(F.substring("r_name", 1, 10).alias("value")),
        book.table("customer").select(F.substring("c_mktsegment", 1, 10).alias("value")).distinct(),
        book.spark.range(1).select(F.lit("Pier").alias("value")),
    ]
    request = generate.Request(BATCH_DATE, book.table("customer").count(), 0, 0, 0, seed=42)
    batch = generate.generate(book.spark, generate.pools(_state(book), _staged(book), BATCH_DATE), request, *lists)
    made = durable(batch["customer"], "generated")
    none = F.lit(None).cast("bigint").alias("customers")
    names = [made.select(F.lit(c).alias("field"), F.col(c).alias("value"), none).distinct() for c in ("first_name", "last_name")]
    street = F.regexp_extract("address_line1", r"\A[1-9][0-9]{0,3} (.*)\z", 1).alias("value")
    counted = made.groupBy(street).agg(F.count(F.lit(1)).alias("customers"))
    return reduce(DataFrame.unionByName, [*names, counted.select(F.lit("address_line1").alias("field"), "value", "customers")])


@query("gen_self_contained", """
    SELECT constraint_name, CAST(0 AS BIGINT) AS orphans
    FROM (VALUES ('relationship_account'), ('relationship_customer'), ('transaction_account'),
                 ('relationship_unused'), ('transaction_unused')) v(constraint_name)""")
def gen_self_contained(book):
    """Generated references that do not resolve, and generated keys that were already in use: none."""
    state = _state(book)
    _, batch = _generated(book)
    accounts = state.account.select("account_id").unionByName(batch["account"].select("account_id"))
    customers = state.customer.select("customer_id").unionByName(batch["customer"].select("customer_id"))
    open_accounts = references.eligible_accounts(state.account, BATCH_DATE).unionByName(
        batch["account"].select("account_id")
    )
    pair = ["account_id", "customer_id"]
    faults = {
        "relationship_account": batch["relationship"].join(accounts, "account_id", "left_anti"),
        "relationship_customer": batch["relationship"].join(customers, "customer_id", "left_anti"),
        "transaction_account": batch["transaction"].join(open_accounts, "account_id", "left_anti"),
        "relationship_unused": batch["relationship"].join(state.relationship.select(*pair), pair, "left_semi"),
        "transaction_unused": batch["transaction"].join(state.ledger.select("transaction_id"), "transaction_id", "left_semi"),
    }
    parts = [
        rows.agg(F.lit(name).alias("constraint_name"), F.count(F.lit(1)).alias("orphans")) for name, rows in faults.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("unused_pairs")
def unused_pairs(book):
    """As many unused pairs as there are customers, chosen by the seed."""
    n = book.table("customer").count()
    return generate.unused_pairs(book.core_account, book.core_customer, book.core_relationship, n, 42, BATCH_DATE)


@query("unused_pairs_facts", """
    SELECT count(*) AS pairs, count(*) AS distinct_pairs, count(*) AS of_members, CAST(0 AS BIGINT) AS in_use,
           (SELECT count(*) FROM core_account) * (SELECT count(*) FROM core_customer)
             - (SELECT count(*) FROM core_relationship r SEMI JOIN core_account USING (account_id) SEMI JOIN core_customer USING (customer_id))
             - count(*) AS left_over
    FROM customer""")
def unused_pairs_facts(book):
    """Of the unused pairs: their number, how many differ, belong to members or are in use, and what is left to draw."""
    n = book.table("customer").count()
    pair = ["account_id", "customer_id"]
    rest = book.core_account.count() * book.core_customer.count() - n
    drawn = durable(generate.unused_pairs(book.core_account, book.core_customer, book.core_relationship, n, 42, BATCH_DATE), "pairs")
    members = drawn.join(book.core_account, "account_id", "left_semi").join(book.core_customer, "customer_id", "left_semi")
    facts = [
        drawn.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct(*pair).alias("distinct_pairs")),
        members.agg(F.count(F.lit(1)).alias("of_members")),
        drawn.join(book.core_relationship, pair, "left_semi").agg(F.count(F.lit(1)).alias("in_use")),
        book.core_relationship.select(pair).distinct().join(book.core_account, "account_id", "left_semi")
        .join(book.core_customer, "customer_id", "left_semi").agg((F.lit(rest) - F.count(F.lit(1))).alias("left_over")),
    ]
    return facts[0].select("*", *[f.scalar().alias(f.columns[0]) for f in facts[1:]])


@query("value_list_scan", """
    SELECT c_name AS value FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'BUILDING')""")
def value_list_scan(book):
    """A value list of customer names, with comments and blank lines for two segments."""
    segment = F.col("c_mktsegment")
    lines = book.table("customer").select(
        F.when(segment == "FURNITURE", F.concat(F.lit("#"), "c_name"))
        .when(segment == "BUILDING", F.lit("  "))
        .otherwise(F.col("c_name"))
        .alias("value")
    )
    path = scratch_path(book.spark, "values")
    lines.write.text(path)
    return read_values(book.spark, path, 20)


# Streaming

def _controls(book: Book) -> DataFrame:
    return book.arrivals.where(F.col("control_date").isNotNull()).select("control_date", "ts", "event_id")


def _stamped(book: Book) -> DataFrame:
    data = book.arrivals.where(F.col("control_date").isNull()).drop("control_date")
    return clock.assign_business_dates(data, _controls(book))


@query("business_date_clock", """
    SELECT event_id, account_id, coalesce(CAST(batch_date AS VARCHAR), 'waiting') AS batch_date FROM stamped""")
def business_date_clock(book):
    return _stamped(book).select(
        "event_id", "account_id", F.coalesce(F.col("batch_date").cast("string"), F.lit("waiting")).alias("batch_date")
    )


@query("stream_dedup", """
    SELECT topic, CAST(part AS BIGINT) AS part, off, coalesce(CAST(batch_date AS VARCHAR), 'waiting') AS batch_date
    FROM stamped""")
def stream_dedup(book):
    """Purchases are delivered again a day later and keep the date they were first given."""
    data = book.arrivals.where(F.col("control_date").isNull()).drop("control_date")
    again = data.where(F.col("topic") == "purchase").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    stamped = clock.assign_business_dates(data.unionByName(again), _controls(book))
    return clock.first_assignments(stamped).select(
        "topic", "part", "off", F.coalesce(F.col("batch_date").cast("string"), F.lit("waiting")).alias("batch_date")
    )


@query("closed_dates", """
    SELECT event_id, CAST(batch_date AS VARCHAR) AS batch_date FROM stamped
    WHERE batch_date < (SELECT max(control_date) + 1 FROM arrivals)""")
def closed_dates(book):
    return clock.closed_dates(_stamped(book), _controls(book)).select("event_id", "batch_date")


@query("stream_balances", """
    SELECT account_id, CAST(sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS BIGINT) AS balance
    FROM txn_all GROUP BY account_id""")
def stream_balances(book):
    """All transactions as a stream of files, low-priority finished orders delivered twice."""
    again = (F.col("status") == "F") & (F.col("priority") == "5-LOW")
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    feed = book.transactions.withColumn("copy", F.explode(copies)).select(*TRANSACTION.columns)
    folder = scratch_path(book.spark, "balance-stream")
    feed.write.parquet(f"{folder}/input")
    stream = book.spark.readStream.schema(TRANSACTION.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/input")
    balances = balance_stream.BalanceStream(book.spark, f"{folder}/state")
    balance_stream.run_to_end(stream, balances.on_batch, f"{folder}/checkpoint")
    return balances.balances()


def _in_cuts(book: Book, rows: DataFrame, cut: Column, cuts: int, follow) -> None:
    """Rows as a stream that stops and starts again after each of ``cuts`` deliveries, in the order of ``cut``.

    ``follow`` takes the stream and returns what to do with its batches, or the stream changed and that.
    """
    folder = scratch_path(book.spark, "cuts")
    numbered = durable(rows.withColumn("_cut", cut), "arrivals")
    for number in range(cuts):
        numbered.where(F.col("_cut") == number).drop("_cut").write.mode("append").parquet(f"{folder}/input")
        stream = book.spark.readStream.schema(rows.schema).parquet(f"{folder}/input")
        stream, on_batch = follow(stream)
        balance_stream.run_to_end(stream, on_batch, f"{folder}/checkpoint")


def _quarters(book: Book) -> Column:
    """Which quarter of the time covered a record arrived in."""
    ends = book.arrivals.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    share = (F.unix_micros("ts") - F.unix_micros(F.lit(ends["low"]))) / (F.unix_micros(F.lit(ends["high"])) - F.unix_micros(F.lit(ends["low"])) + 1)
    return F.least(F.floor(share * 4), F.lit(3))


_LIVE = """SELECT event_id, account_id, topic, part, off, amount, coalesce(batch_date,
             (SELECT arg_min(control_date, (ts, event_id)) + 1 FROM arrivals WHERE control_date IS NOT NULL)) AS batch_date
           FROM stamped"""


@query("stream_clock", f"""
    SELECT event_id, account_id, CAST(batch_date AS VARCHAR) AS batch_date FROM ({_LIVE})""")
def stream_clock(book):
    """Arrivals as a stream stopped and started three times; records before the first control take its date."""
    path = scratch_path(book.spark, "stamped")
    keyed_clock.use_keyed_state(book.spark)

    def keep(batch, number):
        batch.where("NOT control").write.mode("overwrite").parquet(f"{path}/batch={number}")

    _in_cuts(book, book.arrivals, _quarters(book), 4, lambda stream: (keyed_clock.stamp_stream(stream), keep))
    return book.spark.read.parquet(path).select("event_id", "account_id", "batch_date")


@query("stream_first_deliveries", f"""
    SELECT topic, CAST(part AS BIGINT) AS part, off, CAST(batch_date AS VARCHAR) AS batch_date FROM ({_LIVE})""")
def stream_first_deliveries(book):
    """Purchases are delivered again a day later, over several batches, and keep the date they were first given."""
    again = book.arrivals.where(F.col("topic") == "purchase").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    sink = offsets.FirstDeliveries(book.spark, scratch_path(book.spark, "deliveries"))
    keyed_clock.use_keyed_state(book.spark)
    seen = []

    def first(batch, number):
        seen.append(batch.schema)
        sink.on_batch(batch.where("NOT control"), number)

    _in_cuts(book, book.arrivals.unionByName(again), _quarters(book), 4, lambda stream: (keyed_clock.stamp_stream(stream), first))
    return sink.rows(seen[0]).select("topic", "part", "off", "batch_date")


@query("stream_staging", """
    SELECT CAST(batch_date AS VARCHAR) AS batch_date, account_id, event_id, amount
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_date, account_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM stamped WHERE batch_date IS NOT NULL) WHERE rn = 1""")
def stream_staging(book):
    """Stamped records in three deliveries, dealt so that later ones hold both newer and older records."""
    columns = ["batch_date", "account_id", "ts", "event_id", "amount"]
    rows = durable(_stamped(book).where(F.col("batch_date").isNotNull()).select(columns), "stamped")
    sink = staged.StagingStream(book.spark, scratch_path(book.spark, "staging"), rows.schema, ["account_id"], ["ts", "event_id"])
    _in_cuts(book, rows, F.pmod(F.hash("event_id"), F.lit(3)), 3, lambda stream: (stream, sink.on_batch))
    return sink.rows().drop("ts")


def _closing_lines() -> dict:
    """What records give when their date closes: owners from clicks, accounts from views, transactions from purchases."""

    def of(layout: Layout, topic: str, **columns: Column):
        def lines(rows: DataFrame) -> DataFrame:
            made = rows.where(F.col("topic") == topic).select("batch_date", *[c.alias(n) for n, c in columns.items()]).distinct()
            line = fixed_width.format_lines(made.withColumn("source_file", F.lit(layout.record)), layout, ascii_only=True)
            return line.select("batch_date", F.substring("value", 1, 19).alias("place"), "value")

        return lines

    owner, nothing = F.col("account_id"), F.lit(None).cast("date")
    return {
        "customer": of(CUSTOMER, "click", customer_id=owner, **{f.name: F.lit("x") for f in CUSTOMER.fields[1:]}),
        "account": of(ACCOUNT, "view", account_id=owner, start_date=F.col("batch_date"), end_date=nothing, account_type=F.lit(ACCOUNT_TYPES[0])),
        "relationship": of(RELATIONSHIP, "view", account_id=owner, customer_id=owner, type=F.lit(RELATIONSHIP_TYPES[0])),
        "transaction": of(TRANSACTION, "purchase", transaction_id=F.col("event_id") + 1, account_id=owner, type=F.lit(TRANSACTION_TYPES[0]), amount=F.abs("amount")),
    }


_CLOSED = f"(SELECT CAST(batch_date AS VARCHAR) AS batch_date, event_id, account_id, topic FROM ({_LIVE}) WHERE batch_date < (SELECT max(control_date) + 1 FROM arrivals))"


@query("closed_date_files", f"""
    SELECT 'customer' AS record, batch_date, account_id AS id FROM {_CLOSED} WHERE topic = 'click' GROUP BY ALL
    UNION ALL SELECT 'account', batch_date, account_id FROM {_CLOSED} WHERE topic = 'view' GROUP BY ALL
    UNION ALL SELECT 'relationship', batch_date, account_id FROM {_CLOSED} WHERE topic = 'view' GROUP BY ALL
    UNION ALL SELECT 'transaction', batch_date, event_id + 1 FROM {_CLOSED} WHERE topic = 'purchase'""")
def closed_date_files(book):
    """The four files of each closed date, published by a stream that is stopped and started, and scanned again."""
    folder = scratch_path(book.spark, "closing")
    sink = staged.ClosedDates(book.spark, f"{folder}/state", f"{folder}/files", _closing_lines())
    keyed_clock.use_keyed_state(book.spark)
    _in_cuts(book, book.arrivals, _quarters(book), 4, lambda stream: (keyed_clock.stamp_stream(stream), sink.on_batch))
    found = []
    for record, layout in LAYOUTS.items():
        rows = fixed_width.accepted(fixed_width.scan_with_lineage(book.spark, f"{folder}/files/{record}_*.dat", layout), layout)
        found.append(rows.select(F.lit(record).alias("record"), "batch_date", F.col(layout.keys[0]).alias("id")))
    return reduce(DataFrame.unionByName, found)
