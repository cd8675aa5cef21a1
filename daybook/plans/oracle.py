"""The registered queries as plain SQL over the given tables, written apart from the Spark plans.

``VIEWS`` restates the book (see ``book.py``) in SQL; ``statement`` puts the views a query names in front of it.
"""

from __future__ import annotations

import re

VIEWS = {
    "acct_all": """
        SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal, c_custkey + 1 AS account_id, opened AS start_date,
               CASE WHEN c_acctbal < -500 THEN opened + 2000 END AS end_date,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type,
               opened < DATE '1997-07-01' AS on_file,
               (opened >= DATE '1997-07-01' AND opened < DATE '1999-01-01')
                 OR (opened < DATE '1997-07-01' AND c_mktsegment = 'MACHINERY') AS sent
        FROM (SELECT *, DATE '1994-01-01' + CAST((c_custkey * 37) % 2000 AS INT) AS opened FROM customer)""",
    "core_account": "SELECT account_id, start_date, end_date, account_type FROM acct_all WHERE on_file",
    "stg_account": """
        SELECT DATE '1998-01-01' AS batch_date, 'account_19980101.dat' AS source_file,
               account_id + k * 1000000000000 AS source_line, account_id, start_date,
               CASE WHEN NOT on_file AND c_nationkey = 7 THEN start_date - 1
                    WHEN on_file AND c_nationkey < 5 THEN NULL ELSE end_date END AS end_date,
               CASE WHEN on_file THEN 'CHECKING' ELSE account_type END AS account_type
        FROM acct_all, (VALUES (0), (1)) d(k)
        WHERE sent AND (k = 0 OR (NOT on_file AND c_nationkey = 3))""",
    "cust_all": """
        SELECT a.c_nationkey, on_file, sent, a.c_custkey + 1 AS customer_id, substr(c_name, 1, 8) AS first_name,
               substr(c_name, 10, 9) AS last_name, c_name AS address_line1, a.c_mktsegment AS city,
               lpad(CAST(a.c_nationkey AS VARCHAR), 2, '0') AS province,
               'Z' || lpad(CAST(a.c_custkey % 1000000 AS VARCHAR), 6, '0') AS postal_code, n_name AS country
        FROM acct_all a JOIN customer c ON a.c_custkey = c.c_custkey JOIN nation ON a.c_nationkey = n_nationkey""",
    "core_customer": """
        SELECT customer_id, first_name, last_name, address_line1, city, province, postal_code, country
        FROM cust_all WHERE on_file""",
    "stg_customer": """
        SELECT DATE '1998-01-01' AS batch_date, 'customer_19980101.dat' AS source_file,
               customer_id + k * 1000000000000 AS source_line, customer_id,
               CASE WHEN on_file THEN 'Jo' ELSE first_name END AS first_name,
               last_name, address_line1, city, province, postal_code, country
        FROM cust_all, (VALUES (0), (1)) d(k) WHERE sent AND (k = 0 OR (NOT on_file AND c_nationkey = 5))""",
    "core_relationship": """
        SELECT account_id, account_id AS customer_id, 'PRIMARY' AS type FROM acct_all WHERE on_file""",
    "stg_relationship": """
        SELECT DATE '1998-01-01' AS batch_date, 'relationship_19980101.dat' AS source_file,
               account_id * 10 + k AS source_line, account_id,
               CASE WHEN k = 1 AND c_nationkey = 9 THEN account_id + 900000000
                    WHEN k = 1 THEN account_id + 1 ELSE account_id END AS customer_id,
               CASE WHEN k = 1 THEN 'SECONDARY' ELSE 'PRIMARY' END AS type
        FROM acct_all, (VALUES (0), (1), (2)) d(k) WHERE sent AND (k < 2 OR c_nationkey = 8)""",
    "txn_all": """
        SELECT CAST(o_orderdate AS DATE) AS batch_date, o_orderkey + 1 AS transaction_id, o_custkey + 1 AS account_id,
               CASE WHEN o_orderstatus = 'F' THEN 'DR' ELSE 'CR' END AS type,
               CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
               DATE '1994-01-01' + CAST((o_custkey * 37) % 2000 AS INT) < DATE '1997-07-01' AS on_file,
               o_orderstatus AS status, o_orderpriority AS priority
        FROM orders""",
    "core_transaction": """
        SELECT transaction_id, account_id, type, amount, batch_date FROM txn_all
        WHERE batch_date < DATE '1998-01-01' AND on_file""",
    "stg_transaction": """
        SELECT DATE '1998-01-01' AS batch_date, 'transaction_19980101.dat' AS source_file,
               transaction_id + k * 1000000000000 AS source_line, transaction_id, account_id, type,
               CASE WHEN batch_date < DATE '1998-01-01' AND status = 'P' AND priority = '5-LOW'
                    THEN amount + 1 ELSE amount END AS amount
        FROM txn_all, (VALUES (0), (1)) d(k)
        WHERE (batch_date >= DATE '1998-01-01'
               AND (k = 0 OR (status = 'P' AND priority = '1-URGENT' AND amount > 40000000)))
           OR (batch_date < DATE '1998-01-01' AND k = 0 AND (batch_date >= DATE '1997-11-01' OR NOT on_file))""",
    "core_balance": """
        SELECT a.account_id, CAST(coalesce(sum(CASE WHEN t.type = 'CR' THEN t.amount ELSE -t.amount END), 0) AS BIGINT)
                 AS balance
        FROM core_account a LEFT JOIN core_transaction t ON a.account_id = t.account_id GROUP BY a.account_id""",
    "new_account": """
        SELECT DISTINCT account_id FROM stg_account s
        WHERE NOT EXISTS (SELECT 1 FROM core_account c WHERE c.account_id = s.account_id)""",
    "opening_balance": """
        SELECT account_id, balance FROM core_balance UNION ALL SELECT account_id, 0 FROM new_account""",
    "effective_account": """
        SELECT account_id, start_date, end_date, account_type FROM stg_account WHERE source_line < 1000000000000
        UNION ALL
        SELECT account_id, start_date, end_date, account_type FROM core_account c
        WHERE NOT EXISTS (SELECT 1 FROM stg_account s WHERE s.account_id = c.account_id)""",
    "clean_customer": "SELECT * FROM stg_customer WHERE source_line < 1000000000000",
    "clean_account": """
        SELECT * FROM stg_account
        WHERE source_line < 1000000000000 AND (end_date IS NULL OR end_date >= start_date)""",
    "effective_clean_account": """
        SELECT account_id, start_date, end_date, account_type FROM clean_account
        UNION ALL
        SELECT account_id, start_date, end_date, account_type FROM core_account c
        WHERE NOT EXISTS (SELECT 1 FROM clean_account s WHERE s.account_id = c.account_id)""",
    "clean_relationship": """
        SELECT batch_date, source_file, min(source_line) AS source_line, account_id, customer_id, type
        FROM stg_relationship r
        WHERE customer_id IN (SELECT customer_id FROM core_customer UNION SELECT customer_id FROM clean_customer)
          AND EXISTS (SELECT 1 FROM effective_clean_account a WHERE a.account_id = r.account_id)
        GROUP BY batch_date, source_file, account_id, customer_id, type""",
    "clean_transaction": """
        SELECT s.* FROM stg_transaction s LEFT JOIN effective_clean_account a ON s.account_id = a.account_id
        LEFT JOIN core_transaction o ON s.transaction_id = o.transaction_id
        WHERE s.source_line < 1000000000000
          AND ((o.transaction_id IS NULL AND a.account_id IS NOT NULL AND a.end_date IS NULL
                AND a.start_date <= s.batch_date)
            OR (o.transaction_id IS NOT NULL AND o.account_id = s.account_id AND o.type = s.type
                AND o.amount = s.amount))""",
    "clean_new_account": """
        SELECT account_id FROM clean_account s
        WHERE NOT EXISTS (SELECT 1 FROM core_account c WHERE c.account_id = s.account_id)""",
    "clean_posted": """
        SELECT * FROM clean_transaction t
        WHERE NOT EXISTS (SELECT 1 FROM core_transaction o WHERE o.transaction_id = t.transaction_id)""",
    "clean_balance_after": """
        SELECT b.account_id, CAST(b.balance + coalesce(d.delta, 0) AS BIGINT) AS balance
        FROM (SELECT account_id, balance FROM core_balance
              UNION ALL SELECT account_id, 0 FROM clean_new_account) b
        LEFT JOIN (SELECT account_id, sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS delta
                   FROM clean_posted GROUP BY account_id) d ON b.account_id = d.account_id""",
    "clean_snapshot": """
        SELECT b.account_id, b.balance FROM clean_balance_after b
        WHERE b.account_id IN (SELECT account_id FROM clean_new_account UNION SELECT account_id FROM clean_posted)""",
    "account_feed": """
        SELECT opened + k * 400 AS batch_date, account_id, opened AS start_date, CAST(NULL AS DATE) AS end_date,
               CASE WHEN saving = (k = 0) THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type
        FROM (SELECT c_custkey + 1 AS account_id, DATE '1994-03-01' + CAST((c_custkey * 37) % 300 AS INT) AS opened,
                     c_mktsegment IN ('MACHINERY', 'BUILDING') AS saving FROM customer), (VALUES (0), (1)) d(k)
        UNION ALL
        SELECT DATE '2000-01-01' + CAST((c_custkey * 7) % 200 AS INT), c_custkey + 1,
               DATE '1994-03-01' + CAST((c_custkey * 37) % 300 AS INT),
               DATE '2000-01-01' + CAST((c_custkey * 7) % 200 AS INT),
               CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'CHECKING' ELSE 'SAVINGS' END
        FROM customer WHERE c_acctbal < -500""",
    "txn_feed": """
        SELECT batch_date + k * 30 AS batch_date, transaction_id + k * 1000000000000 AS source_line, transaction_id,
               account_id, type,
               CASE WHEN k = 1 AND amount > 45000000 AND batch_date >= DATE '1998-01-01'
                    THEN amount + 1 ELSE amount END AS amount
        FROM txn_all, (VALUES (0), (1)) d(k) WHERE k = 0 OR (status = 'F' AND priority = '5-LOW')""",
    "winner": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY batch_date, source_line) AS rn
          FROM txn_feed) WHERE rn = 1""",
    "md_delta": """
        SELECT account_id, batch_date, sum(CASE WHEN type = 'CR' THEN amount ELSE -amount END) AS delta
        FROM winner GROUP BY account_id, batch_date""",
    "line_item_txn": """
        SELECT DATE '1998-01-01' AS batch_date, l_orderkey * 10 + l_linenumber + 1 AS transaction_id,
               l_partkey * 10000 + l_suppkey + 1 AS source_line FROM lineitem""",
    "arrivals": """
        SELECT event_id, ts, event_type AS topic, user_id % 4 AS part, event_id AS off, user_id + 1 AS account_id,
               CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END AS control_date,
               CAST(round(value * 100) AS BIGINT) AS amount
        FROM events""",
    "stamped": """
        SELECT * FROM (SELECT *, max(control_date) OVER (ORDER BY ts, event_id) + 1 AS batch_date FROM arrivals)
        WHERE control_date IS NULL""",
    "opening_credit": """
        SELECT c_custkey + 1 AS transaction_id, c_custkey + 1 AS account_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'DR' WHEN 'FURNITURE' THEN 'credit' ELSE 'CR' END AS type,
               CAST(round(c_acctbal * 100) AS BIGINT) AS amount
        FROM customer""",
    "business_day": """
        SELECT CAST(o_orderdate AS DATE) AS batch_date, count(*) AS orders FROM orders GROUP BY 1""",
    # One attempt per date; on the 15th the first attempt fails and a second follows; July 2001 is open, with a
    # failure on the 10th; nothing on the 28th was ever started.
    "attempt": """
        SELECT batch_date, strftime(batch_date, '%Y%m%d') || '-' || k AS batch_run_id,
               CASE WHEN (k = 1 AND day(batch_date) = 15) OR batch_date >= DATE '2001-07-01' THEN 'FAILED'
                    ELSE 'COMPLETED' END AS status, k, orders
        FROM business_day, (VALUES (1), (2)) d(k)
        WHERE day(batch_date) <> 28 AND (k = 1 OR day(batch_date) = 15)
          AND (batch_date < DATE '2001-07-01' OR (batch_date = DATE '2001-07-10' AND k = 1))""",
}


def statement(sql: str) -> str:
    """``sql`` with the views it names, and those they name, as one WITH clause."""
    ordered: list[str] = []

    def need(text: str, inside: str = "") -> None:
        for name in VIEWS:
            if name != inside and name not in ordered and re.search(rf"\b{name}\b", text):
                need(VIEWS[name], name)
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    return f"WITH {views}\n{sql.strip()}"
