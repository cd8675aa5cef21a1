"""Generated batches: accepted by the scans, self-contained, reproducible, never overwriting."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import generate
from daybook.operators.rules import Staged, State
from daybook.plans.daily import Ledger
from daybook.schemas import ACCOUNT, BALANCE, CUSTOMER, LAYOUTS, LEDGER, RELATIONSHIP, TRANSACTION, staged_schema
from daybook.session import local_rows
from daybook.sources.values import read_values

DATE = dt.date(2026, 10, 9)


def pools(spark, accounts=(), customers=(), pairs=(), used_transactions=()):
    def rows(schema, keys, values):
        return local_rows(spark, [dict(zip(keys, v)) for v in values], schema)

    state = State(
        customer=rows(CUSTOMER.schema, ["customer_id"], customers),
        account=rows(ACCOUNT.schema, ["account_id", "start_date", "end_date"], accounts),
        relationship=rows(RELATIONSHIP.schema, ["account_id", "customer_id"], pairs),
        balance=rows(BALANCE, [], []),
        ledger=rows(LEDGER, ["transaction_id"], used_transactions),
    )
    staged = Staged(DATE, **{r: local_rows(spark, [], staged_schema(layout)) for r, layout in LAYOUTS.items()})
    return generate.pools(state, staged, DATE)


def test_generated_batch_can_be_posted_and_is_reproducible(spark, tmp_path):
    request = generate.Request(DATE, 10, 10, 10, 10, 42)
    texts = []
    for folder in ("one", "two"):
        batch = generate.generate(spark, pools(spark), request)
        paths = generate.write_batch(spark, batch, str(tmp_path / folder), request)
        texts.append([open(p, encoding="utf-8").read() for p in paths])
    assert texts[0] == texts[1] and all(len(t.splitlines()) == 10 for t in texts[0])
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    counts = ledger.ingest(str(tmp_path / "one"), DATE)
    assert counts == dict.fromkeys(LAYOUTS, 10) == ledger.process(DATE)
    with pytest.raises(FileExistsError):
        generate.write_batch(spark, batch, str(tmp_path / "one"), request)


def test_transactions_use_open_accounts_only(spark, tmp_path):
    early, late = dt.date(2026, 1, 1), dt.date(2027, 1, 1)
    request = generate.Request(DATE, 0, 0, 0, 25, 42)
    batch = generate.generate(spark, pools(spark, [(1, early, None), (2, early, late), (3, late, None)]), request)
    rows = batch["transaction"].collect()
    assert len({r["transaction_id"] for r in rows}) == 25 and {r["account_id"] for r in rows} == {1}
    assert all(1 <= r["amount"] <= 100_000 for r in rows)
    paths = generate.write_batch(spark, batch, str(tmp_path), request)
    assert [open(p).read() == "" for p in paths] == [True, True, True, False]


def test_unused_pairs_and_exhaustion(spark):
    accounts = spark.range(1, 31).select(F.col("id").alias("account_id"))
    customers = spark.range(1, 21).select(F.col("id").alias("customer_id"))
    taken = accounts.crossJoin(customers).where((F.col("account_id") + F.col("customer_id")) % 3 != 0)
    free = 600 - taken.count()
    for n in (0, 1, 57, free):
        got = generate.unused_pairs(accounts, customers, taken, n, 42, DATE)
        assert got.count() == n == got.distinct().count()
        assert got.join(taken, ["account_id", "customer_id"], "left_semi").count() == 0
    with pytest.raises(ValueError, match="are unused"):
        generate.unused_pairs(accounts, customers, taken, free + 1, 42, DATE)


def test_a_rank_finds_its_free_number(spark, monkeypatch):
    monkeypatch.setattr(generate, "TAKEN_IN_STRETCH", 7)
    size = 503
    taken = sorted({k * k % size for k in range(150)} | set(range(200, 290)))
    free = [x for x in range(size) if x not in taken]
    numbers = spark.createDataFrame([(t,) for t in taken], "number long")
    ranks = spark.range(len(free)).select(F.col("id").alias("row"), F.col("id").alias("rank"))
    found = generate.free_numbers(numbers, len(taken), size, ranks).collect()
    assert [r["number"] for r in sorted(found)] == free


def test_the_permutation_is_one_to_one_for_every_size(spark):
    for size in (1, 2, 97, 1000):
        found = [r["x"] for r in spark.range(size).select(generate.permuted(F.col("id"), size, 9).alias("x")).collect()]
        assert sorted(found) == list(range(size))
    other = [r["x"] for r in spark.range(1000).select(generate.permuted(F.col("id"), 1000, 10).alias("x")).collect()]
    assert found != other and found != list(range(1000)) and len({b - a for a, b in zip(found, found[1:])}) > 300


def test_values_are_drawn_from_lists_of_any_length(spark):
    values = spark.range(20_000).select(F.concat(F.lit("v"), F.col("id")).alias("value"))
    rows = spark.range(3000).select(F.col("id").alias("row"))
    draw = generate._draw(4, DATE, "first", F.col("row"))
    found = [generate.drawn(rows, draw, values, "first_name").collect() for _ in range(2)]
    assert sorted(found[0]) == sorted(found[1]) and sorted(r["row"] for r in found[0]) == list(range(3000))
    assert len({r["first_name"] for r in found[0]}) > 2500
    plan = generate.drawn(rows, draw, values, "first_name")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "v19999" not in plan
    with pytest.raises(ValueError, match="no value to draw first_name from"):
        generate.drawn(rows, draw, values.limit(0), "first_name")


def test_taken_ids_are_drawn_again(spark):
    nothing = spark.range(0).select(F.col("id").alias("account_id"))
    first = generate.draw_ids(spark, 20, nothing, "account_id", 42, DATE)
    again = generate.draw_ids(spark, 20, first.select("account_id"), "account_id", 42, DATE)
    assert again.count() == 20 == again.select("account_id").distinct().count()
    assert again.join(first, "account_id", "left_semi").count() == 0


def test_requests_and_value_lists(spark, tmp_path):
    with pytest.raises(ValueError):
        generate.Request(DATE, -1, 0, 0, 0, 1)
    with pytest.raises(ValueError, match="transactions need"):
        generate.generate(spark, pools(spark), generate.Request(DATE, 0, 0, 0, 1, 42))
    path = tmp_path / "names.txt"
    path.write_text("# ten at most\nOla\n\n  \nJosé\n", encoding="utf-8")
    assert sorted(r["value"] for r in read_values(spark, str(path), 10).collect()) == ["José", "Ola"]
    with pytest.raises(Exception, match="exceeds 3"):
        read_values(spark, str(path), 3).collect()
    assert {f.name for f in TRANSACTION.fields} == {"transaction_id", "account_id", "type", "amount"}


def test_a_failed_publication_takes_back_what_was_published(spark, tmp_path, monkeypatch):
    from daybook.sources import files

    request = generate.Request(DATE, 2, 2, 2, 2, 42)
    batch = generate.generate(spark, pools(spark), request)
    publish = files.publish_lines

    def failing(lines, order, target, **how):
        if "transaction" in target:
            raise OSError("no space")
        publish(lines, order, target, **how)

    monkeypatch.setattr(files, "publish_lines", failing)
    with pytest.raises(OSError, match="no space"):
        generate.write_batch(spark, batch, str(tmp_path / "out"), request)
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == []
    monkeypatch.undo()
    assert len(generate.write_batch(spark, batch, str(tmp_path / "out"), request)) == 4


def test_a_plain_file_is_joined_from_parts_that_were_sorted_apart(spark, tmp_path, monkeypatch):
    from daybook.sources import files

    joined, join = [], files.join_parts

    def counting(session, directory):
        joined.append(sum(name.startswith("part-") for name in files.names(session, directory)))
        return join(session, directory)

    monkeypatch.setattr(files, "join_parts", counting)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = spark.range(0, 20_000, 1, 4).select((F.col("id") * 7919 % 20_011).alias("key"))
        lines = lines.select("key", F.format_string("%06d", "key").alias("value"))
        files.publish_lines(lines, ["key"], str(tmp_path / "plain.dat"), empty=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = (tmp_path / "plain.dat").read_text()
    assert joined == [2] and text == "".join(sorted(f"{i * 7919 % 20_011:06d}\n" for i in range(20_000)))
    assert [p.name for p in tmp_path.iterdir() if p.is_dir()] == []


@pytest.mark.parametrize("name", ["balance_file_lines", "gen_batch"])
def test_queries_publish_ordered_parts(spark, monkeypatch, name):
    from daybook.plans import queries
    from daybook.sources import files

    forms, publish = [], files.publish_lines
    monkeypatch.setattr(files, "publish_lines", lambda *a, **how: (forms.append(how["as_parts"]), publish(*a, **how)))
    assert queries.run(name, spark, "/root/testdata/sf0.001").count() > 0
    assert forms and all(forms)
