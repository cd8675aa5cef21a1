"""Generated batches for development: reproducible from a seed, self-contained, and drawn without a driver loop.

Draws are hashes of (seed, date, row, purpose), so any task can make its rows on its own. They are reproducible
but not the sequence of any particular random generator.
"""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import fields as fx
from daybook.functions.ranking import with_position
from daybook.operators.references import eligible_accounts
from daybook.schemas import ACCOUNT_TYPES, LAYOUTS, RELATIONSHIP_TYPES, TRANSACTION_TYPES
from daybook.session import durable, local_rows
from daybook.sources import files, fixed_width

# Ranges and constant fields of generated records.
MAX_ID = 2**63 - 1
MAX_AMOUNT = 100_000
MAX_HOUSE_NUMBER = 9_999
CITY, PROVINCE, POSTAL_CODE, COUNTRY = "Toronto", "ON", "M5V 2T6", "Canada"
NAME_WIDTH, STREET_WIDTH = 10, 15

# Default values for names and streets; pass tables of ``sources.values`` for lists of any length.
FIRST_NAMES = ("Ada", "Bruno", "Carla", "Dmitri", "Elif", "Farid", "Greta", "Hugo", "Ines", "Zoë")
LAST_NAMES = ("Ahmed", "Bauer", "Costa", "Dubois", "Evans", "Fischer", "García", "Hansen", "Ivanov", "Jansen")
STREETS = ("Birch Ave", "Cedar Lane", "Elm St", "Harbour Rd", "King St", "Lake Shore", "Mill Rd", "Oak Cres")
# Taken pair numbers that a stretch holds on average, and rounds of the permutation of free ones.
TAKEN_IN_STRETCH = 4096
PERMUTATION_ROUNDS = 32


@dataclass(frozen=True)
class Request:
    date: dt.date
    customers: int
    accounts: int
    relationships: int
    transactions: int
    seed: int

    def __post_init__(self):
        if min(self.customers, self.accounts, self.relationships, self.transactions) < 0:
            raise ValueError("record counts must be nonnegative")


@dataclass(frozen=True)
class Pools:
    """What generation draws from: IDs on file, open accounts, existing pairs and IDs in use anywhere."""

    customers: DataFrame
    accounts: DataFrame
    eligible: DataFrame
    pairs: DataFrame
    used_customers: DataFrame
    used_accounts: DataFrame
    used_transactions: DataFrame


def used_ids(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """IDs in current state or in staging, each once."""
    return current.select(key).union(staged.select(key)).distinct()


def pools(state, staged, date: dt.date) -> Pools:
    """Pools from published tables (``rules.State``) and staged rows (``rules.Staged`` or many-date feeds)."""
    return Pools(
        customers=state.customer.select("customer_id"),
        accounts=state.account.select("account_id"),
        eligible=eligible_accounts(state.account, date),
        pairs=state.relationship.select("account_id", "customer_id"),
        used_customers=used_ids(state.customer, staged.customer, "customer_id"),
        used_accounts=used_ids(state.account, staged.account, "account_id"),
        used_transactions=used_ids(state.ledger, staged.transaction, "transaction_id"),
    )


def _draw(seed: int, date: dt.date, purpose: str, *on: Column) -> Column:
    return F.xxhash64(F.lit(seed ^ date.toordinal()), F.lit(purpose), *on)


def _pick(draw: Column, values: tuple[str, ...]) -> Column:
    """One of a fixed list of codes."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(draw, F.lit(len(values))) + 1).cast("int"))


def drawn(rows: DataFrame, draw: Column, values: tuple[str, ...] | DataFrame, name: str) -> DataFrame:
    """``rows`` with a value drawn from a list, by joining its position in the list.

    A list is a table with ``value``, in order of its values, or a tuple in its own order. A short one is broadcast by
    its size; a long one is shuffled, and its positions are drawn evenly. A value that stands twice is drawn twice as often.
    """
    spark = rows.sparkSession
    if isinstance(values, DataFrame):
        ranked = with_position(values.select(F.col("value").alias(name)), [name], "_at")
    else:
        schema = T.StructType([T.StructField("_at", T.LongType()), T.StructField(name, T.StringType())])
        ranked = local_rows(spark, [{"_at": i, name: v} for i, v in enumerate(values)], schema)
    n = ranked.count()
    if not n:
        raise ValueError(f"no value to draw {name} from")
    at = rows.withColumn("_at", F.pmod(draw, F.lit(n)))
    return at.join(ranked, "_at").drop("_at")


def draw_ids(spark: SparkSession, n: int, used: DataFrame, key: str, seed: int, date: dt.date) -> DataFrame:
    """``n`` positive IDs (row, key), distinct and unused. Rows whose draw is taken are drawn again."""

    def candidates(rows: DataFrame, attempt: int) -> DataFrame:
        return rows.select(
            "row", _draw(seed, date, key, F.col("row"), F.lit(attempt)).bitwiseAND(F.lit(MAX_ID)).alias(key)
        )

    def unique(drawn: DataFrame) -> DataFrame:
        return drawn.where(F.col(key) > 0).groupBy(key).agg(F.min("row").alias("row")).select("row", key)

    rows = spark.range(n).select(F.col("id").alias("row"))
    good = durable(unique(candidates(rows, 0)).join(used, key, "left_anti"), "ids")
    attempt = 0
    while good.count() < n:
        attempt += 1
        again = candidates(rows.join(good, "row", "left_anti"), attempt)
        fresh = unique(again).join(used, key, "left_anti").join(good, key, "left_anti").select("row", key)
        good = durable(good.select("row", key).unionByName(fresh), "ids")
    return good.select("row", key)


def permuted(x: Column, size: int, key: int) -> Column:
    """A keyed permutation of the numbers below ``size`` (swap or not): a bijection for every size, without a sort."""
    draw = random.Random(key)
    offsets = F.array(*[F.lit(draw.randrange(size)).cast("bigint") for _ in range(PERMUTATION_ROUNDS)])

    def swapped(value: Column, offset: Column) -> Column:
        other = F.pmod(offset - value, F.lit(size).cast("bigint"))
        swap = F.xxhash64(F.lit(key), offset, F.greatest(value, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(value)

    return F.aggregate(offsets, x, swapped)


def free_numbers(taken: DataFrame, n_taken: int, size: int, ranks: DataFrame) -> DataFrame:
    """``row, number``: for each ``row, rank`` the number below ``size`` that has ``rank`` free numbers before it.

    ``taken`` (``number``, distinct) is counted by stretches of numbers; the stretch of a rank is found by an equi-join
    over cells of ranks, and only stretches that a rank falls into have their taken numbers looked at, in order.
    """
    spark = taken.sparkSession
    n_stretches = max(1, min(size, n_taken // TAKEN_IN_STRETCH))
    stretch = -(-size // n_stretches)
    counted = taken.groupBy(F.expr(f"number div {stretch}").alias("stretch")).agg(F.count(F.lit(1)).alias("used"))
    stretches = spark.range(n_stretches).select(F.col("id").alias("stretch")).join(counted, "stretch", "left")
    held = F.greatest(F.least(F.lit(stretch), F.lit(size) - F.col("stretch") * stretch), F.lit(0)) - F.coalesce("used", F.lit(0))
    upto = F.sum("free").over(W.orderBy("stretch").rowsBetween(W.unboundedPreceding, 0))
    stretches = stretches.withColumn("free", held).withColumn("before", upto - F.col("free")).where(F.col("free") > 0)
    cell = max(1, (size - n_taken) // n_stretches)
    cells = F.sequence(F.expr(f"before div {cell}"), F.expr(f"(before + free - 1) div {cell}"))
    placed = durable(stretches.select("stretch", "before", "free", F.explode(cells).alias("cell")), "stretches")
    inside = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("free"))
    found = ranks.withColumn("cell", F.expr(f"rank div {cell}")).join(placed, "cell").where(inside)
    asked = durable(found.select("row", "stretch", (F.col("rank") - F.col("before")).alias("nth")), "ranks")
    # A taken number pushes on every free one at or after its own rank among the free: count those per rank.
    used = taken.withColumn("stretch", F.expr(f"number div {stretch}"))
    used = used.join(asked.select("stretch").distinct(), "stretch", "left_semi")
    nth_used = F.row_number().over(W.partitionBy("stretch").orderBy("number")) - 1
    used = used.select("stretch", (F.col("number") - F.col("stretch") * stretch - nth_used).alias("at"), F.lit(None).cast("bigint").alias("row"))
    both = used.unionByName(asked.select("stretch", F.col("nth").alias("at"), "row"))
    order = W.partitionBy("stretch").orderBy("at", F.col("row").asc_nulls_first())
    pushed = F.sum(F.when(F.col("row").isNull(), 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0))
    number = F.col("stretch") * stretch + F.col("at") + pushed
    return both.withColumn("number", number).where(F.col("row").isNotNull()).select("row", "number")


def unused_pairs(
    accounts: DataFrame, customers: DataFrame, pairs: DataFrame, n: int, seed: int, date: dt.date
) -> DataFrame:
    """``n`` unused (account, customer) pairs, chosen by the seed, without forming the product.

    Pair number t stands for account t div C and customer t mod C in order of their IDs. The unused pairs are the free
    numbers; a keyed permutation of their ranks gives the first n of a random order, and each rank's number follows
    from how many taken numbers lie below it. Existing pairs are counted once; everything else is work in n.
    """
    spark = accounts.sparkSession
    ranked = {}
    for key, pool in (("account_id", accounts), ("customer_id", customers)):
        ranked[key] = with_position(pool.select(key).distinct(), [key], f"{key}_position")
    n_accounts, n_customers = ranked["account_id"].count(), ranked["customer_id"].count()
    number = F.col("account_id_position") * n_customers + F.col("customer_id_position")
    taken = pairs.select("account_id", "customer_id").distinct()
    taken = taken.join(ranked["account_id"], "account_id").join(ranked["customer_id"], "customer_id")
    taken = durable(taken.select(number.alias("number")), "taken")
    n_taken = taken.count()
    n_free = n_accounts * n_customers - n_taken
    if n > n_free:
        raise ValueError(f"{n} pairs asked for, {n_free} are unused")
    if not n:
        return pairs.select("account_id", "customer_id").limit(0)
    rank = permuted(F.col("id"), n_free, seed ^ date.toordinal())
    ranks = spark.range(n).select(F.col("id").alias("row"), rank.alias("rank"))
    chosen = free_numbers(taken, n_taken, n_accounts * n_customers, ranks).select(
        F.expr(f"number div {n_customers}").alias("account_id_position"),
        F.pmod("number", F.lit(n_customers)).alias("customer_id_position"),
    )
    decoded = chosen.join(ranked["account_id"], "account_id_position").join(ranked["customer_id"], "customer_id_position")
    return decoded.select("account_id", "customer_id")


def generate(
    spark: SparkSession,
    drawn_from: Pools,
    request: Request,
    first_names: tuple[str, ...] | DataFrame = FIRST_NAMES,
    last_names: tuple[str, ...] | DataFrame = LAST_NAMES,
    streets: tuple[str, ...] | DataFrame = STREETS,
) -> dict[str, DataFrame]:
    """The four record sets of a batch. New customers and accounts may be used by its own relationships and
    transactions; transactions go to open accounts only."""
    seed, date = request.seed, request.date
    row = F.col("row")
    customer_ids = draw_ids(spark, request.customers, drawn_from.used_customers, "customer_id", seed, date)
    account_ids = draw_ids(spark, request.accounts, drawn_from.used_accounts, "account_id", seed, date)
    transaction_ids = draw_ids(
        spark, request.transactions, drawn_from.used_transactions, "transaction_id", seed, date
    )
    house = F.pmod(_draw(seed, date, "house", row), F.lit(MAX_HOUSE_NUMBER)) + 1
    named = customer_ids
    for name, purpose, values in (("first_name", "first", first_names), ("last_name", "last", last_names), ("street", "street", streets)):
        named = drawn(named, _draw(seed, date, purpose, row), values, name)
    customers = named.select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat_ws(" ", house.cast("string"), "street").alias("address_line1"),
        F.lit(CITY).alias("city"),
        F.lit(PROVINCE).alias("province"),
        F.lit(POSTAL_CODE).alias("postal_code"),
        F.lit(COUNTRY).alias("country"),
    )
    accounts = account_ids.select(
        "account_id",
        fx.day(date).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        _pick(_draw(seed, date, "account-type", row), ACCOUNT_TYPES).alias("account_type"),
    )
    new_accounts, new_customers = account_ids.select("account_id"), customer_ids.select("customer_id")
    relationships = unused_pairs(
        drawn_from.accounts.union(new_accounts),
        drawn_from.customers.union(new_customers),
        drawn_from.pairs,
        request.relationships,
        seed,
        date,
    ).withColumn(
        "type",
        _pick(_draw(seed, date, "relationship-type", F.col("account_id"), F.col("customer_id")), RELATIONSHIP_TYPES),
    )
    eligible = with_position(drawn_from.eligible.union(new_accounts).distinct(), ["account_id"])
    n_eligible = eligible.count()
    if request.transactions and not n_eligible:
        raise ValueError("transactions need an account without end date that has started")
    transactions = (
        transaction_ids.withColumn(
            "position", F.pmod(_draw(seed, date, "account", row), F.lit(max(n_eligible, 1)))
        )
        .join(eligible, "position")
        .select(
            "transaction_id",
            "account_id",
            _pick(_draw(seed, date, "transaction-type", row), TRANSACTION_TYPES).alias("type"),
            (F.pmod(_draw(seed, date, "amount", row), F.lit(MAX_AMOUNT)) + 1).alias("amount"),
        )
    )
    return {
        "customer": customers,
        "account": accounts,
        "relationship": relationships,
        "transaction": transactions,
    }


def write_batch(
    spark: SparkSession, batch: dict[str, DataFrame], directory: str, request: Request, as_parts: bool = False
) -> list[str]:
    """Publish the four dated files; types without rows become zero-byte files and nothing is overwritten.

    Every file is formatted before any is published, so a bad value publishes nothing, and if a publication fails
    the files published before it are taken back. No trigger is written.
    """
    directory = directory.rstrip("/")
    compact = f"{fx.compact(request.date)}"
    targets = {record: f"{directory}/{record}_{compact}.dat" for record in LAYOUTS}
    for path in (*targets.values(), f"{directory}/batch_{compact}.trg"):
        if files.exists(spark, path):
            raise FileExistsError(path)
    wanted = {
        "customer": request.customers,
        "account": request.accounts,
        "relationship": request.relationships,
        "transaction": request.transactions,
    }
    lines = {
        record: durable(fixed_width.format_lines(batch[record], layout), f"generated-{record}")
        for record, layout in LAYOUTS.items()
    }
    published: list[str] = []
    try:
        for record, target in targets.items():
            files.publish_lines(lines[record], ["value"], target, empty=not wanted[record], as_parts=as_parts)
            published.append(target)
    except Exception:
        for target in published:
            files.delete(spark, target)
        raise
    return list(targets.values())
