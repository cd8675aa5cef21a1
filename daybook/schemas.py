"""Fixed schemas: record layouts of the files and the tables of the ledger. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    width: int
    kind: str  # id, text, date, optional_date, enum or amount
    values: tuple[str, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return {
            "id": T.LongType(),
            "amount": T.LongType(),
            "date": T.DateType(),
            "optional_date": T.DateType(),
        }.get(self.kind, T.StringType())


@dataclass(frozen=True)
class Layout:
    record: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def width(self) -> int:
        return sum(f.width for f in self.fields)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def values(self) -> list[str]:
        return [f.name for f in self.fields if f.name not in self.keys]

    @property
    def has_text(self) -> bool:
        return any(f.kind == "text" for f in self.fields)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])


# Record layouts, code lists and widths of the file contract.
ACCOUNT_TYPES = ("SAVINGS", "CHECKING")
RELATIONSHIP_TYPES = ("PRIMARY", "SECONDARY")
TRANSACTION_TYPES = ("CR", "DR")
RUN_STATUSES = ("RUNNING", "COMPLETED", "FAILED")

CUSTOMER = Layout("customer", ("customer_id",), (
    Field("customer_id", 19, "id"),
    Field("first_name", 10, "text"),
    Field("last_name", 10, "text"),
    Field("address_line1", 20, "text"),
    Field("city", 10, "text"),
    Field("province", 2, "text"),
    Field("postal_code", 7, "text"),
    Field("country", 10, "text"),
))
ACCOUNT = Layout("account", ("account_id",), (
    Field("account_id", 19, "id"),
    Field("start_date", 10, "date"),
    Field("end_date", 10, "optional_date"),
    Field("account_type", 8, "enum", ACCOUNT_TYPES),
))
RELATIONSHIP = Layout("relationship", ("account_id", "customer_id"), (
    Field("account_id", 19, "id"),
    Field("customer_id", 19, "id"),
    Field("type", 9, "enum", RELATIONSHIP_TYPES),
))
TRANSACTION = Layout("transaction", ("transaction_id",), (
    Field("transaction_id", 19, "id"),
    Field("account_id", 19, "id"),
    Field("type", 6, "enum", TRANSACTION_TYPES),
    Field("amount", 20, "amount"),
))
LAYOUTS = {layout.record: layout for layout in (CUSTOMER, ACCOUNT, RELATIONSHIP, TRANSACTION)}

LINEAGE = T.StructType([
    T.StructField("batch_date", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_line", T.LongType()),
])


def staged_schema(layout: Layout) -> T.StructType:
    return T.StructType(LINEAGE.fields + layout.schema.fields)


AUDIT = [T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())]

BALANCE = T.StructType([T.StructField("account_id", T.LongType()), T.StructField("balance", T.LongType())])

LEDGER = T.StructType(TRANSACTION.schema.fields + [
    T.StructField("batch_date", T.DateType()),
    T.StructField("batch_run_id", T.StringType()),
])

RUN_COUNTS = [f"{record}_count" for record in LAYOUTS]

RUN_EVENT = T.StructType(
    [
        T.StructField("batch_run_id", T.StringType()),
        T.StructField("batch_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
    + [T.StructField(name, T.LongType()) for name in RUN_COUNTS]
    + [T.StructField("error_message", T.StringType())]
)

RECEIPT = T.StructType([
    T.StructField("batch_date", T.DateType()),
    T.StructField("ingested_at", T.TimestampType()),
])

LISTING = T.StructType([
    T.StructField("directory", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("is_regular", T.BooleanType()),
])
