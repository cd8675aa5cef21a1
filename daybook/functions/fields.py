"""Column expressions for fixed-width fields, money and dates. All built in but for NFC."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import Field

# Characters no field may hold, and the range of cents.
FORBIDDEN = r"[\x{0000}-\x{001F}\x{007F}-\x{009F}\x{FEFF}\x{2028}\x{2029}]"
MIN_CENTS = -(2**63)
MAX_CENTS = 2**63 - 1


# The signs that are not ASCII but whose normal form is, and that form (KELVIN SIGN, GREEK QUESTION
# MARK, GREEK VARIA).
ASCII_TWINS = {"\u212a": "K", "\u037e": ";", "\u1fef": "`"}


@F.arrow_udf(T.StringType())
def nfc(text: pa.Array) -> pa.Array:
    """A batch is normalized in one call; NUL separates its texts, as it composes with nothing."""
    texts = text.drop_null().to_pylist()
    found = unicodedata.normalize("NFC", "\0".join(texts)).split("\0")
    if len(found) != len(texts):  # none at all, or some hold the separator
        found = [unicodedata.normalize("NFC", t) for t in texts]
    filled = iter(found)
    return pa.array([next(filled) if known else None for known in text.is_valid().to_pylist()], pa.string())


def ascii_normalized(text: Column) -> Column:
    """NFC of texts whose normal form is ASCII, without Python; other texts keep a sign that is not ASCII."""
    return F.translate(text, "".join(ASCII_TWINS), "".join(ASCII_TWINS.values()))


def is_ascii(text: Column) -> Column:
    """ASCII text is its own NFC form, so only other rows need Python."""
    return F.octet_length(text) == F.length(text)


def normalized(text: Column) -> Column:
    """NFC of valid text. Python receives nulls for ASCII and for malformed rows."""
    ascii_only = is_ascii(text)
    return F.when(ascii_only, text).otherwise(nfc(F.when(~ascii_only & F.is_valid_utf8(text), text)))


def has_forbidden(text: Column) -> Column:
    return text.rlike(FORBIDDEN)


def digits_value(raw: Column) -> Column:
    """Unsigned decimal digits that fit 64 bits, else null.

    The cast alone takes signs and strips more than spaces, so the digits must read back as they were written.
    """
    text = F.trim(raw)
    value = text.try_cast("bigint")
    digits = F.when(value == 0, "").otherwise(value.cast("string"))
    return F.when((text != "") & (value >= 0) & (F.ltrim(text, F.lit("0")) == digits), value)


def id_value(raw: Column) -> Column:
    value = digits_value(raw)
    return F.when(value > 0, value)


def date_value(raw: Column) -> Column:
    """A real calendar day in exactly YYYY-MM-DD; the raw field is not trimmed."""
    value = raw.try_cast("date")
    return F.when(value.cast("string") == raw, value)


def enum_value(raw: Column, values: tuple[str, ...]) -> Column:
    text = F.trim(raw)
    return F.when(text.isin(*values), text)


def field_value(raw: Column, field: Field) -> Column:
    if field.kind == "id":
        return id_value(raw)
    if field.kind == "amount":
        return digits_value(raw)
    if field.kind in ("date", "optional_date"):
        return date_value(raw)
    if field.kind == "enum":
        return enum_value(raw, field.values)
    return F.trim(raw)


def field_is_bad(raw: Column, field: Field) -> Column:
    """Whether the raw field breaks its rule. Ten spaces are an absent optional date."""
    bad = field_value(raw, field).isNull()
    if field.kind == "optional_date":
        return bad & (raw != " " * field.width)
    if field.kind == "text":
        return F.lit(False)
    return bad


def text_field(value: Column, width: int, ascii_only: bool = False) -> Column:
    """Left-aligned text padded to ``width``; too long or forbidden text stops the job."""
    text = value if ascii_only else normalized(value)
    return (
        F.when(text.isNull(), F.raise_error(F.lit("a text field must not be null")))
        .when(has_forbidden(text), F.raise_error(F.lit("forbidden character in a text field")))
        .when(F.length(text) > width, F.raise_error(F.lit(f"text field exceeds {width} positions")))
        .otherwise(F.rpad(text, width, " "))
    )


def number_field(value: Column, width: int) -> Column:
    """Right-aligned nonnegative number padded to ``width``."""
    text = value.cast("string")
    return (
        F.when(value.isNull() | (value < 0), F.raise_error(F.lit("a number field must be nonnegative")))
        .when(F.length(text) > width, F.raise_error(F.lit(f"number field exceeds {width} positions")))
        .otherwise(F.lpad(text, width, " "))
    )


def date_field(value: Column, width: int) -> Column:
    return F.rpad(F.coalesce(value.cast("string"), F.lit("")), width, " ")


def formatted_field(value: Column, field: Field, ascii_only: bool = False) -> Column:
    if field.kind in ("id", "amount"):
        return number_field(value, field.width)
    if field.kind in ("date", "optional_date"):
        return date_field(value, field.width)
    return text_field(value, field.width, ascii_only or field.kind == "enum")


def balance_line(account_id: Column, balance: Column) -> Column:
    return F.format_string("%19d%20d", account_id, balance)


def signed_amount(kind: Column, amount: Column) -> Column:
    """CR adds and DR subtracts, as a decimal so that sums stay exact beyond 64 bits."""
    wide = amount.cast("decimal(19,0)")
    return F.when(kind == "CR", wide).otherwise(-wide)


def in_cents_range(total: Column) -> Column:
    return total.between(F.lit(MIN_CENTS).cast("decimal(20,0)"), F.lit(MAX_CENTS).cast("decimal(20,0)"))


def checked_cents(total: Column) -> Column:
    """A decimal total as signed 64-bit cents; out of range stops the job whatever the ANSI setting."""
    return F.when(total.isNull() | in_cents_range(total), total.cast("bigint")).otherwise(
        F.raise_error(F.lit("balance outside signed 64-bit cents")).cast("bigint")
    )


def day(value: dt.date | str) -> Column:
    """A date literal of any year from 1 on."""
    return F.lit(value if isinstance(value, str) else value.isoformat()).cast("date")


def compact(value: dt.date) -> str:
    return value.isoformat().replace("-", "")


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def parsed_compact_date(text: Column) -> Column:
    """Eight digits that name a real day, else null."""
    date = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(r"\A[0-9]{8}\z") & ~text.startswith("0000"), date.try_cast("date"))


def batch_date(value: dt.date | str) -> dt.date:
    """A batch date argument: strict ISO, years 1 to 9999."""
    if isinstance(value, dt.datetime):
        raise ValueError("a batch date has no time of day")
    if isinstance(value, dt.date):
        return value
    if len(value) != 10:
        raise ValueError(f"batch date must be YYYY-MM-DD: {value!r}")
    return dt.datetime.strptime(value, "%Y-%m-%d").date()
