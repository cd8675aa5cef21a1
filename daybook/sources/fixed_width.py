"""Fixed-width scans: raw lines, typed fields with a reject reason, and exact line numbers per file.

A dated file may be one file (``transaction_19980101.dat``) or a directory of that name holding ordered
parts, which is what a distributed writer leaves behind; its lines are numbered through the parts in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.schemas import Layout
from daybook.session import durable
from daybook.sources import files

# The byte order mark that the text source drops, and the shape of a dated file name.
BOM = b"\xef\xbb\xbf"
DATED_FILE = r"([a-z]+_[0-9]{8}\.dat)"
# A split is one row of about 150 bytes, so this many stay near 100 MB when broadcast.
MAX_BROADCAST_SPLITS = 700_000

# A rejected line whose fault nobody has asked for yet.
_UNRESOLVED = "unresolved"
_POSITION = ["file_path", "file_size", "split_start", "row_id"]


def read_lines(spark: SparkSession, paths: str | Sequence[str], positions: bool = True) -> DataFrame:
    """LF-separated lines as they are, on request with what is needed to number them later.

    Carriage returns and malformed bytes survive so that they can be rejected.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("lineSep", "\n").text(paths)
    if not positions:
        return lines.select("value")
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.octet_length("value").alias("octets"),
    )


def plain_lines(spark: SparkSession, path: str) -> DataFrame:
    """The numbered lines of a file without a layout: (source_line, value)."""
    lines = read_lines(spark, path).select(
        "*", F.monotonically_increasing_id().alias("row_id"), F.lit(None).cast("string").alias("reject_reason")
    )
    return number_lines(durable(lines, "plain-lines")).select("source_line", "value")


def _raw_fields(line: Column, layout: Layout) -> dict[str, Column]:
    raws, start = {}, 1
    for field in layout.fields:
        raws[field.name] = F.substring(line, start, field.width)
        start += field.width
    return raws


def _first_fault(value: Column, line: Column, layout: Layout) -> Column:
    """The first failing check of a line: encoding, characters, length, then the fields left to right."""
    fault = (
        F.when(~F.is_valid_utf8(value), F.lit("malformed_utf8"))
        .when(fx.has_forbidden(line), F.lit("forbidden_character"))
        .when(F.length(line) != layout.width, F.lit("record_length"))
    )
    raws = _raw_fields(line, layout)
    for field in layout.fields:
        if field.kind != "text":
            fault = fault.when(fx.field_is_bad(raws[field.name], field), F.lit(f"bad_{field.name}"))
    return fault


def parse_lines(lines: DataFrame, layout: Layout) -> DataFrame:
    """Typed columns plus ``reject_reason``; rejected lines have null fields.

    Every field is parsed once, next to a row id: Spark pushes no filter below a row id, so asking for the
    accepted lines does not parse them again. Here a line is only judged; ``rejects`` finds out what is wrong
    with a faulty one. In a layout without text fields a line of the right length whose fields all parse is
    ASCII and clean, so the character checks are not in its way, and of the normal form, which needs Python, only
    the signs matter that turn into ASCII.
    """
    others = [c for c in lines.columns if c != "value"]
    value, line = F.col("value"), F.col("line")
    lined = lines.select(*others, value, (fx.normalized(value) if layout.has_text else fx.ascii_normalized(value)).alias("line"))
    raws = _raw_fields(line, layout)
    parsed = lined.select(
        *others,
        "value",
        "line",
        F.monotonically_increasing_id().alias("row_id"),
        *[fx.field_value(raws[f.name], f).alias(f.name) for f in layout.fields],
        *[
            (raws[f.name] == " " * f.width).alias(f"{f.name}_absent")
            for f in layout.fields
            if f.kind == "optional_date"
        ],
    )
    sound = F.length(line) == layout.width
    if layout.has_text:
        sound &= F.is_valid_utf8(value) & ~fx.has_forbidden(line)
    for field in layout.fields:
        if field.kind == "optional_date":
            sound &= F.col(field.name).isNotNull() | F.col(f"{field.name}_absent")
        elif field.kind != "text":
            sound &= F.col(field.name).isNotNull()
    judged = parsed.withColumn("reject_reason", F.when(~F.coalesce(sound, F.lit(False)), F.lit(_UNRESOLVED)))
    fine = F.col("reject_reason").isNull()
    return judged.select(
        *others, "row_id", "value", "reject_reason", *[F.when(fine, F.col(c)).alias(c) for c in layout.columns]
    )


def accepted(parsed: DataFrame, layout: Layout) -> DataFrame:
    keep = [c for c in ("batch_date", "source_file", "source_line") if c in parsed.columns]
    fine = F.col("reject_reason").isNull()
    if "row_id" in parsed.columns:
        fine &= F.col("row_id") >= 0
    return parsed.where(fine).select(*keep, *layout.columns)


def rejects(parsed: DataFrame, layout: Layout) -> DataFrame:
    """Rejected lines with the reason of the first failing check. The search runs on these rows alone."""
    value, line, reason = F.col("value"), F.col("line"), F.col("reject_reason")
    bad = parsed.where(reason.isNotNull()).withColumn("line", fx.normalized(value))
    bad = bad.withColumn("reject_reason", F.when(reason == _UNRESOLVED, _first_fault(value, line, layout)).otherwise(reason))
    keep = [c for c in ("batch_date", "source_file", "source_line") if c in parsed.columns]
    return bad.select(
        F.lit(layout.record).alias("record"), *keep, F.make_valid_utf8("value").alias("value"), "reject_reason"
    )


class MalformedFile(ValueError):
    """A file opens with a byte order mark, which the text source would drop in silence."""


def scan(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    """All records of the files, without line numbers. Files must be sound: the job stops at a rejected line.

    The text is read once; a byte order mark is looked for in the first three bytes of each file. The check of a line
    stands above its row id, where the optimizer leaves it: below, parsing would be written once for every use of a
    field, and the generated method would be too long for the JVM to compile. To keep the sound lines of faulty files
    and learn what is wrong with the others, use ``scan_with_lineage``, ``accepted`` and ``rejects``.
    """
    lines = read_lines(spark, paths, positions=False)
    marked = files.opening_with(spark, lines.inputFiles(), BOM)
    if marked:
        raise MalformedFile(f"byte order mark in {marked[0]}")
    parsed = parse_lines(lines, layout)
    line = F.format_string("malformed %s line: %s", F.lit(layout.record), F.make_valid_utf8("value"))
    faulty = F.col("reject_reason").isNotNull() & (F.col("row_id") >= 0)
    sound = F.when(faulty, F.raise_error(line).cast("boolean")).otherwise(F.lit(True))
    return parsed.where(sound).select(*layout.columns)


def split_table(positioned: DataFrame) -> DataFrame:
    """One row per input split: its lines, the line before its first, and whether its file starts with a BOM.

    The text source drops a leading BOM silently. A clean file is as long as its lines with one LF each, or
    one byte less when the last LF is missing; a BOM makes it two or three bytes longer than that.
    """
    splits = positioned.groupBy("file_path", "split_start").agg(
        F.min("row_id").alias("first_row_id"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("octets") + 1).alias("octets"),
        F.max("file_size").alias("file_size"),
    )
    named = F.regexp_extract("file_path", DATED_FILE, 1)
    splits = splits.withColumn(
        "source_file",
        F.when(named != "", named).otherwise(F.element_at(F.split("file_path", "/"), -1)),
    )
    in_file = W.partitionBy("file_path")
    in_order = W.partitionBy("source_file").orderBy("file_path", "split_start")
    return splits.select(
        "file_path",
        "split_start",
        "source_file",
        fx.parsed_compact_date(F.regexp_extract("source_file", r"_([0-9]{8})\.dat\z", 1)).alias("batch_date"),
        "first_row_id",
        "lines",
        (F.sum("lines").over(in_order) - F.col("lines")).alias("lines_before"),
        (F.col("file_size") - F.sum("octets").over(in_file)).alias("spare_octets"),
        (F.row_number().over(in_order) == 1).alias("opens_file"),
    )


def number_lines(positioned: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Add batch_date, source_file and the 1-based source_line to rows that were written with their positions.

    ``positioned`` must be durable: row ids are only comparable within one execution of the scan. The split
    table is counted before it is broadcast, so the rows themselves are not shuffled; beyond the bound it is
    an ordinary join.
    """
    if splits is None:
        splits = durable(split_table(positioned), "splits")
    if splits.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    joined = positioned.join(splits, ["file_path", "split_start"])
    first_line = F.col("opens_file") & (F.col("row_id") == F.col("first_row_id"))
    with_bom = joined.withColumn("bom", first_line & (F.col("spare_octets") >= 2))
    hidden = {*_POSITION, "octets", "first_row_id", "lines", "lines_before", "spare_octets", "opens_file", "bom"}
    payload = [c for c in positioned.columns if c not in hidden]
    fields = [c for c in payload if c not in ("value", "reject_reason")]
    return with_bom.select(
        "batch_date",
        "source_file",
        (F.col("row_id") - F.col("first_row_id") + 1 + F.col("lines_before")).alias("source_line"),
        "value",
        F.when(F.col("bom"), F.lit("forbidden_character")).otherwise(F.col("reject_reason")).alias("reject_reason"),
        *[F.when(~F.col("bom"), F.col(c)).alias(c) for c in fields],
    )


def positioned_lines(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    """Parsed lines with their positions, to be written once. Only rejected lines keep their bytes."""
    rejected = F.col("reject_reason").isNotNull()
    return parse_lines(read_lines(spark, paths), layout).withColumn("value", F.when(rejected, F.col("value")))


def scan_with_lineage(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    """All lines, parsed once into the shared folder and numbered from there. The text is read a single time."""
    return number_lines(durable(positioned_lines(spark, paths, layout), f"{layout.record}-lines"))


def line_quality(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per dated file: lines, malformed lines, carriage returns, a leading BOM, a missing last LF."""
    value = F.col("value")
    per_part = (
        read_lines(spark, paths)
        .groupBy("file_path")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~F.is_valid_utf8(value)).alias("malformed_lines"),
            F.count_if(value.endswith("\r")).alias("crlf_lines"),
            (F.max("file_size") - F.sum(F.col("octets") + 1)).alias("spare_octets"),
        )
        .withColumn("source_file", F.regexp_extract("file_path", DATED_FILE, 1))
    )
    return per_part.groupBy("source_file").agg(
        F.sum("lines").alias("lines"),
        F.sum("malformed_lines").alias("malformed_lines"),
        F.sum("crlf_lines").alias("crlf_lines"),
        F.max(F.col("spare_octets") >= 2).alias("has_bom"),
        F.max((F.col("spare_octets") % 3) != 0).alias("lacks_last_lf"),
    )


def format_lines(records: DataFrame, layout: Layout, ascii_only: bool = False) -> DataFrame:
    """Records as lines of the layout. Overlong, negative or forbidden values stop the job."""
    keep = [c for c in ("batch_date", "source_file") if c in records.columns]
    parts = [fx.formatted_field(F.col(f.name), f, ascii_only) for f in layout.fields]
    return records.select(*keep, F.concat(*parts).alias("value"))


def write_dated_files(lines: DataFrame, root: str) -> None:
    """Write lines below ``root``, one directory of parts per ``source_file``; empty input writes nothing."""
    lines.select("source_file", "value").write.partitionBy("source_file").text(root)
