"""What the operators share: tables, whole-text annotation in Arrow batches, the labelled split, UTF-8 word rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import durable

__all__ = ["SPACE", "WORD", "annotate", "durable", "held_out", "n_words", "read"]

#: Words are what stands between ASCII white space; ``bytes.split()`` in Python cuts at the same six characters.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handed to a function at once, beyond which a batch is cut between rows.
PIECE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept from learning: ``crc32`` of its key as text, modulo ``folds``. A null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def pieces(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.Array, list]]:
    """Rows of a batch with their texts, in slices of at most ``PIECE_BYTES`` of text, or one row."""
    rows = batch.column(0)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    begin = size = 0
    for i, length in enumerate(lengths):
        if i > begin and size + length > PIECE_BYTES:
            yield rows.slice(begin, i - begin), texts.slice(begin, i - begin).to_pylist()
            begin, size = i, 0
        size += length
    if begin < batch.num_rows:
        yield rows.slice(begin), texts.slice(begin).to_pylist()


def annotate(
    docs: DataFrame, keep: list[str], text: str, outputs: T.StructType, make: Callable[[], Callable[[list], list]]
) -> DataFrame:
    """The ``keep`` columns of ``docs`` as a struct ``row``, beside columns computed from each whole text.

    ``make()`` runs once in each task and returns a function from a list of texts (null as None) to one Arrow
    array for each field of ``outputs``. Rows are neither shuffled nor dropped.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), *outputs.fields])
    within = keep.index(text) if text in keep else None  # a text that is kept is sent once
    packed = packed if within is None else packed.select("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            texts = batch.column(1) if within is None else batch.column(0).field(within)
            for rows, piece in pieces(batch, texts):
                yield pa.RecordBatch.from_arrays([rows, *function(piece)], names=["row", *outputs.names])

    return packed.mapInArrow(run, schema)
