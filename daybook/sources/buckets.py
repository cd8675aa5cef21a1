"""Tables laid out by hash bucket of their key, so that a batch meets the buckets it touches and moves no table.

A bucketed table is a directory of Parquet files that Spark's bucketed writer laid out by the hash of the key, sorted by
it. Declared to the session's catalog, a join on the key reads bucket beside bucket without an exchange, and a few keys
read only their buckets and, within these, the row groups that may hold them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import durable, local_rows
from daybook.sources import files

#: Keys that are sent to the scan as literals, which prune buckets; more are shuffled to the buckets.
FEW_KEYS = 256
#: Partitions declared to the catalog by one statement.
DECLARED_AT_ONCE = 200


def bucket_of(keys: list[str], n: int) -> Column:
    """The bucket of a row, by the hash Spark's bucketed tables use."""
    return F.pmod(F.hash(*keys), F.lit(n))


def write_bucketed(df: DataFrame, path: str, keys: list[str], n: int, by: tuple[str, ...] = ()) -> None:
    """Write ``df`` to a new directory in ``n`` buckets, sorted by key, below a directory for each value of ``by``."""
    name = f"daybook_write_{uuid.uuid4().hex}"
    writer = df.repartition(n, *keys).write.format("parquet").option("path", path).bucketBy(n, *keys).sortBy(*keys)
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: they are not below the warehouse


def _declared(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class BucketedTable:
    """A partitioned table of bucketed directories; only partitions that were declared belong to it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], n: int, by: tuple[str, ...]):
        self.spark, self.path, self.schema, self.keys, self.n, self.by = spark, path, schema, keys, n, by
        self.name = f"daybook_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        self.known: set[tuple] = set()
        columns = ", ".join(keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_declared(schema)}) USING parquet PARTITIONED BY ({', '.join(by)}) "
            f"CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {n} BUCKETS LOCATION '{path}'"
        )

    def declare(self, partitions: list[tuple]) -> None:
        """Make partitions (values of ``by``) part of the table. Those declared before cost nothing."""
        fresh = [p for p in partitions if p not in self.known]
        for begin in range(0, len(fresh), DECLARED_AT_ONCE):
            places = []
            for values in fresh[begin : begin + DECLARED_AT_ONCE]:
                named = list(zip(self.by, values, strict=True))
                spec = ", ".join(f"{k} = '{v}'" for k, v in named)
                places.append(f"PARTITION ({spec}) LOCATION '{self.path}/{'/'.join(f'{k}={v}' for k, v in named)}'")
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(places)}")
        self.known.update(fresh)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.schema.names)

    def append(self, df: DataFrame, partition: tuple) -> None:
        """Write rows as a partition of their own and declare it; ``df`` has no columns of ``by``."""
        folder = "/".join(f"{k}={v}" for k, v in zip(self.by, partition, strict=True))
        write_bucketed(df, f"{self.path}/{folder}", self.keys, self.n)
        self.declare([partition])


class BucketVersions:
    """A keyed table rewritten by bucket: a version is a manifest that names a directory for each bucket."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], n: int):
        self.spark, self.folder, self.schema, self.keys, self.n = spark, folder.rstrip("/"), schema, keys, n

    def parts(self, manifest: str | None) -> dict[int, str]:
        """The directory of each bucket of a version; none before the first."""
        return {int(b): p for b, p in json.loads(files.read_text(self.spark, manifest)).items()} if manifest else {}

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return local_rows(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*sorted(paths))

    def rows(self, manifest: str | None) -> DataFrame:
        return self._read(list(self.parts(manifest).values()))

    def write(self, before: str | None, name: str, changed: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> str:
        """Write the version ``name`` that follows ``before`` and return its manifest.

        Only buckets that hold a key of ``changed`` are read, put through ``merged`` and written; the manifest takes the
        others over by name. ``merged`` must return a row for every key of ``changed``, and no key of another bucket. A
        version of that name is replaced, so a writer that failed may start again.
        """
        parts, bucket = self.parts(before), bucket_of(self.keys, self.n)
        touched = [r["b"] for r in changed.select(bucket.alias("b")).distinct().collect()]  # at most the buckets
        folder = f"{self.folder}/{name}"
        if touched:
            rows = merged(self._read([parts[b] for b in touched if b in parts]))
            dealt = rows.withColumn("bucket", bucket).repartition("bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        parts |= {b: f"{folder}/bucket={b}" for b in touched}
        manifest = f"{folder}.json"
        files.delete(self.spark, manifest)
        files.create_file(self.spark, manifest, json.dumps(parts))
        return manifest


def matching(table: DataFrame, wanted: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Rows of ``table`` whose ``key`` is among ``wanted``. ``n`` says that the table has that many buckets of the key.

    The distinct keys are written and counted. A few become literals, so that other buckets are not opened; more are
    dealt to the same buckets as the table, which stays where it is. Files are sorted by key, so the least and greatest
    wanted key skip row groups: where keys grow with time, new ones meet little of the table. Without buckets Spark
    chooses.
    """
    keys = wanted.select(key).distinct()
    if n is None:
        return table.join(keys, key, "left_semi")
    keys = durable(keys, "wanted-keys")
    held = keys.agg(F.count("*").alias("n"), F.min(key).alias("least"), F.max(key).alias("most")).first()
    if held["n"] <= FEW_KEYS:
        return table.where(F.col(key).isin([r[key] for r in keys.collect()]))  # at most FEW_KEYS literals
    near = table.where(F.col(key).between(held["least"], held["most"]))
    return near.hint("merge").join(keys.repartition(n, key), key, "left_semi")
