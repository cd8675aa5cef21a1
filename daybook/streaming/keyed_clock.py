"""The business-date clock as keyed state: Spark's state store holds the active date and the records that wait for one.

Records are dealt to ``shards`` by topic and partition, and every control record to all of them, so each shard knows the
active date at any point of the arrival order without asking another. The state is Spark's (RocksDB), checkpointed with
the stream: a batch run again starts from the same state, and a stream started again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SHARDS = 8
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Before any day.
NONE = np.iinfo(np.int32).min


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; the setting is read when a stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class _Shard(StatefulProcessor):
    """Stamps the records of a shard. ``day`` counts days since 1970."""

    def __init__(self, schema: str, columns: list[str]):
        self.schema, self.columns = schema, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.active = handle.getValueState("active", "day int")
        self.waiting = handle.getListState("waiting", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        known = self.active.get()[0] if self.active.exists() else NONE
        control = arrived["control_day"].notna().to_numpy()
        given = np.where(control, arrived["control_day"].fillna(0).to_numpy() + 1, NONE).astype(np.int64)
        active = np.maximum.accumulate(np.concatenate([[known], given]))
        before, after = active[:-1], active[1:]
        if len(after) and after[-1] != known:
            self.active.update((int(after[-1]),))
        data = arrived[self.columns].assign(day=after, control=False)[~control]
        early = data["day"].to_numpy() == NONE
        moved = np.flatnonzero(control & (after > before))
        out = [data[~early]]
        if early.any():
            held = [tuple(r) for r in data.loc[early, self.columns].astype(object).itertuples(index=False)]
            self.waiting.appendList(held)
        if known == NONE and len(moved) and self.waiting.exists():
            held = pd.DataFrame(list(self.waiting.get()), columns=self.columns)
            out.append(held.assign(day=int(after[moved[0]]), control=False))
            self.waiting.clear()
        if key[0] == 0 and len(moved):  # one shard tells how the active date moved
            out.append(arrived[self.columns].assign(day=after, control=True).iloc[moved])
        yield pd.concat(out)

    def close(self) -> None:
        pass


def stamp_stream(stream: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The stream's records with ``batch_date``, and a row with ``control`` set for each control that moved the date.

    Records before the first control come out with the batch that brings it, on that control's date.
    """
    own = [c for c in stream.columns if c not in ("control_date",)]
    of_record = F.array(F.pmod(F.hash("topic", "part"), F.lit(shards)))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    dealt = stream.select(
        F.explode(F.when(F.col("control_date").isNull(), of_record).otherwise(every)).alias("shard"),
        *[F.unix_micros("ts").alias("ts") if c == "ts" else F.col(c) for c in own],
        F.unix_date("control_date").alias("control_day"),
    )
    plain = T.StructType([T.StructField(f.name, T.LongType() if f.name == "ts" else f.dataType) for f in stream.schema.fields if f.name in own])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.fields)
    out = T.StructType([*plain.fields, T.StructField("day", T.LongType()), T.StructField("control", T.BooleanType())])
    stamped = dealt.groupBy("shard").transformWithStateInPandas(_Shard(schema, own), out, outputMode="Append", timeMode="None")
    return stamped.select(
        *[F.timestamp_micros("ts").alias("ts") if c == "ts" else F.col(c) for c in own],
        F.date_from_unix_date(F.col("day").cast("int")).alias("batch_date"),
        "control",
    )
