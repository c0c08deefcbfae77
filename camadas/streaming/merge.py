"""Merges as streams: landing files into keyed state, with and without keyed de-duplication before it.

The state's version rule decides what a row does, so rows may come late, twice or in any order: nothing is
dropped for its age, and no watermark is set, as Spark would drop what is behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from camadas.contracts import Entity
from camadas.entities import WATERMARK
from camadas.functions.extjson import decode
from camadas.functions.keys import digest
from camadas.operators import quality, upsert
from camadas.operators.dedup import first_per_key, newest_first
from camadas.sources import bronze
from camadas.sources.state import KeyedState
from camadas.sources.tables import exists
from camadas.streaming.ingest import landing_stream

HASH = "_hash"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
FIRST_VERSION = -(1 << 62)


def state_of(spark: SparkSession, path: str, entity: Entity, buckets: int = 64) -> KeyedState:
    """The curated rows of an entity with the hash that tells equal versions apart."""
    fields = [T.StructField(f.name, T._parse_datatype_string(f.type)) for f in entity.fields]
    return KeyedState(spark, path, entity.key, T.StructType([*fields, T.StructField(HASH, T.StringType())]), buckets)


def valid_rows(lines: DataFrame, entity: Entity) -> DataFrame:
    """Decoded rows that pass the field rules, with their hash and the file they came in."""
    decoded = decode(lines.select("raw_document", bronze.SOURCE_FILE), entity)
    rows = decoded.filter(quality.is_valid(entity)).drop("raw_document")
    return rows.withColumn(HASH, digest(c for c in entity.columns if c != WATERMARK))


class MergeSink:
    """A ``foreachBatch`` function that merges each batch into the state once.

    A finished batch leaves its counts under ``applied/stream=<name>/batch=<id>``. A batch that comes again
    with its id, as after a crash between the merge and the stream's own commit, is passed over; one that
    died within its merge is merged again, which changes only what is still missing.
    """

    def __init__(self, state: KeyedState, entity: Entity, stream: str):
        self.state, self.entity, self.stream = state, entity, stream

    def marker(self, batch_id: int) -> str:
        return f"{self.state.path}-applied/stream={self.stream}/batch={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, f"{self.marker(batch_id)}/_DONE"):
            return
        newest = first_per_key(batch, [self.entity.key], newest_first(WATERMARK, bronze.SOURCE_FILE, HASH))
        counts = upsert.merge_into(self.state, newest, WATERMARK, HASH)
        row = spark.createDataFrame([counts])
        row.coalesce(1).write.mode("overwrite").json(f"{self.marker(batch_id)}/_DONE")

    def applied(self, spark: SparkSession) -> DataFrame:
        """One row of counts per finished batch."""
        return spark.read.json(f"{self.state.path}-applied/stream={self.stream}/batch=*/_DONE")


def merge_available(
    spark: SparkSession, folder: str, sink: MergeSink, checkpoint: str, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge every landing file not seen before, then stop."""
    rows = valid_rows(landing_stream(spark, folder, files_per_batch), sink.entity)
    return (
        rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def unseen_versions(rows: DataFrame, entity: Entity, expiry_minutes: int = 60, groups: int = 256) -> DataFrame:
    """Rows that are news for their key: a first, a newer, or an equal version with other content.

    Per key the newest version and its hash are kept until the key has been silent for ``expiry_minutes`` of
    processing time; the state is bounded by the keys of that time. A key that comes back after its expiry
    passes again, and so does whatever its row is older than: the merge behind settles it. Rows are compared,
    never dropped for their age, so a backlog of any age gives every key.

    Keys are dealt by hash into ``groups``, whose keys are compared together and share one value of the state:
    a call for every key costs far more than its comparison. A checkpoint keeps the number it began with.
    """
    schema, key, file, content, expiry = rows.schema, entity.key, bronze.SOURCE_FILE, HASH, expiry_minutes * 60_000
    names = schema.names
    named = rows.withColumn("_version", F.coalesce(F.unix_micros(WATERMARK), F.lit(FIRST_VERSION))).withColumn(
        "_group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))

    def news(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        seen = pd.DataFrame({key: [], "version": [], "hash": [], "at": []})
        if state.exists:
            with pa.ipc.open_stream(state.get[0]) as stored:
                seen = stored.read_pandas()
            seen = seen[seen["at"] > now - expiry]
        came = pd.concat(list(frames)).sort_values(["_version", file, content])
        best = came.drop_duplicates(key, keep="last")
        place = pd.Index(seen[key]).get_indexer(best[key]) if len(seen) else np.full(len(best), -1)
        new, at = place < 0, place[place >= 0]
        version, now_held = best["_version"].to_numpy()[~new], best[content].to_numpy()[~new]
        before, held = seen["version"].to_numpy()[at], seen["hash"].to_numpy()[at]
        new[~new] = (version > before) | ((version == before) & (now_held != held))
        if new.any():
            yield best.loc[new, names]
        heard = seen.assign(at=seen["at"].where(~seen[key].isin(best[key]), now))
        latest = best.loc[new, [key, "_version", content]].set_axis([key, "version", "hash"], axis=1).assign(at=now)
        heard = heard[~heard[key].isin(latest[key])]
        kept = pa.Table.from_pandas(pd.concat([heard, latest]) if len(heard) else latest, preserve_index=False)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stored:
            stored.write_table(kept)
        state.update((out.getvalue().to_pybytes(),))
        state.setTimeoutDuration(expiry)

    return named.groupBy("_group").applyInPandasWithState(
        news, schema, "seen binary", "append", GroupStateTimeout.ProcessingTimeTimeout)


def merge_unseen(
    spark: SparkSession, folder: str, sink: MergeSink, checkpoint: str, expiry_minutes: int = 60,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """As ``merge_available``, with repeated rows taken out before they reach the merge.

    Expired keys are cleared by the next batch with data. Batches without data are switched off for this
    query: Spark would run them without end, since a timeout may always be due.
    """
    rows = valid_rows(landing_stream(spark, folder, files_per_batch), sink.entity)
    writer = (
        unseen_versions(rows, sink.entity, expiry_minutes).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    )
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(EMPTY_BATCHES, before)
