"""Coded events of arriving observation files, one per (subject, time, code)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortline import defaults as D
from cohortline.operators.events import event_rows

_STORE = "spark.sql.streaming.stateStore."
_STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
}


def _first(row_ids: Sequence[str], value: Column) -> Column:
    """The least row id, then the least value; nulls after all others, as in the batch run."""
    order = {**{c: F.col(c) for c in row_ids}, "numeric_value": value.cast("double")}
    return F.struct(*[f for n, c in order.items() for f in (c.isNull().alias(f"no_{n}"), c.alias(n))])


def _kinds(row_ids: Sequence[str], columns: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Code -> its first copy, for codes with names of their own, and column -> the set of its other codes.

    Values of a category have no number, so which copy is kept does not matter, except for a value whose code is also
    that of a measurement or an indicator.
    """
    named = {D.CODE_PREFIX[kind] + name: (F.col(c), F.col(c).isNotNull())
             for c, (kind, name) in D.MEASUREMENT_CODES.items() if c in columns}
    named |= {D.CODE_PREFIX[kind] + name: (F.lit(1.0), F.col(c) == 1)
              for c, (kind, name) in D.INDICATOR_CODES.items() if c in columns}
    category = {c: F.concat(F.lit(D.CODE_PREFIX[kind]), F.col(c).cast("string")) for c, kind in D.CATEGORY_KINDS.items() if c in columns}
    first = {}
    for code, (value, holds) in named.items():
        copies = [F.when(holds, _first(row_ids, value))]
        copies += [F.when(text == code, _first(row_ids, F.lit(None))) for c, text in category.items()
                   if code.startswith(D.CODE_PREFIX[D.CATEGORY_KINDS[c]])]
        first[code] = F.min(F.least(*copies) if len(copies) > 1 else copies[0])
    others = {c: F.collect_set(F.when(~text.isin(list(named)), text)) for c, text in category.items()}
    return first, others


def deduplicated(observations: DataFrame, delay: str = "1 day", row_id: str = D.EVENT_ID) -> DataFrame:
    """Events of a stream (or a table), the copy of the smallest ``row_id`` of each key.

    An event is given out when the watermark, the latest time seen less ``delay``, has
    reached its time, so copies may arrive in any order until then; the state holds one
    row per subject and time of the last ``delay``, with the first copy of each code, whatever the number of copies. Rows
    whose time is already behind the watermark are late and dropped, and events of the last ``delay``
    stay in the checkpoint until later rows arrive. Events without a time have no place on the
    watermark: they go out at once, each as it comes.
    """
    columns = observations.columns
    row_ids = [row_id] if row_id in columns else []
    if D.TIME not in columns:
        return event_rows(observations, row_ids).drop(*row_ids)
    subject = F.col(D.SUBJECT) if D.SUBJECT in columns else F.lit(D.UNKNOWN_SUBJECT)
    keyed = observations.where(F.col(D.TIME).isNotNull()).withColumns(
        {"_subject": subject, "_time": F.col(D.TIME), "_clock": F.col(D.TIME).cast("timestamp")}).withWatermark("_clock", delay)
    first, others = _kinds(row_ids, columns)
    slots = {code: f"_first{i}" for i, code in enumerate(first)}
    state = keyed.groupBy("_subject", "_time", "_clock").agg(
        *[first[code].alias(slot) for code, slot in slots.items()], *[codes.alias(f"_other_{c}") for c, codes in others.items()])
    event = lambda code, value: F.struct(code.alias("code"), value.cast("double").alias("numeric_value"))
    found = [F.array_compact(F.array(*[
        F.when(F.col(slot).isNotNull(), event(F.lit(code), F.col(slot)["numeric_value"])) for code, slot in slots.items()]))] if slots else []
    if others:
        codes = F.array_distinct(F.flatten(F.array(*[F.col(f"_other_{c}") for c in others])))
        found.append(F.transform(codes, lambda code: event(code, F.lit(None))))
    untimed = event_rows(observations.where(F.col(D.TIME).isNull()), row_ids).drop(*row_ids)
    if not found:
        return untimed
    kept = state.select(F.col("_subject").alias("subject_id"), F.col("_time").alias("timestamp"), F.inline(F.concat(*found)))
    return kept.unionByName(untimed)


def event_stream(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, delay: str = "1 day",
    row_id: str = D.EVENT_ID, files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Events of the Parquet files arriving in ``source``; ends when all present ones are done.

    Started again with the same checkpoint it goes on with the files that are new. The state lies in RocksDB, on the
    executors' disks and not in their memory, as a run may find files of many more rows than the memory holds.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A stream keeps the settings it was started with; those of the session stay as they were.
    before = {name: spark.conf.get(name, None) for name in _STATE}
    try:
        for name, value in _STATE.items():
            if before[name] is None:
                spark.conf.set(name, value)
        return _started(deduplicated(reader.parquet(source), delay, row_id), target, checkpoint)
    finally:
        for name in _STATE:
            if before[name] is None:
                spark.conf.unset(name)


def _started(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", target)
        .trigger(availableNow=True).start()
    )
