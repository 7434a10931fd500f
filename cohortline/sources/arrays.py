"""Files that hold one JSON array, read by many tasks and written a line at a time.

Spark's text reader cuts a file into byte ranges at any separator; with ``}`` as
separator the pieces of a range are whole up to a closing brace. Whether a range
starts inside a string, and how deep in brackets, follows from the ranges before
it: one pass counts quotes and brackets of each range for both cases, running sums
over the ranges give every start, and the next pass cuts out the records. Only
records that cross a range's end are shuffled, as the fragments of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.session import durable

MAX_RANGES = 1_000_000      # of some 40 bytes each: what is broadcast, 128 TB at Spark's usual range

# Spark's own text formats end at milliseconds.
WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

_BEFORE_OBJECT = re.compile(r'(?:[^{"]|"(?:[^"\\]|\\.)*")*', re.S)
_RANGES = "file string, block bigint, toggles int, outside bigint, inside bigint, base int"
_RECORDS = "file string, block bigint, opens boolean, closes boolean, text string"


def _parts(piece: str) -> list[str]:
    """The piece and its closing brace cut at quotes that begin or end strings."""
    return (piece + "}").replace("\\\\", "").replace('\\"', "").split('"')


def _levels(parts: list[str]) -> int:
    text = "".join(parts)
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The columns row by row; the pieces of a range come in the order of the file."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(*columns)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether its quotes end in the other state, its change of depth from either
    state, and the depth around records if a file begins here: 1 in an array, 0 for a lone object."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("toggles", pa.int32()),
                        ("outside", pa.int64()), ("inside", pa.int64()), ("base", pa.int32())])

    def ranges() -> Iterator[tuple]:
        now, quotes, depth, base = None, 0, [0, 0], 0
        for file, block, piece in _by_block(batches):
            if (file, block) != now:
                if now is not None:
                    yield (*now, quotes & 1, *depth, base)
                now, quotes, depth = (file, block), 0, [0, 0]
                base = int(piece.lstrip("\ufeff \t\r\n").startswith("["))
            parts = _parts(piece)
            change = (_levels(parts[0::2]), _levels(parts[1::2]))
            depth[0] += change[quotes & 1]
            depth[1] += change[1 - (quotes & 1)]
            quotes += len(parts) - 1
        if now is not None:
            yield (*now, quotes & 1, *depth, base)

    return _batches(ranges(), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects of the array; those that began before the range or go on after it as fragments."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("opens", pa.bool_()),
                        ("closes", pa.bool_()), ("text", pa.string())])

    def records() -> Iterator[tuple]:
        now, held, opens, quotes, depth, base = None, [], True, 0, 0, 0
        for file, block, inside, level, around, piece in _by_block(batches):
            if (file, block) != now:
                if held:
                    yield (*now, opens, False, "".join(held))
                now, quotes, depth, base = (file, block), inside, level, around
                held, opens = [], depth <= base and not inside
            parts = _parts(piece)
            fresh = not held and opens
            depth += _levels(parts[(quotes & 1)::2])
            quotes += len(parts) - 1
            if fresh:
                piece, opens = piece[_BEFORE_OBJECT.match(piece).end():], True
                if not piece:
                    continue
            held.append(piece + "}")
            if depth <= base and not quotes & 1:
                yield (*now, opens, True, "".join(held))
                held, opens = [], True
        if held:
            yield (*now, opens, False, "".join(held))

    return _batches(records(), schema)


def array_records(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame | None:
    """Every object of the arrays, or the lone object of a file, as one text, or None above ``MAX_RANGES`` ranges.

    Elements that are no objects are left out. What is no JSON gives texts that do
    not parse. Empty files and empty arrays give no rows.
    """
    reader = spark.read.option("lineSep", "}")
    pieces = (reader.option("pathGlobFilter", glob) if glob else reader).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    ranges = durable(pieces.mapInArrow(_measure, _RANGES))
    if ranges.count() > MAX_RANGES:
        return None
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    starts = ranges.withColumn("quoted", (before("toggles") % 2).cast("int"))
    starts = starts.withColumn("change", F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside")))
    first = F.first("base").over(Window.partitionBy("file").orderBy("block"))
    starts = starts.select("file", "block", "quoted", before("change").alias("level"), first.alias("base"))
    placed = pieces.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "quoted", "level", "base", "value")
    found = placed.mapInArrow(_cut, _RECORDS)
    whole = found.where("opens AND closes").select("text")
    # Opening fragments follow the closing one of the same range.
    along = Window.partitionBy("file").orderBy("block", "opens").rowsBetween(Window.unboundedPreceding, 0)
    rest = found.where("NOT (opens AND closes)").withColumn("record", F.sum(F.col("opens").cast("int")).over(along))
    joined = rest.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("all"))
    return whole.unionByName(joined.select(F.array_join("all.text", "").alias("text")))


def scan_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None, mode: str = "PERMISSIVE",
) -> DataFrame | None:
    """Rows of JSON array files by the given schema, each file read by as many tasks as it has ranges.

    An object that cannot be parsed is a row of nulls; with DROPMALFORMED it is
    left out, with FAILFAST it ends the job.
    """
    texts = array_records(spark, path, glob)
    if texts is None:
        return None
    if mode.upper() == "FAILFAST":
        return texts.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    corrupt = "_unreadable"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    read = texts.select(F.from_json("text", wide, {"columnNameOfCorruptRecord": corrupt}).alias("r")).select("r.*")
    if mode.upper() == "DROPMALFORMED":
        read = read.where(F.col(corrupt).isNull())
    return read.drop(corrupt)


def write_array(df: DataFrame, path: str) -> None:
    """One JSON array per partition, a record per line; no partition is held in memory."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                out.append(mark + text)
                mark = ","
            if out:
                yield pa.RecordBatch.from_pydict({"value": out})
        yield pa.RecordBatch.from_pydict({"value": ["[]" if mark == "[" else "]"]})

    df.select(F.to_json(F.struct("*"), WHOLE_TIMES).alias("value")).mapInArrow(lines, "value string").write.mode("overwrite").text(path)
