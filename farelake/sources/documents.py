"""JSON arrays of any size and layout, read by many tasks each.

A file is read in byte ranges, as the text between closing braces. Whether a
range starts inside a string, and how deep, follows from the ranges before it:
quotes are counted first, then, knowing which braces are text, the depth. One
number of each per range is enough to tell where the elements in it start and end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tasks take these functions along, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranges whose states are held in memory, some hundred bytes each: a petabyte in ranges of 128 MB.
MOST_RANGES = 8_000_000

_SPACE = b" \t\r\n\xef\xbb\xbf"


def _ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text up to each closing brace, in order within its range of a file."""
    return spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Where brackets open (1) or close (-1) outside strings, and where in strings, and the state at the end.

    The data starts behind a closing brace or at the start of a file, so its
    first byte is not escaped.
    """
    places = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != 0x5C, places, -1))
    slashes = np.append(0, (places - plain)[:-1]) if len(data) else places
    quotes = (data == 0x22) & (slashes % 2 == 0)
    text = (np.cumsum(quotes) + inside) % 2 == 1
    opens = (data == 0x7B) | (data == 0x5B)
    closes = (data == 0x7D) | (data == 0x5D)
    steps = opens.astype(np.int64) - closes
    at_end = bool((int(quotes.sum()) + inside) % 2)
    return np.where(text, 0, steps), np.where(text, steps, 0), at_end


def _joined(values: list[str]) -> np.ndarray:
    """The texts, each with the brace that ends it, which the last one of a file may lack."""
    return np.frombuffer("".join(f"{v}}}" for v in values).encode(), np.uint8)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Ranges and neighbouring rows of theirs."""
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        values = batch.column("value").to_pylist()
        first = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (files[i], starts[i]) != (files[first], starts[first]):
                yield (files[first], starts[first]), values[first:i]
                first = i


def _summaries(ranges: DataFrame) -> DataFrame:
    """Per range: whether it has an odd number of quotes, the depth it adds if it starts outside
    or inside a string, and its first byte that is no white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for key, values in _runs(batches):
            odd, outside, inside, first = found.get(key, (False, 0, 0, None))
            data = _joined(values)
            a, b, flips = _structure(data, False)
            a, b = int(a.sum()), int(b.sum())
            if odd:
                a, b = b, a
            if first is None:
                first = data.tobytes().lstrip(_SPACE)[:1].decode("latin-1") or None
            found[key] = [odd != flips, outside + a, inside + b, first]
        rows = [(*key, *state) for key, state in found.items()]
        names = ["file", "start", "odd", "outside", "inside", "first"]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    return ranges.mapInArrow(
        run, "file string, start bigint, odd boolean, outside bigint, inside bigint, first string"
    )


def _states(summaries: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """Per range: whether it starts inside a string, its depth there, and the depth of the file's elements."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("start").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    quoted = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = summaries.withColumn("quoted", quoted)
    known = known.withColumn(
        "added", F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))
    )
    known = known.select(
        "file",
        "start",
        "quoted",
        F.coalesce(F.sum("added").over(before), F.lit(0)).alias("depth"),
        F.when(F.first("first", ignorenulls=True).over(whole) == "[", 1).otherwise(0).alias("level"),
        F.sum("added").over(whole).alias("left"),
        (F.sum(F.col("odd").cast("int")).over(whole) % 2 == 1).alias("open"),
    )
    rows = known.limit(MOST_RANGES + 1).collect()
    if len(rows) > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges; raise spark.sql.files.maxPartitionBytes")
    for r in rows:
        # The last text of a file may lack the brace that was put behind it.
        if r.open or r.left not in (0, -1):
            raise ValueError(f"{r.file} ends inside a string or before its brackets are closed")
    return {(r.file, r.start): (r.quoted, r.depth, r.level) for r in rows}


def json_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The objects of JSON arrays as text, in the column ``value``; a file that is one object gives that.

    However an array is laid out, and be it one line, its file is read by as
    many tasks as it has ranges of ``spark.sql.files.maxPartitionBytes``. Ranges
    are scanned once right away, for the state at the start of each; that
    state, some hundred bytes for each range, is what tasks are given. The
    result scans them twice more: for the elements inside a range, which are not
    shuffled, and for the pieces of those that reach across ranges, which are.

    Elements that are no objects are left out. A file that ends too early is an
    error; an empty one has no elements. Files and the size of ranges must stay
    as they are until the result is read, which is checked.
    """
    ranges = _ranges(spark, path)
    states = spark.sparkContext.broadcast(_states(_summaries(ranges)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "piece", "opens", "value"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        current, level, quoted, depth = None, 0, False, 0
        held: list[bytes] = []  # of an element that is not closed yet
        opened = True  # whether the element held starts in this range

        def left() -> list[tuple]:
            return [(*current, 1, opened, b"".join(held).decode())] if held else []

        for key, values in _runs(batches):
            if key != current:
                if current is not None:
                    yield rows(left())
                current, held = key, []
                if key not in states.value:
                    raise ValueError("files or ranges are not those of the first scan")
                quoted, depth, level = states.value[key]
                opened = depth <= level
            data = _joined(values)
            steps, _, quoted = _structure(data, quoted)
            depths = np.cumsum(steps) + depth
            starts = np.flatnonzero((steps > 0) & (depths == level + 1))
            ends = np.flatnonzero((steps < 0) & (depths == level)) + 1
            depth = int(depths[-1])
            raw, found = data.tobytes(), []
            if held or not opened:  # the first end closes what was not closed before
                if not len(ends):
                    held.append(raw)
                    continue
                held.append(raw[: ends[0]])
                found.append((*current, 0 if opened else 1, opened, b"".join(held).decode()))
                held, opened, ends = [], True, ends[1:]
            whole = min(len(starts), len(ends))
            found += [
                (*current, 0, True, raw[s:e].decode())
                for s, e in zip(starts[:whole].tolist(), ends[:whole].tolist(), strict=True)
                if data[s] == 0x7B
            ]
            if len(starts) > whole:
                held = [raw[starts[whole] :]]
            yield rows(found)
        if current is not None:
            yield rows(left())

    found = ranges.mapInArrow(
        run, "file string, start bigint, piece int, opens boolean, value string"
    )
    # A range has two pieces at most: what closes an element from before comes first.
    order = Window.partitionBy("file").orderBy("start", "opens")
    pieces = found.where("piece = 1").withColumn(
        "number", F.sum(F.col("opens").cast("int")).over(order)
    )
    part = F.struct("start", "opens", "value")
    stitched = pieces.groupBy("file", "number").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["value"]), "")
        .alias("value")
    )
    objects = stitched.where(F.startswith("value", F.lit("{")))
    return found.where("piece = 0").select("value").unionAll(objects.select("value"))


def read_json_arrays(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """The objects of JSON arrays as rows, each file read by many tasks; see ``json_elements``.

    Without a schema one more pass over the elements finds it.
    """
    elements = json_elements(spark, path)
    if schema is None:
        found = spark.read.options(**options).json(elements.rdd.map(lambda row: row.value))
        schema = found.schema
    parsed = elements.select(F.from_json("value", schema, dict(options)).alias("element"))
    return parsed.select("element.*")
