"""Large JSON arrays, read by many tasks.

A file that is one JSON array has no line per element, and whether a comma stands between
elements is only known from what precedes it.  Spark's text reader splits the file into
byte ranges all the same, with the closing brace as its line separator, so that ranges
begin just after a brace.

1. Each range of a file of several works out, without what precedes it, how it changes the
   state of a reader: whether a string is open, and how many arrays are.  For either case
   of the first, the second is ``max(arrays + d, m)``.  These functions are composed in the
   order of the ranges, a few numbers each.
2. Each range is read again, with the state it begins in, and cut at the commas outside
   strings that an opening brace follows while no array inside an element is open: in
   valid JSON such a comma stands between two elements, and no broken element hides it
   by braces that it lacks or has too many.
3. What stands before the first and after the last cut of a range is put together with its
   neighbours'.

A string ends with its line, as JSON strings hold no line breaks.  So a broken element costs
itself; one that leaves a string open costs what follows on its line, and one that leaves
an array of its own open what follows in its file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialise, with_package

_IN_STRING = r'(?:[^"\\\n]|\\[^\n]|\\(?=\n))*+("|\n|\Z)'
_REST_OF_STRING = re.compile(_IN_STRING)
_TOKEN = re.compile(rf'"{_IN_STRING}|[\[\]]|,(?=\s*\{{)')

#: Parts of a file: an element between two cuts, what precedes the first cut of a range, follows its
#: last one, or is a range without any; a file that is no array.
WHOLE, HEAD, TAIL, MIDDLE, NO_ARRAY = range(5)


def tokens(text: str, in_string: bool) -> Iterator[tuple[int, str]]:
    """Place and kind of the brackets and element commas outside strings; at last ``"`` if a string is open."""
    start = 0
    if in_string:
        rest = _REST_OF_STRING.match(text)
        start = rest.end()
        if not rest[1]:
            yield len(text), '"'
            return
    for found in _TOKEN.finditer(text, start):
        kind = found[0][0]
        if kind != '"':
            yield found.start(), kind
        elif not found[1]:
            yield len(text), '"'


class Change:
    """How text changes the state of a reader that begins it inside or outside a string."""

    def __init__(self, in_string: bool):
        self.in_string, self.d, self.m = in_string, 0, 0

    def add(self, text: str) -> None:
        opened = False
        for _, kind in tokens(text, self.in_string):
            if kind == "[":
                self.d, self.m = self.d + 1, self.m + 1
            elif kind == "]":
                # The array of the file stays open to its end.
                self.d, self.m = self.d - 1, max(self.m - 1, 1)
            elif kind == '"':
                opened = True
        self.in_string = opened


def _segments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    meta = ("file_path", "file_block_start", "file_block_length", "file_size")
    return spark.read.option("lineSep", "}").text(path).select("value", *(f"_metadata.{name}" for name in meta))


def _runs(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[int, int]]:
    """Stretches of rows that are equal in the columns."""
    differs = np.zeros(batch.num_rows + 1, bool)
    differs[[0, -1]] = True
    for name in columns:
        codes = batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        differs[1:-1] |= codes[1:] != codes[:-1]
    cuts = np.flatnonzero(differs).tolist()
    yield from zip(cuts[:-1], cuts[1:])


def _text(batch: pa.RecordBatch, i: int, j: int) -> str:
    return "".join(value + "}" for value in batch.column("value").slice(i, j - i).to_pylist())


_CHANGE = "file_path string, start long, no_array boolean, s0 boolean, d0 long, m0 long, s1 boolean, d1 long, m1 long"
_STATE = "path string, start long, in_string boolean, arrays long, no_array boolean"


def range_states(segments: DataFrame) -> DataFrame:
    """The state that each range but the first of a file begins in, where it is not the usual one.

    The usual one is outside strings, with the file's array open.  At most a row per range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, changes, no_array = None, None, None
        out = []
        for batch in batches:
            for i, j in _runs(batch, "file_path", "file_block_start"):
                key = batch.column("file_path")[i].as_py(), batch.column("file_block_start")[i].as_py()
                text = _text(batch, i, j)
                if key != known:
                    if known is not None:
                        out.append((*known, no_array, *(x for c in changes for x in (c.in_string, c.d, c.m))))
                    known, changes = key, (Change(False), Change(True))
                    no_array = key[1] == 0 and not text.lstrip().startswith("[")
                for change in changes:
                    change.add(text)
        if known is not None:
            out.append((*known, no_array, *(x for c in changes for x in (c.in_string, c.d, c.m))))
        names = [part.split(" ")[0] for part in _CHANGE.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema)

    schema = pa.schema(
        [("file_path", pa.string()), ("start", pa.int64()), ("no_array", pa.bool_())]
        + [(f"{c}{i}", kind) for i in (0, 1) for c, kind in (("s", pa.bool_()), ("d", pa.int64()), ("m", pa.int64()))]
    )

    def compose(key: tuple, table: pa.Table) -> pa.Table:
        in_string, arrays, no_array, out = False, 0, False, []
        for row in table.sort_by("start").to_pylist():
            if row["start"] > 0:
                out.append((row["file_path"], row["start"], in_string, arrays, no_array))
            no_array |= row["no_array"]
            case = int(in_string)
            in_string, arrays = row[f"s{case}"], max(arrays + row[f"d{case}"], row[f"m{case}"])
        unusual = [row for row in out if row[2] or row[3] != 1 or row[4]]
        kinds = [("path", pa.string()), ("start", pa.int64()), ("in_string", pa.bool_()), ("arrays", pa.int64()), ("no_array", pa.bool_())]
        return pa.Table.from_pylist([dict(zip([k for k, _ in kinds], row)) for row in unusual], pa.schema(kinds))

    several = segments.where("file_block_length < file_size")
    return several.mapInArrow(run, _CHANGE).groupBy("file_path").applyInArrow(compose, _STATE)


class _Range:
    """Cuts a range, batch by batch."""

    def __init__(self, in_string: bool, arrays: int, skipped: bool):
        self.in_string, self.arrays, self.skipped = in_string, arrays, skipped
        self.waiting: list[str] = []
        self.cuts = 0
        self.n_bytes = 0

    def add(self, text: str) -> list[tuple[int, str]]:
        """Parts that end in the text."""
        out, start, opened = [], 0, False
        for place, kind in tokens(text, self.in_string):
            if kind == "[":
                self.arrays += 1
            elif kind == "]":
                self.arrays = max(self.arrays - 1, 1)
            elif kind == '"':
                opened = True
            elif self.arrays <= 1:
                part = "".join((*self.waiting, text[start:place]))
                out.append((WHOLE if self.cuts else HEAD, part))
                self.waiting, self.cuts, start = [], self.cuts + 1, place + 1
        self.waiting.append(text[start:])
        self.in_string = opened
        return out

    def end(self) -> tuple[int, str]:
        return (TAIL if self.cuts else MIDDLE), "".join(self.waiting)


_PART = "path string, start long, size long, n_bytes long, kind int, text string"


def _parts(segments: DataFrame, states: DataFrame) -> DataFrame:
    """Elements and what is left of them at the ends of ranges."""
    names = [part.split(" ")[0] for part in _PART.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reader = None, None
        for batch in batches:
            out = []
            for i, j in _runs(batch, "file_path", "file_block_start"):
                path, start, size, in_string, arrays, no_array = (
                    batch.column(name)[i].as_py()
                    for name in ("file_path", "file_block_start", "file_size", "in_string", "arrays", "no_array")
                )
                text = _text(batch, i, j)
                if (path, start) != known:
                    if known is not None and not reader.skipped:
                        out.append((*known, reader.size, reader.n_bytes, *reader.end()))
                    known = (path, start)
                    first = start == 0
                    reader = _Range(bool(in_string), (0 if first else 1) if arrays is None else arrays, bool(no_array))
                    reader.size = size
                    if first and not text.lstrip().startswith("["):
                        reader.skipped = True
                        out.append((path, start, size, 0, NO_ARRAY, None))
                if not reader.skipped:
                    reader.n_bytes += len(text.encode())
                    out += [(path, start, size, 0, *part) for part in reader.add(text)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)], names)
        if known is not None and not reader.skipped:
            row = (*known, reader.size, reader.n_bytes, *reader.end())
            yield pa.RecordBatch.from_arrays([pa.array([value], k) for value, k in zip(row, kinds)], names)

    # At most a row of some hundred bytes per range of spark.sql.files.maxPartitionBytes, and none for usual ones.
    told = F.broadcast(states.withColumnRenamed("start", "at"))
    here = (F.col("file_path") == F.col("path")) & (F.col("file_block_start") == F.col("at"))
    return segments.join(told, here, "left").drop("path", "at").mapInArrow(run, _PART)


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A column ``element``: JSON text of one or more neighbouring elements, to be parsed between brackets.

    Elements that are objects stand alone; NULL stands for a file that is no array, and for the end that an
    array lacks.  Empty files have no elements.
    """
    with_package(spark)
    segments = _segments(spark, path)
    states = materialise(range_states(segments), "range-states")
    parts = materialise(_parts(segments, states), "array-parts")
    whole = parts.where(F.col("kind").isin(WHOLE, NO_ARRAY)).select(F.col("text").alias("element"))

    # A range has at most two ends: small rows, gathered per file.
    ends = parts.where(F.col("kind").isin(HEAD, TAIL, MIDDLE))
    in_order = Window.partitionBy("path").orderBy("start", "kind")
    numbered = ends.withColumn("part", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_order))
    joined = numbered.groupBy("path", "part").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("start", "kind", "text")))["text"], "").alias("text"),
        F.max("size").alias("size"),
        F.sum("n_bytes").alias("n_bytes"),
        F.max("start").alias("start"),
    )
    of_file = Window.partitionBy("path")
    ended = joined.select(
        "part",
        "text",
        (F.col("part") == F.max("part").over(of_file)).alias("last"),
        # Every segment got a brace; the last one had none where that makes the file too long (or it is packed).
        (F.sum("n_bytes").over(of_file) == F.col("size")).alias("braced"),
    )
    text = F.when(F.col("last") & ~F.col("braced"), F.expr("substr(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    text = F.when(F.col("part") == 0, F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    closed = F.col("text").rlike(r"\]\s*$")
    # The end that is missing has a row of its own.
    kept = F.when(F.col("last") & closed, F.array(F.regexp_replace("text", r"\]\s*$", "")))
    kept = kept.when(F.col("last"), F.array(F.col("text"), F.lit(None).cast("string"))).otherwise(F.array("text"))
    cut = ended.select("last", text.alias("text")).select(F.explode(kept).alias("element"))
    return whole.unionByName(cut)
