"""Header CSV files as records, split across tasks wherever they are long (SRC-9).

Records follow the rules of Python's csv module (excel dialect): a quote opens a field only at its start, doubled quotes are one, line
breaks inside quotes belong to the field, and records end at \\n, \\r or \\r\\n. Whether a line starts inside a quoted field depends on all lines
before it, so files are read in three steps. Lines are packed into chunks, in file order within each block of a file, and a chunk tells
what it does to the state "inside quotes" when entered outside and when entered inside. A prefix over the chunks of a file
composes these: after a chunk that always ends alike the state is known, and from there on only chunks that swap the two count.
Then each chunk is parsed on its own: lines that end a record of an earlier chunk, or begin one that a later chunk ends, go to the chunk
where the record began. No file is read by one task; a prefix handles a few flags per chunk.

Defined results: a byte-order mark is dropped; blank lines are no records; the first record of a file, even a blank line, is its header; of equal header names the last
counts; missing cells are null; cells beyond the header are kept in `surplus`; an unclosed last field ends with the file's last line, without its line break;
an empty file gives no rows; a field of more than FIELD_LIMIT characters is an error, as in the csv module. Files with lone \\r as line breaks can't be split.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborlight.session import ship, stored

#: Characters of a chunk, but for a longer single line.
CHUNK = 1 << 20
FIELD_LIMIT = 131_072
PLACE = ["_path", "_block", "_seq"]
_DELIMITER = re.compile("[,\r]")
_RECORDS = "_path string, _block long, _seq int, _late boolean, _idx long, _cells array<string>, _role string, _text string"


def quote_open_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind a line (without its line break), from whether one was before it."""
    at, start = 0, not inside
    if '"' not in line:
        return inside
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
            else:  # closed; what follows up to the delimiter is plain text
                inside, at = False, at + 1
        elif start:
            inside = line.startswith('"', at)
            at, start = at + inside, False
        else:
            found = _DELIMITER.search(line, at)
            if found is None:
                return False
            at, start = found.end(), True


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of lines (value, path, block): place, text, whether a quote is open behind it when entered outside and inside."""
    place, seq, lines, size, outside, inside = None, 0, [], 0, False, True

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"_path": [place[0]], "_block": pa.array([place[1]], pa.int64()), "_seq": pa.array([seq], pa.int32()), "_chunk": ["\n".join(lines)], "_from_outside": [outside], "_from_inside": [inside]})

    for batch in batches:
        for line, path, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if lines and ((path, block) != place or size > CHUNK):
                yield chunk()
                seq = seq + 1 if (path, block) == place else 0
                lines, size, outside, inside = [], 0, False, True
            place = (path, block)
            lines.append(line)
            size += len(line) + 1
            if '"' in line:
                outside, inside = (quote_open_after(line, s) for s in (outside, inside))
    if lines:
        yield chunk()


def _parse(text: str) -> list[list[str]]:
    return list(csv.reader(io.StringIO(text, newline="")))


def _rows(place: tuple, late: bool, parsed: list[list[str]]) -> list[tuple]:
    """Records of a place, numbered without blank lines; a blank line that begins a file is kept as number -1."""
    filled = [r for r in parsed if r]
    rows = [(*place, late, i, r, None, None) for i, r in enumerate(filled)]
    if parsed and not parsed[0] and place[1:] == (0, 0) and not late:
        rows.insert(0, (*place, late, -1, [], None, None))
    return rows


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of chunks (place, text, whether entered inside quotes), and the ends of records that reach across chunks."""
    for batch in batches:
        for path, block, seq, text, inside in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            place, lines, entered = (path, block, seq), text.split("\n"), inside
            first, last = (None if inside else 0), -1  # first line of a new record, last line that ends one
            for i, line in enumerate(lines):
                inside = quote_open_after(line, inside)
                if not inside:
                    last = i
                    first = i + 1 if first is None else first
            parts = []
            if entered and first is None:
                if len(text) > FIELD_LIMIT:
                    raise ValueError(f"field larger than {FIELD_LIMIT} characters in {path}")
                parts.append(("middle", lines))
            elif entered:
                parts.append(("head", lines[:first]))
            if first is not None:
                if last >= first:
                    yield _as_batch(rows) if (rows := _rows(place, False, _parse("\n".join(lines[first : last + 1]) + "\n"))) else _as_batch([(*place, False, -2, None, None, None)])
                if max(last + 1, first) < len(lines):
                    parts.append(("tail", lines[max(last + 1, first) :]))
            if parts:
                yield _as_batch([(*place, False, None, None, role, "\n".join(x)) for role, x in parts])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of texts that were put together from the chunks they reach across."""
    for batch in batches:
        for path, block, seq, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows := _rows((path, block, seq), True, _parse(text)):
                yield _as_batch(rows)


def _entered_inside(chunks: DataFrame) -> DataFrame:
    """Of each chunk whether it is entered inside quotes: the last constant chunk before it, and swaps since."""
    constant, swaps = F.col("_from_outside") == F.col("_from_inside"), F.col("_from_outside") & ~F.col("_from_inside")
    order = Window.partitionBy("_path").orderBy("_block", "_seq")
    counted = chunks.select(*PLACE, "_from_outside", constant.alias("_constant"), F.sum(swaps.cast("long")).over(order).alias("_swaps"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = F.last(F.when(F.col("_constant"), F.struct(F.col("_from_outside").alias("open"), F.col("_swaps").alias("at"))), ignorenulls=True).over(before)
    swapped = F.coalesce(F.max("_swaps").over(before), F.lit(0)) - F.coalesce(known["at"], F.lit(0))
    return counted.select(*PLACE, (F.coalesce(known["open"], F.lit(False)) != (swapped % 2 == 1)).alias("_inside"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the files: _path, _block, _seq, _late, _idx and cells, in that order within a file; the header is one of them."""
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    chunks = lines.mapInArrow(_chunks, "_path string, _block long, _seq int, _chunk string, _from_outside boolean, _from_inside boolean")
    states = stored(_entered_inside(chunks), "csv-states")  # a flag a chunk, whose size Spark then knows
    parsed = stored(chunks.join(states, PLACE).select(*PLACE, "_chunk", "_inside").mapInArrow(_records, _RECORDS), "csv-records")
    parts = parsed.filter("_role is not null")
    order = Window.partitionBy("_path").orderBy("_block", "_seq", "_role")  # head, middle, tail
    owned = parts.withColumn("_owner", F.sum((F.col("_role") == "tail").cast("long")).over(order))
    whole = owned.groupBy("_path", "_owner").agg(F.array_sort(F.collect_list(F.struct("_block", "_seq", "_role", "_text"))).alias("_parts"))  # two a chunk at most, of one record
    first = F.get("_parts", F.lit(0))
    texts = whole.select("_path", first["_block"].alias("_block"), first["_seq"].alias("_seq"), F.array_join(F.transform("_parts", lambda p: p["_text"]), "\n").alias("_text"))
    joined = stored(texts.mapInArrow(_joined, _RECORDS), "csv-joined")
    return parsed.filter("_role is null and _idx >= -1").unionByName(joined).select(*PLACE, "_late", "_idx", "_cells")


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of header CSV files: headers and cells (arrays), surplus (cells beyond the header), source_file and row_number, which counts from 2 on in each file."""
    rows = records(spark, path)
    head = rows.groupBy("_path").agg(F.min_by("_cells", F.struct("_block", "_seq", "_late", "_idx")).alias("_names"))
    own = F.array_distinct("_names")
    at = F.transform(own, lambda n: F.size("_names") - F.array_position(F.reverse("_names"), n).cast("int"))
    head = head.select("_path", "_names", own.alias("headers"), at.alias("_at"))
    counts = rows.filter("_idx >= 0").groupBy(*PLACE).agg(F.count_if(~F.col("_late")).alias("_early"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_path").orderBy("_block", "_seq").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    number = F.col("_before") + F.when(F.col("_late"), F.col("_early")).otherwise(0) + F.col("_idx") + F.when(F.size("_names") > 0, 1).otherwise(2)
    numbered = rows.filter("_idx >= 0").join(stored(counts, "csv-counts"), PLACE).join(stored(head, "csv-headers"), "_path").withColumn("row_number", number).filter("row_number > 1")
    size = F.size("_names")
    return numbered.select(
        "headers",
        F.transform("_at", lambda i: F.get("_cells", i)).alias("cells"),
        F.when(F.size("_cells") > size, F.slice("_cells", size + 1, F.size("_cells"))).alias("surplus"),
        F.url_decode(F.replace(F.element_at(F.split("_path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("source_file"),  # paths are percent-encoded
        "row_number",
    )
