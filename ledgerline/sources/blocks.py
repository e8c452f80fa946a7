"""Files read by byte ranges: a quoted CSV scan that many tasks share, although line ends may stand inside quotes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .tables import text_schema

QUOTE, LINE_END = 34, 10
BLOCK_BYTES = 16 * 1024 * 1024
#: Bytes read at a time past a block's end, until its last record is complete.
TAIL_BYTES = 64 * 1024


def opened(path: str):
    """A file by the full path that Spark lists, for reading at any position inside a task."""
    local = re.fullmatch(r"file:(?://)?(/.*)", path, re.DOTALL)
    if local:
        return fs.LocalFileSystem().open_input_file(local.group(1))
    system, place = fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]://", "s3://", path), safe="/:@"))
    return system.open_input_file(place)


def listed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, length`` of the files below the paths that aren't empty; Spark lists them, no content is read."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def csv_blocks(files: DataFrame, block_bytes: int) -> DataFrame:
    """``path, start, stop, quoted``: byte ranges of the files, and whether a quoted field is open where each starts.

    Quotes are counted per block in a first pass; a running sum over one file's blocks gives the parity.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))
    cut = files.select("path", "length", F.explode(starts).alias("start"))
    cut = cut.select("path", "start", F.least(F.col("start") + block_bytes, F.col("length")).alias("stop"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for row in batch.to_pylist():
                with opened(row["path"]) as file:
                    quotes.append(file.read_at(row["stop"] - row["start"], row["start"]).count(b'"'))
            yield batch.append_column("quotes", pa.array(quotes, pa.int64()))

    counted = spread(cut).mapInArrow(count, "path string, start long, stop long, quotes long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    # One row per block: some 60,000 for a terabyte.
    return stored(counted.select("path", "start", "stop", quoted.alias("quoted")), "csv-blocks")


def spread(blocks: DataFrame) -> DataFrame:
    """Blocks dealt out by a hash of their place, the same way on a retry, one each to about as many partitions."""
    return blocks.repartition(max(1, blocks.count()), "path", "start")


def true_line_ends(data: bytes, quoted: bool) -> np.ndarray:
    """Positions of line ends outside quotes, for bytes that start inside a quoted field or not."""
    letters = np.frombuffer(data, np.uint8)
    # Running parity; a count modulo 256 keeps it.
    inside = (np.cumsum(letters == QUOTE, dtype=np.uint8) + np.uint8(quoted)) & 1
    return np.flatnonzero((letters == LINE_END) & (inside == 0))


def block_records(file, start: int, stop: int, quoted: bool) -> bytes:
    """The whole records whose first byte lies in the block; a record starts at byte 0 and after every true line end."""
    data = file.read_at(stop - start, start)
    ends = true_line_ends(data, quoted)
    first = 0
    if start > 0:
        follows = not quoted and file.read_at(1, start - 1) == b"\n"
        if not follows and not len(ends):
            return b""
        first = 0 if follows else int(ends[0]) + 1
    if first >= len(data):
        return b""
    if len(ends) and ends[-1] == len(data) - 1:
        return data[first:]
    pieces, place = [data[first:]], stop
    open_ = quoted ^ (data.count(b'"') % 2 == 1)
    while piece := file.read_at(TAIL_BYTES, place):
        ends = true_line_ends(piece, open_)
        if len(ends):
            pieces.append(piece[: int(ends[0]) + 1])
            break
        pieces.append(piece)
        open_, place = open_ ^ (piece.count(b'"') % 2 == 1), place + len(piece)
    return b"".join(pieces)


def parsed(data: bytes, width: int, sep: str) -> tuple[pa.Table, dict[int, list[str]]]:
    """Records of the right width as text columns, and the others' text by their width."""
    odd: dict[int, list[str]] = {}

    def keep(row) -> str:
        odd.setdefault(row.actual_columns, []).append(row.text)
        return "skip"

    names = [f"c{i}" for i in range(width)]
    table = csv.read_csv(
        pa.BufferReader(data),
        csv.ReadOptions(use_threads=False, block_size=len(data) + 1, column_names=names),
        csv.ParseOptions(delimiter=sep, newlines_in_values=True, invalid_row_handler=keep),
        # A bare empty field is NULL and a quoted one is ''.
        csv.ConvertOptions(column_types={n: pa.string() for n in names}, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False),
    )
    return table, odd


def text_rows(data: bytes, width: int, sep: str, header: bool) -> Iterator[pa.RecordBatch]:
    """All records as batches of ``width`` text columns: short ones filled up with NULL, long ones cut."""
    data = data.decode("utf-8", "replace").encode()
    if header and not len(true_line_ends(data, False)):
        return
    if header:
        data = data[int(true_line_ends(data, False)[0]) + 1 :]
    if not data.strip(b"\r\n"):
        return
    table, odd = parsed(data, width, sep)
    yield from table.to_batches()
    for n, lines in odd.items():
        other, _ = parsed("\n".join(line.rstrip("\r\n") for line in lines).encode(), n, sep)
        columns = [other.column(i) if i < n else pa.nulls(len(other), pa.string()) for i in range(width)]
        yield from pa.table(columns, names=[f"c{i}" for i in range(width)]).to_batches()


def read_quoted_csv(spark: SparkSession, paths: str | list[str], columns: list[str], sep: str = ",", header: bool = True,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All-text scan of quoted CSV files in blocks; no value is typed, trimmed or dropped.

    Quotes stand around whole fields and are doubled inside, as CSV writers do it; then an odd number of quotes before a
    byte means that it lies in a quoted field.  For files with stray quotes there is ``files.read_text_csv``, one task a file.
    Files are not compressed.  Empty lines are skipped; a file without records gives no rows.
    """
    blocks = csv_blocks(listed_files(spark, paths), block_bytes)
    schema, width = text_schema(columns), len(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["path"]) as file:
                    data = block_records(file, row["start"], row["stop"], row["quoted"])
                if data:
                    for out in text_rows(data, width, sep, header and row["start"] == 0):
                        yield out.rename_columns(columns)

    return spread(blocks).mapInArrow(work, schema)
