"""Small pieces that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as the word rules name it: space and 0x09-0x0D.  ``bytes.split()`` cuts at exactly these.
BLANK_SIGN = re.compile(rb"[\x20\x09-\x0D]")


def raw_text(column: str = "text") -> Column:
    """The text as UTF-8 bytes, empty for null: Python then neither decodes nor fails on odd bytes."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary").alias("raw")


def clear_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias("text")


def text_key(column: str = "text") -> Column:
    """With the ident, tells rows of one ident apart by their text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def word_pieces(raw: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, from about ``size`` bytes at a time; at least one list."""
    at = 0
    while True:
        cut = BLANK_SIGN.search(raw, at + size)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        if end == len(raw):
            return
        at = end


def unused(taken: Iterable[str], stem: str) -> str:
    """``stem``, made longer until no name in ``taken`` is like it."""
    held = {c.lower() for c in taken}
    while stem.lower() in held:
        stem += "_"
    return stem


def per_row(
    df: DataFrame, inputs: list[Column], make: Callable[[], Callable], schema: str, keep: list[str] | None = None
) -> DataFrame:
    """A column of Python results per row, computed in Arrow batches.

    ``make()`` runs once per task and returns a function from the input values of one row to a tuple of results,
    named and typed by ``schema``.  Columns in ``keep`` are handed through unread.
    """
    keep = keep or []
    names = [unused(keep, f"_in{i}") for i in range(len(inputs))]
    source = df.select(*[F.col(f"`{c}`") for c in keep], *[c.alias(n) for c, n in zip(inputs, names, strict=True)])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    fields = arrow_fields(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            # One value at a time, so that a task holds a batch of texts once.
            values = [batch.column(len(keep) + i) for i in range(len(names))]
            rows = [work(*[v.as_py() for v in row]) for row in zip(*values, strict=True)]
            made = [pa.array(list(column), f.type) for column, f in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + made, names=keep + [f.name for f in fields]
            )

    return source.mapInArrow(run, ", ".join(x for x in (kept, schema) if x))


def arrow_fields(df: DataFrame, schema: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema))
