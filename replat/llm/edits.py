"""Documents as keys, and edits that go back to whole documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A null key stands before every other.
FIRST_KEY = -(2**63)
KEY = ["doc", "version"]


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, text``: the key, and a hash of the text, which tells rows of one key apart.

    Rows equal in both are one document to the operators; each of them gets that document's result.
    """
    return docs.select(*identity(F.col(key), F.col(text)), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def identity(key: Column, text: Column) -> list[Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [F.coalesce(key.cast("long"), F.lit(FIRST_KEY)).alias("doc"), F.xxhash64(whole).alias("version")]


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` as compressed bytes: for shuffles of whole texts, which are most of what moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else compress(t.encode()) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, pa.binary()))

    fields = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join(fields))


def unpacked(column: pa.Array) -> list[str | None]:
    expand = zstandard.ZstdDecompressor().decompress
    return [None if t is None else expand(t).decode() for t in column.to_pylist()]


def edited(
    docs: DataFrame,
    marks: DataFrame,
    edit: Callable[[str, list[int]], dict[str, Any]],
    schema: str,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row of ``docs`` as column ``row`` next to what ``edit(text, marks)`` makes of it.

    ``marks`` has ``doc, version, marks array<long>``, at most one row for each document; a document
    without one is edited with no marks. ``schema`` names the columns that ``edit`` returns.
    """
    columns = docs.columns
    rest = F.struct(*[c for c in columns if c != text])
    rows = packed(docs.select(*identity(F.col(key), F.col(text)), rest.alias("rest"), F.col(text).cast("string").alias("text")))
    joined = rows.join(marks, KEY, "left").select("rest", "text", "marks")
    kinds = {name: {"long": pa.int64(), "string": pa.string()}[kind] for name, kind in (x.split() for x in schema.split(", "))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = unpacked(batch.column("text")), batch.column("marks").to_pylist()
            made = [edit(t or "", m or []) for t, m in zip(texts, found, strict=True)]
            others = batch.column("rest")
            fields = [pa.array(texts, pa.string()) if c == text else others.field(c) for c in columns]
            row = pa.StructArray.from_arrays(fields, columns)
            yield pa.RecordBatch.from_arrays([row, *(pa.array([m[n] for m in made], kinds[n]) for n in kinds)], ["row", *kinds])

    row_type = docs.select(F.struct(*[F.col(c).cast("string").alias(c) if c == text else c for c in columns]).alias("row")).schema["row"].dataType
    return joined.mapInArrow(run, f"row {row_type.simpleString()}, {schema}")


def replaced(made: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of documents with their new text (``kept_text``) and its length, other columns as they were."""
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    picked = [new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in columns]
    return made.select(*picked)
