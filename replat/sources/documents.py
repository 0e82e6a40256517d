"""The elements of an array inside one JSON document, found by several tasks.

A document is read as splits of its bytes, each of which ends after a closing brace, and is gathered to chunks.
Whether a chunk starts inside a string, and how deep, is only known from all before it. So every chunk is scanned
for both cases at first, and reports what it does to either; running sums over these reports, one
narrow row for each chunk, say which case holds. With that known, each chunk is cut at the array's own commas, on its own.
No task looks at a whole document, and nothing is parsed before its borders are certain.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18

# tasks get these functions by value, so executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SIDE = "struct<delta:bigint,least:bigint,commas:map<bigint,bigint>,opens:array<struct<depth:bigint,least:bigint,commas:bigint>>>"
_PLACE = "file string, start bigint, no bigint"
_REPORT = f"{_PLACE}, quotes bigint, outside {_SIDE}, inside {_SIDE}"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): what stands between closing braces, in the order of each split of each file.

    Spark's text reader gives a separator's text to the split in which it begins, so every byte is in one row.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("bigint").alias("start"), "value"
    )


def text_lines(documents: DataFrame) -> DataFrame:
    """The same rows from a table of (file, text)."""
    parts = F.split("text", "[}]")
    return documents.select("file", F.lit(0).cast("bigint").alias("start"), F.explode(parts).alias("value"))


@dataclass
class Scan:
    """Structure of a chunk under one assumption about how it starts."""

    at: np.ndarray  # places of brackets and commas outside strings
    depth: np.ndarray  # depth after each of them, against the start
    comma: np.ndarray


def unescaped_quotes(raw: np.ndarray) -> np.ndarray:
    """1 at each quote that an even number of backslashes precedes."""
    places = np.arange(len(raw))
    plain = np.maximum.accumulate(np.where(raw != ord("\\"), places, -1))
    quotes = np.flatnonzero(raw == ord('"'))
    before = np.where(quotes > 0, plain[quotes - 1], -1) if len(quotes) else quotes
    out = np.zeros(len(raw), np.int64)
    out[quotes[(quotes - 1 - before) % 2 == 0]] = 1
    return out


def scanned(raw: np.ndarray, quotes: np.ndarray, inside: bool) -> Scan:
    free = (np.cumsum(quotes) + inside) % 2 == 0
    up, down, comma = np.isin(raw, [ord("{"), ord("[")]), np.isin(raw, [ord("}"), ord("]")]), raw == ord(",")
    at = np.flatnonzero((up | down | comma) & free)
    return Scan(at, np.cumsum(up[at].astype(np.int64) - down[at]), comma[at])


def openings(text: bytes, key: str) -> list[tuple[int, int]]:
    """(place of the key's first quote, place of the bracket) wherever the text has ``"key": [``."""
    found, name, at = [], f'"{key}"'.encode(), text.find(f'"{key}"'.encode())
    while at >= 0:
        rest = text[at + len(name) : at + len(name) + 4096].lstrip()
        if rest[:1] == b":" and rest[1:].lstrip()[:1] == b"[":
            found.append((at, text.index(b"[", at + len(name))))
        at = text.find(name, at + 1)
    return found


def report(scan: Scan, text: bytes, quotes: np.ndarray, inside: bool, key: str) -> dict:
    """What a chunk does to depth, and the places where the array could open."""
    opens = []
    for quote, bracket in openings(text, key):
        if (int(quotes[:quote].sum()) + inside) % 2 == 0:
            i = int(np.searchsorted(scan.at, bracket))
            depth = int(scan.depth[i])
            after = scan.depth[i:]
            low = np.flatnonzero(after < depth)
            end = i + int(low[0]) if len(low) else len(scan.at)
            commas = int((scan.comma[i:end] & (scan.depth[i:end] == depth)).sum())
            opens.append({"depth": depth, "least": int(after.min()), "commas": commas})
    levels, counts = np.unique(scan.depth[scan.comma], return_counts=True)
    return {
        "delta": int(scan.depth[-1]) if len(scan.at) else 0,
        "least": int(min(scan.depth.min(initial=0), 0)),
        "commas": list(zip(levels.tolist(), counts.tolist(), strict=True)),
        "opens": opens,
    }


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, int, int, str]]:
    """(file, start of the split, number in the split, text), each of ``size`` characters or a little more."""
    where, no, held, length = None, 0, [], 0
    for batch in batches:
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True):
            if (file, start) != where:
                if held:
                    yield *where, no, "".join(held)
                where, no, held, length = (file, start), 0, [], 0
            held.append(value + "}")
            length += len(value) + 1
            if length >= size:
                yield *where, no, "".join(held)
                no, held, length = no + 1, [], 0
    if held:
        yield *where, no, "".join(held)


def _reports(key: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    side = pa.struct([
        ("delta", pa.int64()), ("least", pa.int64()), ("commas", pa.map_(pa.int64(), pa.int64())),
        ("opens", pa.list_(pa.struct([("depth", pa.int64()), ("least", pa.int64()), ("commas", pa.int64())]))),
    ])
    schema = pa.schema([
        ("file", pa.string()), ("start", pa.int64()), ("no", pa.int64()), ("quotes", pa.int64()), ("outside", side), ("inside", side),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, no, text in chunks(batches, size):
            body = text.encode()
            raw = np.frombuffer(body, np.uint8)
            quotes = unescaped_quotes(raw)
            both = [report(scanned(raw, quotes, inside), body, quotes, inside, key) for inside in (False, True)]
            row = {"file": file, "start": start, "no": no, "quotes": int(quotes.sum()), "outside": both[0], "inside": both[1]}
            yield pa.RecordBatch.from_pylist([row], schema)

    return run


def _texts(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in chunk], ["file", "start", "no", "text"])

    return run


def starts(reports: DataFrame) -> DataFrame:
    """For each chunk: whether it starts inside a string, how deep, before, in or after the array, and at which element.

    Running sums over the reports of a document: one narrow row for each chunk.
    """
    earlier = Window.partitionBy("file").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c: Column, zero: int = 0) -> Column:
        return F.coalesce(F.sum(c).over(earlier), F.lit(zero))

    rows = reports.withColumn("in_string", so_far(F.col("quotes")) % 2 == 1)
    rows = rows.withColumn("side", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    rows = rows.withColumn("depth", so_far(F.col("side.delta")))
    # the bracket after the key stands one level below the document's own brace
    opening = F.get(F.filter("side.opens", lambda o: o["depth"] + F.col("depth") == 2), F.lit(0))
    rows = rows.withColumn("opening", opening)
    rows = rows.withColumn("opened", F.coalesce(F.max(F.col("opening").isNotNull()).over(earlier), F.lit(False)))
    low = F.when(F.col("opened"), F.col("side.least")).when(F.col("opening").isNotNull(), F.col("opening.least"))
    rows = rows.withColumn("low", low + F.col("depth"))
    rows = rows.withColumn("closed", F.coalesce(F.min("low").over(earlier) < 2, F.lit(False)))
    body = F.col("opened") & ~F.col("closed")
    own = F.coalesce(F.try_element_at("side.commas", 2 - F.col("depth")), F.lit(0))
    commas = F.when(body, own).when(~F.col("opened") & F.col("opening").isNotNull(), F.col("opening.commas")).otherwise(F.lit(0))
    rows = rows.withColumn("commas", commas)
    phase = F.when(~F.col("opened"), F.lit(0)).when(body, F.lit(1)).otherwise(F.lit(2))
    return rows.select("file", "start", "no", "in_string", "depth", phase.alias("phase"), so_far(F.col("commas")).alias("first"))


def cut(text: str, in_string: bool, depth: int, phase: int, first: int, key: str) -> Iterator[tuple[int, int, str]]:
    """(position, part, piece of that element) of a chunk. The document's own text outside the array has position
    -1: part 0 before the array, part 1 after it."""
    body = text.encode()
    raw = np.frombuffer(body, np.uint8)
    quotes = unescaped_quotes(raw)
    scan = scanned(raw, quotes, in_string)
    levels = scan.depth + depth
    begin, end = 0, 0
    if phase == 0:
        for quote, bracket in openings(body, key):
            if (int(quotes[:quote].sum()) + in_string) % 2 == 0 and levels[np.searchsorted(scan.at, bracket)] == 2:
                begin, phase = bracket + 1, 1
                yield -1, 0, body[:begin].decode()
                break
    if phase != 1:
        yield -1, phase // 2, text
        return
    here = scan.at >= begin
    close = scan.at[here & (levels < 2)]
    end = int(close[0]) if len(close) else len(body)
    borders = [begin - 1, *scan.at[here & scan.comma & (levels == 2) & (scan.at < end)].tolist(), end]
    for i, (a, b) in enumerate(zip(borders, borders[1:], strict=False)):
        yield first + i, 0, body[a + 1 : b].decode()
    if len(close):
        yield -1, 1, body[end:].decode()


def _pieces(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                found = list(cut(row["text"], row["in_string"], row["depth"], row["phase"], row["first"], key))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * n) for c in ("file", "start", "no")] + [pa.array(c) for c in zip(*found, strict=True)],
                    ["file", "start", "no", "pos", "part", "piece"],
                )

    return run


def elements(lines: DataFrame, key: str, size: int = CHUNK_BYTES) -> DataFrame:
    """(file, pos, text): the elements of the array under ``key`` of each document, numbered from 0.

    ``pos`` -1 has the document itself, with the array emptied. ``lines`` are rows as :func:`split_lines` gives
    them. A document without the array has no elements.
    """
    reports = lines.mapInArrow(_reports(key, size), _REPORT)
    texts = lines.mapInArrow(_texts(size), f"{_PLACE}, text string")
    known = texts.join(starts(reports), ["file", "start", "no"])
    pieces = known.mapInArrow(_pieces(key), f"{_PLACE}, pos bigint, part bigint, piece string")
    parts = F.sort_array(F.collect_list(F.struct("start", "no", "part", "piece")))
    whole = pieces.groupBy("file", "pos").agg(F.transform(parts, lambda p: p["piece"]).alias("pieces"))
    rows = whole.select("file", "pos", F.btrim(F.array_join("pieces", ""), F.lit(" \t\r\n")).alias("text"))
    return rows.filter(F.col("text") != "")
