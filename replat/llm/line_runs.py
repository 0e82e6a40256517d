"""Line dedup over ranks of line ids, built by distributed prefix doubling (operator 7)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replat.llm.common import new_task, slices, staged
from replat.llm.edits import KEY, edited, keyed

WORD = re.compile("[^\x20\x09-\x0d]")
#: What counts as a word: in scripts without spaces, and in other long strings, every 12 characters started.
PIECE = re.compile("[^\x20\x09-\x0d]{1,12}")


def least_windows(weights: list[int], least: int) -> tuple[list[list[int]], list[int]]:
    """Lengths of the windows to look at from each line on, and the longest window that each line is in.

    These are, for each line, the shortest window from it on and the shortest one up to it that weigh ``least``.
    Any window of that weight is made up of them: a line in it with enough weight up to its end is in the
    shortest window from that line on, and any other is in the shortest one up to its end.
    """
    n = len(weights)
    sums = [0]
    for w in weights:
        sums.append(sums[-1] + w)
    lengths: list[list[int]] = [[] for _ in weights]
    longest = [0] * n
    spans = set()
    end = start = 0
    for i in range(n):
        while end < n and sums[end] - sums[i] < least:
            end += 1
        if sums[end] - sums[i] >= least:
            spans.add((i, end))
        while sums[i + 1] - sums[start + 1] >= least:
            start += 1
        if sums[i + 1] - sums[start] >= least:
            spans.add((start, i + 1))
    for first, last in sorted(spans):
        lengths[first].append(last - first)
        for i in range(first, last):
            longest[i] = max(longest[i], last - first)
    return lengths, longest


def line_ids(docs: DataFrame, least: int, by_words: bool, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, at, id, lengths, longest``: the lines that hold a word, numbered in each document; 128-bit ids.

    ``lengths`` and ``longest`` are those of ``least_windows``; a line weighs its words, or else 1.
    """
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32())
    names = [*KEY, "at", "id", "lengths", "longest"]

    def weight(line: str) -> int:
        return sum(1 for _ in islice(PIECE.finditer(line), least)) if by_words else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_task("line_runs")
        for batch in slices(batches, 500):
            rows = []
            for doc, version, whole in zip(*(batch.column(c).to_pylist() for c in (*KEY, "text")), strict=True):
                lines = [x for x in whole.split("\n") if WORD.search(x)]
                lengths, longest = least_windows([weight(x) for x in lines], least)
                rows += [(doc, version, i, hashlib.md5(x.encode()).digest(), lengths[i], longest[i]) for i, x in enumerate(lines)]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return keyed(docs, key, text).mapInArrow(run, "doc long, version long, at long, id binary, lengths array<int>, longest int")


def ranked(classes: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``rank``, growing with ``by``: sorted over range partitions, numbered within each.

    The numbers have gaps, but they are unique and in order, and no row passes through one task.
    """
    ordered = classes.repartitionByRange(*by).sortWithinPartitions(*by)
    return staged(ordered.withColumn("rank", F.monotonically_increasing_id()))


def shared(places: DataFrame, by: list[str]) -> DataFrame:
    """Places whose ``by`` occurs at other places too, with its rank.

    Classes are counted before the shuffle; a class with a third of all places is one row there. Putting
    the rank back is a join that Spark splits where one class has many places.
    """
    classes = places.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return staged(places.join(ranked(classes, by), by).drop(*by))


def copies(windows: DataFrame, by: list[str]) -> DataFrame:
    """``doc, version, at, length`` of the windows with an equal one (in ``by``) earlier that ends before them.

    Classes are written first, and the copies too, so that Spark can split the join where a class is large.
    """
    first = F.min(F.struct(*KEY, "at")).alias("first")
    classes = staged(windows.groupBy(*by).agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    other = (F.col("first.doc") != F.col("doc")) | (F.col("first.version") != F.col("version"))
    found = windows.join(classes, by).filter(other | (F.col("at") - F.col("first.at") >= F.col("length")))
    return staged(found.select(*KEY, "at", "length"))


def repeated_lines(docs: DataFrame, least: int, by_words: bool, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, marks``: the lines (counted among lines with a word) in copies that weigh ``least`` or more.

    Doubling: the rank of 2h lines from a place is that of the pair (rank of h lines there, rank of h lines
    h lines on). Places whose rank is their own are left out of the next round, as nothing longer can repeat
    there, and so are lines whose windows are all shorter. A window of h to 2h - 1 lines is known by the ranks
    of its first and its last h lines. No window to look at has more than ``least`` lines, as every line weighs
    1 or more; a longer repeat, however long, is made up of such windows. So no rank of more lines is made.
    """
    places = shared(staged(line_ids(docs, least, by_words, key, text)), ["id"])
    have, found = 1, []
    while True:
        windows = places.select(*KEY, "at", F.explode("lengths").alias("length"), F.col("rank").alias("here"))
        windows = windows.filter(F.col("length").between(have, 2 * have - 1))
        if have == 1:
            found.append(copies(windows, ["here"]))
        else:
            last = places.select(*KEY, F.col("at").alias("tail"), F.col("rank").alias("next"))
            windows = windows.withColumn("tail", F.col("at") + F.col("length") - have)
            found.append(copies(staged(windows.join(last, [*KEY, "tail"])), ["length", "here", "next"]))
        if 2 * have > least:
            break
        longer = places.filter(F.col("longest") >= 2 * have)
        ahead = longer.select(*KEY, (F.col("at") - have).alias("at"), F.col("rank").alias("next"))
        pairs = staged(longer.withColumnRenamed("rank", "here").join(ahead, [*KEY, "at"]))
        have *= 2
        places = shared(pairs, ["here", "next"])
    marks = found[0]
    for more in found[1:]:
        marks = marks.union(more)
    # rows equal in key and text hold equal places
    lines = marks.select(*KEY, F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("line"))
    return lines.groupBy(*KEY).agg(F.sort_array(F.collect_set("line")).alias("marks"))


def without_lines(text: str, marked: list[int]) -> dict[str, Any]:
    """The text without these lines (counted among lines with a word)."""
    lines = text.split("\n")
    gone = set(marked)
    kept, removed, runs, at, before = [], 0, 0, 0, False
    for line in lines:
        if WORD.search(line):
            out = at in gone
            at += 1
            removed += out
            runs += out and not before
            before = out
            if out:
                continue
        kept.append(line)
    kept_text = "\n".join(kept) if removed else text
    digest = hashlib.sha256(kept_text.encode()).hexdigest()
    return {"n_lines": at, "n_removed": removed, "n_runs": runs, "kept_text": kept_text, "kept_sha256": digest}


def line_dedup(docs: DataFrame, min_lines: int | None = None, key: str = "doc_id", text: str = "text", min_words: int = 3) -> DataFrame:
    """``row`` (all columns of the input), ``n_lines``, ``n_removed``, ``n_runs``, ``kept_text``, ``kept_sha256``.

    A run of consecutive lines, one or more, that holds at least ``min_words`` words is a copy if an equal one
    starts earlier, in order of key, version and line, without overlapping it; all lines of copies go. With
    ``min_lines``, runs of that many lines count instead, whatever they hold. Lines without a word are not
    counted and stay. Null and empty texts have no lines. A null key comes first; repeated rows are one document.
    """
    marks = repeated_lines(docs, min_lines or min_words, min_lines is None, key, text)
    columns = "n_lines long, n_removed long, n_runs long, kept_text string, kept_sha256 string"
    return edited(docs, marks, without_lines, columns, key, text)
