"""Suffix-array dedup of byte strings, sorted by comparing hashes (operator 6)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replat.llm.common import new_task, once, partitions, slices, staged
from replat.llm.edits import KEY, edited, keyed, packed, unpacked
from replat.llm.shared_tokens import SENT, bucket_of, in_other_content, mix, sent

#: Bytes of the strings that mark a place within a longer repeat.
GRAM = 16
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Its inverse modulo 2 ** 64.
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))
BYTES_AT_ONCE = 500_000
#: Columns of a bucket of surroundings with their kinds; each travels as one compressed array.
ARRAYS = {"docs": "<i8", "counts": "<u4", "versions": "<i8", "firsts": "<i8", "sizes": "<u2", "shifts": "<u2", "content": "<u1", "sure": "<i8"}
SNIPPETS = "bucket int, " + ", ".join(f"{name} binary" for name in ARRAYS)
RANGES = "doc long, version long, ranges array<long>"


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def leading_powers(base: np.uint64, n: int) -> np.ndarray:
    """``powers``, kept by the worker as far as a block of texts usually reaches."""
    if n > 2 * BYTES_AT_ONCE:
        return powers(base, n)
    return once(f"suffix_dedup.powers.{base}", lambda: powers(base, 2 * BYTES_AT_ONCE))[:n]


class Prefixes:
    """Prefix polynomial hashes of a byte array: the hash of any piece, and common extensions."""

    def __init__(self, content: np.ndarray):
        with np.errstate(over="ignore"):
            sums = np.multiply(content.astype(np.uint64) + np.uint64(1), leading_powers(BASE, len(content)))
            self.sums = np.append(np.uint64(0), np.add.accumulate(sums))
            self.shift = leading_powers(UNBASE, len(content) + 1)

    def every(self, length: int) -> np.ndarray:
        """``pieces`` at all places."""
        with np.errstate(over="ignore"):
            return (self.sums[length:] - self.sums[:-length]) * self.shift[: len(self.sums) - length]

    def pieces(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[at + length] - self.sums[at]) * self.shift[at]

    def extension(self, a: np.ndarray, b: np.ndarray, longest: np.ndarray, before: bool = False) -> np.ndarray:
        """How many bytes from ``a`` and ``b`` on, or before them, are the same, ``longest`` at most: binary search."""

        def equal(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
            return self.pieces(a - n, n) == self.pieces(b - n, n) if before else self.pieces(a, n) == self.pieces(b, n)

        out = longest.copy()
        todo = np.flatnonzero(~equal(a, b, longest))
        a, b = a[todo], b[todo]
        known, bound = np.zeros(len(todo), np.int64), longest[todo]
        while (bound - known > 1).any():
            middle = (known + bound) // 2
            same = equal(a, b, middle)
            known, bound = np.where(same, middle, known), np.where(same, bound, middle)
        out[todo] = known
        return out


@dataclass
class Anchored:
    """Runs of strings with one anchor: the text each lies in, where its strings start (first and last), the
    anchor's place and its hash. Places count from the text's begin."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    mark: np.ndarray


def anchored(texts: list[bytes], length: int) -> Anchored:
    """A string's anchor is its least-hashed piece of ``GRAM`` bytes, the first of equals.

    Equal strings have it at the same place within them, whatever text they stand in. The texts are worked
    on as one array; strings that would reach over a text's end are left out.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    content = np.frombuffer(b"".join(texts), np.uint8)
    n = len(content) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return Anchored(none, none, none, none, none.view(np.uint64))
    hashes = mix(Prefixes(content).every(GRAM))
    least, width, have = hashes, length - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[step:], least[:-step])
        have += step
    # a string has the anchor of the one before unless the least hash changes or its place was left
    fresh = np.ones(n, bool)
    fresh[1:] = (least[1:] != least[:-1]) | (hashes[: n - 1] == least[:-1])
    for edge in (begins, np.maximum(begins, ends - length + 1)):
        fresh[edge[edge < n]] = True
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], n) - 1
    who = np.searchsorted(ends, first, side="right")
    inside = first + length <= ends[who]
    first, last, who = first[inside], last[inside], who[inside]
    mark = least[first]
    # the anchor is where the run ends, where a lesser hash came in as it began, or in between
    entered = (first > 0) & (mark < least[np.maximum(first - 1, 0)])
    place = np.where(entered, first + width - 1, last)
    open_ = np.flatnonzero(~entered & (hashes[last] != mark))
    around = last[open_][:, None] + np.arange(width)
    place[open_] += (hashes[around] == mark[open_][:, None]).argmax(axis=1)
    base = begins[who]
    return Anchored(who, first - base, last - base, place - base, mark)


def mark_of(content: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the pieces at these places, as ``anchored`` has them; read in slices to bound memory."""
    out = np.empty(len(places), np.uint64)
    for i in range(0, len(places), 20_000):
        some = places[i : i + 20_000]
        low, high = int(some.min()), int(some.max()) + GRAM
        out[i : i + 20_000] = mix(Prefixes(content[low:high]).pieces(some - low, GRAM))
    return out


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BYTES_AT_ONCE`` together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BYTES_AT_ONCE or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def _fingerprints(buckets: int, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sends each document's anchor hashes to their buckets."""
    new_task("suffix_dedup")
    for batch in slices(batches):
        versions = np.array(batch.column("version").to_pylist(), np.int64)
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        owner, tokens = [np.empty(0, np.int32)], [np.empty(0, np.uint64)]
        for a, b in blocks(texts):
            found = anchored(texts[a:b], length)
            order = np.lexsort((found.mark, found.owner))
            who, mark = found.owner[order], found.mark[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (who[1:] != who[:-1]) | (mark[1:] != mark[:-1])
            owner.append(who[fresh] + a)
            tokens.append(mark[fresh])
        yield table_of(list(sent(versions, np.concatenate(owner), np.concatenate(tokens), buckets)), SENT)


def table_of(rows: list[dict[str, object]], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def _snippets(buckets: int, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sends the surroundings of each anchor that other documents have to the anchor's bucket.

    Equal surroundings are sent once for a batch, by the smallest key that has them, with all places where
    it does; at greater keys they are copies for sure.
    """
    for batch in slices(batches):
        docs, versions = (np.array(batch.column(c).to_pylist(), np.int64) for c in KEY)
        order = np.argsort(docs, kind="stable")
        docs, versions = docs[order], versions[order]
        columns = unpacked(batch.column("text")), batch.column("tokens").to_pylist()
        texts, wanted = ([column[i] for i in order.tolist()] for column in columns)
        texts = [t.encode() for t in texts]
        snippets: dict[tuple[int, int, bytes], int] = {}
        owners: list[int] = []
        places: list[tuple[int, int, int]] = []
        sure: list[tuple[int, int, int, int]] = []
        for a, b in blocks(texts):
            found = anchored(texts[a:b], length)
            # a token counts for the document it was found in: both go into one number
            low = (found.mark & np.uint64(0xFFFFFFFF)).astype(np.int64)
            asked = [np.frombuffer(w, np.uint32).astype(np.int64) | i << 32 for i, w in enumerate(wanted[a:b])]
            hit = np.flatnonzero(np.isin(low | found.owner.astype(np.int64) << 32, np.concatenate(asked)))
            runs = (x[hit].tolist() for x in (found.owner, found.first, found.last, found.place, found.mark))
            for who, first, last, place, mark in zip(*runs, strict=True):
                doc, version = int(docs[a + who]), int(versions[a + who])
                key = mark, place - first, texts[a + who][first : last + length]
                k = snippets.setdefault(key, len(snippets))
                if k == len(owners):
                    owners.append(doc)
                if owners[k] == doc:
                    places.append((k, version, first))
                else:
                    sure.append((doc, version, first, last))
        rows: list[dict[str, object]] = []
        if snippets:
            marks = np.array([k[0] for k in snippets], np.uint64)
            bucket, keys = bucket_of(marks, buckets), list(snippets)
            by_snippet = np.array(sorted(places), np.int64)
            counts = np.bincount(by_snippet[:, 0], minlength=len(keys))
            begin = np.cumsum(counts) - counts
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                held = np.concatenate([np.arange(begin[p], begin[p] + counts[p]) for p in part])
                rows.append(squeezed({
                    "docs": np.array(owners, np.int64)[part], "counts": counts[part], "versions": by_snippet[held, 1],
                    "firsts": by_snippet[held, 2], "sizes": [len(keys[p][2]) for p in part], "shifts": [keys[p][1] for p in part],
                    "content": np.frombuffer(b"".join([keys[p][2] for p in part]), np.uint8),
                }, int(bucket[part[0]])))
        for i in range(0, len(sure), 100_000):
            some = np.array(sure[i : i + 100_000], np.int64)
            rows.append(squeezed({"sure": some.ravel()}, int(some[0, 0] % buckets)))
        yield table_of(rows, SNIPPETS)


def squeezed(arrays: dict[str, Any], bucket: int) -> dict[str, object]:
    compress = zstandard.ZstdCompressor(level=1).compress
    return {"bucket": bucket} | {n: compress(np.asarray(arrays.get(n, ()), kind).tobytes()) for n, kind in ARRAYS.items()}


def expanded(rows: pd.DataFrame, name: str) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    found = np.frombuffer(b"".join(map(expand, rows[name])), ARRAYS[name])
    return found if name == "content" else found.astype(np.int64)


def merge_sorted(order: np.ndarray, group: np.ndarray, less: Any) -> np.ndarray:
    """Stable mergesort of ``order`` within runs of equal ``group``, all merges of a level at once.

    ``less(a, b)`` compares arrays of items. In a merge the place of an item is its own index plus its rank
    in the other half, found by binary search.
    """
    n = len(order)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, n))
    base, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max(initial=0):
        # items of groups that still have a second half to merge
        at = np.arange(n) - base
        block = at // (2 * width) * (2 * width)
        middle, end = np.minimum(block + width, size), np.minimum(block + 2 * width, size)
        active = np.flatnonzero(middle < end)
        in_left = at[active] < middle[active]
        low = base[active] + np.where(in_left, middle[active], block[active])
        high = base[active] + np.where(in_left, end[active], middle[active])
        first = low.copy()
        item = order[active]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            other, own, left = order[mid], item[open_], in_left[open_]
            # from the left: others that are less; from the right: others that are not greater
            before = less(np.where(left, other, own), np.where(left, own, other))
            before = np.where(left, before, ~before)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        offset = at[active] - np.where(in_left, block[active], middle[active])
        target = base[active] + block[active] + offset + (low - first)
        out = order.copy()
        out[target] = item
        order = out
        width *= 2
    return order


def suffix_order(
    content: np.ndarray, at: np.ndarray, sizes: np.ndarray, group: np.ndarray, before: bool = False, prefixes: Prefixes | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The strings of ``sizes`` bytes from ``at`` on in order, group by group, and how many bytes each has in
    common with the one before it (-1 for a group's first).

    With ``before``, strings end at ``at`` and are read backwards. They are sorted by hash comparison; then each is
    held against the one before it byte by byte. If that finds one pair out of order, they are sorted by their bytes.
    """
    prefixes = prefixes or Prefixes(content)

    def byte(items: np.ndarray, k: np.ndarray | int) -> np.ndarray:
        return content[at[items] - 1 - k if before else at[items] + k]

    def compare(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes in common, and whether ``a`` is less."""
        shorter = np.minimum(sizes[a], sizes[b])
        same = prefixes.extension(at[a], at[b], shorter, before)
        out = sizes[a] < sizes[b]
        differ = np.flatnonzero(same < shorter)
        a, b, k = a[differ], b[differ], same[differ]
        out[differ] = byte(a, k) < byte(b, k)
        return same, out

    by_group = np.argsort(group, kind="stable")
    order = merge_sorted(by_group, group[by_group], lambda a, b: compare(a, b)[1])
    common = np.full(len(order), -1)
    follows = np.flatnonzero(group[order[1:]] == group[order[:-1]])
    a, b = order[follows], order[follows + 1]
    same, less = compare(a, b)
    common[follows + 1] = same
    right = bool((less | ((same == sizes[a]) & (same == sizes[b]))).all())
    for k in range(same.max(initial=0)):
        reach = same > k
        if not reach.all():
            a, b, same = a[reach], b[reach], same[reach]
        right = right and bool((byte(a, k) == byte(b, k)).all())
    if right:
        return order, common
    strings = [content[i - n : i][::-1].tobytes() if before else content[i : i + n].tobytes() for i, n in zip(at.tolist(), sizes.tolist(), strict=True)]
    order = np.array(sorted(range(len(at)), key=lambda i: (group[i], strings[i])))
    pairs = zip(order[:-1].tolist(), order[1:].tolist(), strict=True)
    return order, np.array([-1] + [len(commonprefix([strings[i], strings[j]])) if group[i] == group[j] else -1 for i, j in pairs])


def classes_at(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """A number for each string of ``suffix_order``: equal for those of one group with the same first ``length`` bytes."""
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(common < length) - 1
    return classes


def suffix_classes(content: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """A number for each string of ``length`` bytes at ``at``: equal for equal strings of one group."""
    return classes_at(*suffix_order(content, at, np.full(len(at), length), group), length)


def copied_strings(
    content: np.ndarray, begin: np.ndarray, sizes: np.ndarray, shifts: np.ndarray, anchor: np.ndarray, docs: np.ndarray, length: int
) -> np.ndarray:
    """Which strings of ``length`` bytes a smaller key has too: a row for each surrounding, a column for each start in it.

    Strings of one anchor are equal if it stands at the same place in them, with the same bytes before it and from
    it on. So what stands on either side of an anchor is sorted once for all strings over it, which are runs of
    common beginnings in both orders.
    """
    prefixes, place = Prefixes(content), begin + shifts
    after = suffix_order(content, place, sizes - shifts, anchor, prefixes=prefixes)
    before = suffix_order(content, place, shifts, anchor, before=True, prefixes=prefixes)
    out = np.zeros((len(docs), length - GRAM + 1), bool)
    for shift in range(length - GRAM + 1):
        some = np.flatnonzero((shifts >= shift) & (shifts - shift + length <= sizes))
        if not len(some):
            continue
        classes = (classes_at(*after, length - shift) * len(docs) + classes_at(*before, shift))[some]
        order = np.argsort(classes)
        starts = np.append(True, classes[order[1:]] != classes[order[:-1]])
        some = some[order]
        least = np.minimum.reduceat(docs[some], np.flatnonzero(starts))
        some = some[least[np.cumsum(starts) - 1] < docs[some]]
        out[some, shifts[some] - shift] = True
    return out


def _copies(length: int) -> Any:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        new_task("suffix_dedup")
        found = [expanded(rows, "sure").reshape(-1, 4)]
        docs, counts, versions, firsts, sizes, shifts = (expanded(rows, c) for c in ("docs", "counts", "versions", "firsts", "sizes", "shifts"))
        content = expanded(rows, "content")
        begin, places = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        marks = mark_of(content, begin + shifts)
        # a slice of whole anchors at a time
        order = np.argsort(marks, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(marks[order]) != 0)) if len(order) else np.empty(0, np.int64)
        several = np.diff(np.append(starts, len(order)))
        order = order[np.repeat(several > 1, several)]
        weight = np.cumsum(sizes[order])
        at = 0
        while at < len(order):
            to = int(np.searchsorted(weight, (weight[at - 1] if at else 0) + BYTES_AT_ONCE)) + 1
            while to < len(order) and marks[order[to]] == marks[order[to - 1]]:
                to += 1
            part, at = order[at:to], to
            anchor = np.cumsum(np.append(0, np.diff(marks[part]) != 0))
            local = np.cumsum(sizes[part]) - sizes[part]
            piece = np.concatenate([content[b : b + s] for b, s in zip(begin[part].tolist(), sizes[part].tolist(), strict=True)])
            copy = copied_strings(piece, local, sizes[part], shifts[part], anchor, docs[part], length)
            edges = np.diff(np.pad(copy, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (item, first), last = np.nonzero(edges > 0), np.nonzero(edges < 0)[1] - 1
            which = part[item]
            run_of = np.repeat(np.arange(len(first)), counts[which])
            nth = np.arange(len(run_of)) - np.repeat(np.cumsum(counts[which]) - counts[which], counts[which])
            place = places[which][run_of] + nth
            found.append(np.stack([docs[which][run_of], versions[place], firsts[place] + first[run_of], firsts[place] + last[run_of]], axis=1))
        every = np.concatenate(found)
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        starts = np.flatnonzero(np.append(True, (np.diff(every[:, :2], axis=0) != 0).any(axis=1))) if len(every) else np.empty(0, np.int64)
        ranges = [x.ravel() for x in np.split(every[:, 2:], starts[1:])] if len(starts) else []
        return pd.DataFrame({"doc": every[starts, 0], "version": every[starts, 1], "ranges": pd.Series(ranges, dtype=object)})

    return run


def repeated_strings(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, marks``: first and last start of runs of strings that a smaller key's text has too.

    1. Each string is assigned to its anchor, and anchors that no other content has are out.
    2. What stands around the others is brought together by anchor, and its strings are sorted.
    3. A document whose whole text a smaller key has is one run; it takes no part in the steps before.
    """
    buckets = max(1, partitions(docs.sparkSession) // 2)
    rows = keyed(docs, key, text).filter(F.octet_length("text") >= length)
    content = rows.select(*KEY, F.md5(F.col("text").cast("binary")).alias("content"), F.octet_length("text").cast("long").alias("size"))
    firsts = staged(content.groupBy("version", "content").agg(F.min("doc").alias("first")))
    copies = staged(content.join(firsts, ["version", "content"]).filter("doc > first").select(*KEY, "size").distinct())

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _fingerprints(buckets, length, batches)

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _snippets(2 * buckets, length, batches)

    shared = staged(in_other_content(rows.select("version", "text").mapInArrow(fingerprints, SENT), buckets))
    # a content's tokens are for the first document that has it
    wanted = shared.withColumnRenamed("content", "version").join(firsts.select("version", F.col("first").alias("doc")), "version")
    around = packed(rows).join(wanted, KEY).select(*KEY, "text", "tokens")
    runs = around.mapInArrow(snippets, SNIPPETS).groupBy("bucket").applyInPandas(_copies(length), RANGES)
    whole = copies.select(*KEY, F.array(F.lit(0).cast("long"), F.col("size") - length).alias("ranges"))
    return runs.union(whole).groupBy(*KEY).agg(F.flatten(F.collect_list("ranges")).alias("marks"))


def without_spans(text: str, marks: list[int], length: int, whole_characters: bool) -> dict[str, Any]:
    raw = text.encode()
    change = np.zeros(len(raw) + 1, np.int32)
    np.add.at(change, np.array(marks[::2], np.int64), 1)
    np.add.at(change, np.array(marks[1::2], np.int64) + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    content = np.frombuffer(raw, np.uint8)
    if whole_characters:  # a character goes if all its bytes do
        begins = np.flatnonzero((content & 0xC0) != 0x80)
        if len(begins):
            gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.append(begins, len(raw))))
    kept = content[~gone].tobytes()
    edges = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
    return {
        "n_bytes": len(raw), "n_removed": int(gone.sum()), "n_spans": int((edges > 0).sum()),
        "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept_text": kept.decode() if whole_characters else "",
    }


def suffix_dedup(
    docs: DataFrame, length: int = 50, whole_characters: bool = True, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (all columns of the input), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept_text``.

    A byte goes if a string of ``length`` bytes over it also starts in a text with a smaller key, as the input
    has it. With ``whole_characters`` only characters that go entirely are taken out and ``kept_text`` is the
    rest; without, bytes are, and ``kept_text`` stays empty. Null and empty texts, and those shorter than
    ``length``, lose nothing. A null key is smaller than any other; rows of one key don't count for each other.
    """
    marks = repeated_strings(docs, length, key, text)

    def edit(whole: str, found: list[int]) -> dict[str, Any]:
        return without_spans(whole, found, length, whole_characters)

    columns = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return edited(docs, marks, edit, columns, key, text)
