"""Packing documents into sequences by linear grouping and best fit (operator 5)."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from replat.llm.common import in_blocks, keyed_text, new_task, once, staged
from replat.llm.edits import FIRST_KEY
from replat.llm.token_counts import byte_characters

# The vocabulary's split pattern, within text without white space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Separators that str.split() knows and the vocabulary does not.
CONTROL = regex.compile(r"[\x1c-\x1f]")
REMEMBERED = 400_000
#: Before these characters, lower-casing is all that the vocabulary's normaliser does.
ODD = regex.compile(r"[^\x00-\u024f]")
LETTERS = dict(enumerate(byte_characters()))


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordCodec:
    """Ids of texts as the library gives them, word by word: no token spans white space."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = {t: pack_ids([self.library.token_to_id(t)]) for t in added}
        self.special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.pieces = regex.compile(PIECES)
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        """Ids of new words: those of plain characters from their pieces, any other from the library itself."""
        odd = [w for w in words if not w.isascii()] if ODD.search(" ".join(words)) else []
        odd = [w for w in odd if ODD.search(w)]
        known, tokenize, pieces = self.known, self.library.model.tokenize, self.pieces.findall
        for word in set(words).difference(odd) if odd else words:
            low, ids = word.lower(), b""
            for piece in (low,) if low.isalpha() else pieces(low):
                found = known.get(piece)
                if found is None:
                    letters = piece.encode().decode("latin-1").translate(LETTERS)
                    found = known[piece] = pack_ids([t.id for t in tokenize(letters)])
                ids += found
            self.words[word] = ids
        for word, found in zip(odd, self.library.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            self.words[word] = pack_ids(found.ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; the strings of added tokens count as those tokens."""
        parts = [self.special.split(t) if self.special else [t] for t in texts]
        split = [[[p] if p in self.added else CONTROL.search(p) and regex.split(r"\s+", p) or p.split() for p in ps] for ps in parts]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.words |= self.added
        self.words[""] = b""
        new = set().union(*(s for ss in split for s in ss)).difference(self.words)
        self.learn(list(new))
        get = self.words.__getitem__
        return [b"".join([b"".join(map(get, s)) for s in ss]) for ss in split]


def pieces(docs: DataFrame, vocabulary: str, capacity: int, closing: int) -> DataFrame:
    """Cuts every document's ids, closed by one id, into pieces of at most ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_task("packing")
        codec: WordCodec = once(f"words:{vocabulary}", lambda: WordCodec(vocabulary))
        end = pack_ids([closing])
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for first, last in in_blocks(texts):
                for key, ids in zip(keys[first:last], codec.encode(texts[first:last]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((key, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return keyed_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Prices:
    """The configuration (up to three of the sizes, ascending) that is worth most at given prices: the third size of
    every pair is the dearest of those that still fit, so pairs are looked at and not triples."""

    def __init__(self, sizes: list[int], capacity: int):
        held = np.array([0, *sizes])  # at 0: no size
        first, second = np.triu_indices(len(held))
        room = capacity - held[first] - held[second]
        fits = room >= 0
        self.first, self.second, room = first[fits], second[fits], room[fits]
        self.third = np.searchsorted(held, room, side="right")  # how many of the sizes fit beside the pair

    def best(self, prices: np.ndarray) -> tuple[float, list[int]]:
        price = np.append(0.0, prices)
        top = np.maximum.accumulate(price)
        value = price[self.first] + price[self.second] + top[self.third - 1]
        at = int(value.argmax())
        third = int(price[: self.third[at]].argmax())
        return float(value[at]), sorted(i - 1 for i in (int(self.first[at]), int(self.second[at]), third) if i)


def fractional(sizes: list[int], wanted: list[int], capacity: int) -> list[tuple[float, tuple[int, ...]]]:
    """How often to use which configuration, so that all wanted sizes are in as few sequences as possible.

    The linear program min sum(x), Ax = wanted, x >= 0 by the simplex method with columns generated as they are
    needed: each step asks for the configuration worth most at the sizes' dual values. ``sizes`` ascend. It
    starts from a sequence for each length. Amounts a little apart (Charnes) keep it from going round.
    """
    n, prices = len(wanted), Prices(sizes, capacity)
    base: list[tuple[int, ...]] = [(i,) for i in range(n)]
    demand = np.array(wanted, float)
    apart = demand + 1e-7 * np.arange(1, n + 1) / n
    inverse, amount = np.eye(n), apart.copy()
    for step in range(200 * n):
        value, config = prices.best(inverse.sum(axis=0))  # every sequence costs 1
        if value <= 1 + 1e-9:
            break
        toward = inverse @ np.bincount(config, minlength=n)
        ratio = np.full(n, np.inf)
        np.divide(amount, toward, out=ratio, where=toward > 1e-9)
        leave = int(ratio.argmin())
        base[leave] = tuple(config)
        if step % 50 == 49:  # rounding errors don't add up
            inverse = np.linalg.inv(np.stack([np.bincount(c, minlength=n) for c in base], axis=1))
        else:
            row = inverse[leave] / toward[leave]
            inverse = inverse - np.outer(toward, row)
            inverse[leave] = row
        amount = np.maximum(inverse @ apart, 0)
    return sorted(zip(np.maximum(inverse @ demand, 0).tolist(), base, strict=True), key=lambda x: (x[1], x[0]))


class Sequences:
    """Sequences with their room, and where each length stands."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.sequence, self.offset = np.full(len(lengths), -1), np.zeros(len(lengths), np.int64)
        self.free: list[int] = []

    def place(self, item: int, into: int) -> None:
        self.sequence[item], self.offset[item] = into, self.capacity - self.free[into]
        self.free[into] -= int(self.lengths[item])

    def best_fit(self, items: list[int]) -> None:
        """Puts each of the items, in their order, where the least room remains, or into a new sequence."""
        # sequences by the room they have; the set bits of an integer are the rooms that occur
        rooms: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        occurs = 0
        for into, room in enumerate(self.free):
            rooms[room].append(into)
            occurs |= 1 << room
        for item in items:
            size = int(self.lengths[item])
            fits = occurs >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                into = rooms[room].pop()
                if not rooms[room]:
                    occurs ^= 1 << room
            else:
                into = len(self.free)
                self.free.append(self.capacity)
            self.place(item, into)
            rooms[self.free[into]].append(into)
            occurs |= 1 << self.free[into]


def configured(lengths: np.ndarray, capacity: int, groups: int, loose: float, order: np.ndarray) -> Sequences:
    """Lengths above a quarter of the capacity by the best mix of configurations of few sizes.

    They are cut in their order into groups of equal cardinality and rounded up to their group's largest; the fullest
    configurations of the best mix come first. Each slot takes the longest document of its size that is left, the
    last slot of a sequence the longest that fits at all. A configuration whose documents leave more than ``loose``
    of the sequence empty is given up, and they stay unplaced, like those of the mix's fractions.
    """
    made = Sequences(lengths, capacity)
    left = order[: int((lengths > capacity // 4).sum())][::-1].tolist()
    parts = [part for part in np.array_split(left, min(groups, len(left)) or 1) if len(part)]
    if not parts:
        return made
    sizes = [int(lengths[part[-1]]) for part in parts]
    mix = fractional(sizes, [len(part) for part in parts], capacity)
    held = [int(lengths[x]) for x in left]
    for times, config in sorted(mix, key=lambda m: (-sum(sizes[i] for i in m[1]), m[1])):
        for _ in range(int(times + 1e-6)):
            room, places = capacity, []
            for n, i in enumerate(reversed(config), 1):
                limit = room if n == len(config) else min(room, sizes[i])
                at = bisect_right(held, limit, hi=places[-1] if places else len(held)) - 1
                if at < 0:
                    break
                places.append(at)
                room -= held[at]
            if len(places) < len(config) or room > loose * capacity:
                break
            made.free.append(capacity)
            for at in places:  # they descend, so a place taken moves none of the later ones
                made.place(left.pop(at), len(made.free) - 1)
                held.pop(at)
    return made


def pack(lengths: np.ndarray, capacity: int, groups: int = 144, loose: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length (1 to ``capacity``): configurations of the long ones by ``configured``, then
    all others by best fit, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    made = configured(lengths, capacity, groups, loose, order)
    made.best_fit(order[made.sequence[order] < 0].tolist())
    return made.sequence, made.offset


def _packer(capacity: int, first_id: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        new_task("packing")
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = pack(lengths, capacity)
        fill = np.bincount(sequence, weights=lengths).astype(np.int64)
        made = {"sequence_id": first_id + (rows["shard"].to_numpy() << 32) + sequence, "offset": offset}
        if "sequence_id" in rows and rows["sequence_id"].nunique() <= len(fill):
            return rows.assign(fill=0)  # packed before, and no better now
        return rows.assign(**made, fill=fill[sequence])

    return run


def packed(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    closing: int = 1,
    shard_tokens: int = 1_000_000,
    shard_rows: int = 20_000,
    merged: int = 64,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Pieces are dealt at random over shards of about ``shard_tokens`` tokens and ``shard_rows`` rows, each
    packed by itself. All its sequences under 98 % full are opened again and packed together with those of
    ``merged`` shards in all, so that hardly a sequence stays part empty; where that takes no fewer, they stay as they
    were. A null or empty text is a document of the closing id alone. Rows with equal keys are packed one by one.
    """
    # a null key would make pandas read all keys as floating-point numbers
    cut = pieces(docs, vocabulary, capacity, closing).withColumn("doc_id", F.coalesce("doc_id", F.lit(FIRST_KEY)))
    cut = staged(cut)
    total = cut.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(1, -(-total["tokens"] // shard_tokens), -(-total["rows"] // shard_rows))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, shard long"
    schema = columns + ", sequence_id long, offset long, fill long"
    once_packed = staged(dealt.groupBy("shard").applyInPandas(_packer(capacity, 0), schema))
    again = F.col("fill") < 0.98 * capacity
    opened = once_packed.filter(again).drop("fill").withColumn("shard", F.floor(F.col("shard") / merged))
    repacked = opened.groupBy("shard").applyInPandas(_packer(capacity, 1 << 62), schema)
    both = once_packed.filter(~again).union(repacked).drop("shard", "fill")
    return both.withColumn("doc_id", F.nullif("doc_id", F.lit(FIRST_KEY)))
