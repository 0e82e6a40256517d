"""Phrase collocations by relational mining of occurrences (operator 11).

An occurrence relation holds (position, phrase) in the order of positions, where pieces are apart by a gap, so
that one number says both the piece and the place in it. A relation is kept in blocks of some words, one stored
row each. Occurrences of phrases of ``k`` words, merge-joined with themselves at adjacent positions, are the
candidates of ``k + 1`` words; these are counted in groups over all blocks, and only occurrences of frequent
groups go into the next length. What is shuffled are the distinct phrases of a block, by ranges of their hash: a
range's phrases of one block are one packed row, and so is what comes back to the block.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replat.llm.common import partitions, slices, staged


@dataclass(frozen=True)
class Mining:
    """``longest``: words of the longest phrases. ``support``: least occurrences of a candidate. ``absorb``: a
    candidate goes if a longer one around it has this share of its occurrences, in percent. ``top``: phrases
    returned for each language. ``block_words``: words of a block. ``range_bytes``: text for each range of phrases."""

    longest: int = 5
    support: int = 100
    absorb: int = 100
    top: int = 2000
    block_words: int = 1_000_000
    range_bytes: int = 1 << 24


UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
PIECE_ENDS = b".,;:!?\x0b\x0c\r"
CLEAN = bytes.maketrans(UPPER + PIECE_ENDS + b"\t", LOWER + b"\n" * len(PIECE_ENDS) + b" ")
NOTHING, GAP = 0, 1


def tokens(text: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words and piece ends (a newline) of a text, with empty strings between; some at a time."""
    text = text.translate(CLEAN).replace(b"\n", b" \n ")
    at = 0
    while at < len(text):
        end = text.find(b" ", at + step)
        end = len(text) if end < 0 else end
        yield text[at:end].split(b" ")
        at = end + 1


def gaps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, which take fewer bytes; ``np.cumsum`` has the numbers again."""
    return np.diff(ascending, prepend=0)


def packed(*values: object) -> bytes:
    """Values in one string; whole numbers in as few bytes as they need, first bytes first, as these are alike."""

    def planes(v: np.ndarray) -> tuple[str, bytes]:
        least = v.astype(np.min_scalar_type(v.max(initial=0)))
        return least.dtype.str, least.view(np.uint8).reshape(len(v), -1).T.tobytes()

    return zstandard.compress(pickle.dumps([planes(v) if isinstance(v, np.ndarray) else v for v in values], 5), 3)


def unpacked(stored: bytes) -> list:
    def whole(kind: str, held: bytes) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.frombuffer(held, np.uint8).reshape(width, -1).T.copy().view(kind).ravel().astype(np.int64)

    return [whole(*v) if isinstance(v, tuple) else v for v in pickle.loads(zstandard.decompress(stored))]


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class Stream:
    """The words of one language in one task, cut into blocks. Blocks overlap by what the longest phrase needs."""

    def __init__(self, mining: Mining):
        self.mining, self.words = mining, defaultdict(count().__next__)
        assert (self.words[b""], self.words[b"\n"]) == (NOTHING, GAP)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        for some in tokens(text):
            ids = np.fromiter(map(self.words.__getitem__, some), np.int32, len(some))
            self.held.append(ids[ids != NOTHING])
            self.size += len(self.held[-1])
        self.held.append(np.array([GAP], np.int32))
        self.size += 1

    def blocks(self, rest: bool = False) -> Iterator[tuple[list[bytes], np.ndarray, bytes, int]]:
        """Words, their counts, the relation and the size of each full block; with ``rest``, of what is left too.

        Positions from ``owned`` on are there for phrases that start before, and counted in the next block.
        """
        overlap = self.mining.longest - 1
        if self.size < self.mining.block_words + overlap and not rest:
            return
        ids, at = np.concatenate(self.held) if self.held else np.empty(0, np.int32), 0
        while len(ids) - at >= self.mining.block_words + overlap or (rest and at < len(ids)):
            owned = min(self.mining.block_words, len(ids) - at)
            block = ids[at : at + owned + overlap]
            at += owned
            positions = np.flatnonzero(block != GAP)
            own, local = np.unique(block[positions], return_inverse=True)
            counts = np.bincount(local[positions < owned], minlength=len(own))
            # frequent words get small numbers, which pack better
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(own), np.int64)
            place[order] = np.arange(len(own))
            own, counts, local = own[order], counts[order], place[local]
            if len(own):
                names = list(self.words)
                yield [names[i] for i in own.tolist()], counts, packed(gaps(positions), local, owned), int(counts.sum())
        self.held, self.size = [ids[at:].copy()], len(ids) - at


#: Rows that travel: a block's relation has no range, what a range found frequent has no block.
ROW = "block long, range long, lang string, n long, body binary"
ARROW = pa.schema([("block", pa.int64()), ("range", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("body", pa.binary())])


def in_ranges(ranges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(ranges, kind="stable")
    cuts = np.flatnonzero(np.diff(ranges[order])) + 1
    for some in np.split(order, cuts):
        if len(some):
            yield int(ranges[some[0]]), some


def _words(mining: Mining, ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts -> blocks of single words: their relations, and their words by ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams: dict[str, Stream] = {}
        made = count(TaskContext.get().partitionId() << 32)

        def out(lang: str, rest: bool) -> Iterator[pa.RecordBatch]:
            for words, counts, relation, n in streams[lang].blocks(rest):
                block = next(made)
                rows: list[tuple] = [(block, None, lang, n, relation)]
                for r, some in in_ranges(np.array([zlib.crc32(w) % ranges for w in words])):
                    rows.append((block, r, lang, None, packed(gaps(some), counts[some], b" ".join([words[i] for i in some.tolist()]))))
                yield batch_of(rows, ARROW)

        for batch in slices(batches, 500):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                streams.setdefault(lang, Stream(mining)).add(text)
                yield from out(lang, False)
        for lang in streams:
            yield from out(lang, True)

    return run


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, list[dict]]]:
    """Consecutive rows with one value of ``by``. What a range or a block gets is bounded by its size."""
    at, held = None, []
    for batch in slices(batches, 256):
        for row in batch.to_pylist():
            if row[by] != at and held:
                yield at, held
                held = []
            at = row[by]
            held.append(row)
    if held:
        yield at, held


def _grouped(firsts: np.ndarray, rests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each pair's group, and the first place of each group."""
    order = np.lexsort((rests, firsts))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(firsts[order]) != 0) | (np.diff(rests[order]) != 0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[new]


def _frequent(mining: Mining, ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Phrases of all blocks by range -> the frequent ones with new ids, and for each block its own of these."""

    def of_words(rows: list[dict], r: int) -> tuple[list[np.ndarray], np.ndarray, bytes]:
        parts = [(row["lang"], *unpacked(row["body"])) for row in rows]
        total: Counter[tuple[str, bytes]] = Counter()
        for lang, _, counts, words in parts:
            for w, n in zip(words.split(b" "), counts.tolist(), strict=True):
                total[lang, w] += n
        kept = sorted(k for k, n in total.items() if n >= mining.support)
        ids = {k: i * ranges + r for i, k in enumerate(kept)}
        known = [np.array([ids.get((lang, w), -1) for w in words.split(b" ")], np.int64) for lang, _, _, words in parts]
        return known, np.array([total[k] for k in kept], np.int64), [(lang, w) for lang, w in kept]

    def of_pairs(rows: list[dict], r: int) -> tuple[list[np.ndarray], np.ndarray, tuple]:
        parts = [unpacked(row["body"]) for row in rows]
        counts, rests = (np.concatenate([p[i] for p in parts]) for i in (1, 3))
        firsts = np.concatenate([np.cumsum(p[2]) for p in parts])
        group, lead = _grouped(firsts, rests)
        f = np.bincount(group, weights=counts, minlength=len(lead)).astype(np.int64)
        kept = np.flatnonzero(f >= mining.support)
        ids = np.full(len(lead), -1, np.int64)
        ids[kept] = np.arange(len(kept)) * ranges + r
        ends = np.cumsum([len(p[0]) for p in parts])
        return np.split(ids[group], ends[:-1]), f[kept], (firsts[lead[kept]], rests[lead[kept]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, rows in _runs(batches, "range"):
            words = rows[0]["lang"] is not None
            known, f, kept = (of_words if words else of_pairs)(rows, r)
            ids = np.arange(len(f)) * ranges + r
            out: list[tuple] = [(None, r, None, None, packed(ids, f, kept) if words else packed(ids, f, *kept))] if len(f) else []
            for row, own in zip(rows, known, strict=True):
                if (own >= 0).any():
                    places = np.cumsum(unpacked(row["body"])[0])
                    out.append((row["block"], r, None, None, packed(gaps(places[own >= 0]), own[own >= 0])))
            if out:
                yield batch_of(out, ARROW)

    return run


def _extended(ranges: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of one length and their frequent phrases -> blocks of the next length, and their phrases by ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _runs(batches, "block"):
            relation = [row for row in rows if row["range"] is None]
            answers = [unpacked(row["body"]) for row in rows if row["range"] is not None]
            if not relation or not answers:
                continue
            between, phrases, owned = unpacked(relation[0]["body"])
            places, ids = np.concatenate([np.cumsum(steps) for steps, _ in answers]), np.concatenate([own for _, own in answers])
            by_id = np.argsort(ids, kind="stable")
            places, ids = places[by_id], ids[by_id]
            known = np.full(max(int(phrases.max(initial=0)), int(places.max(initial=0))) + 1, -1, np.int64)
            known[places] = np.arange(len(places))
            local = known[phrases]
            positions, local = np.cumsum(between)[local >= 0], local[local >= 0]
            # both sides of the merge join are this relation, in order: a partner is the next entry or none
            first = np.flatnonzero(positions[1:] == positions[:-1] + 1)
            pairs, made = np.unique(local[first] * len(ids) + local[first + 1], return_inverse=True)
            if not len(pairs):
                continue
            counts = np.bincount(made[positions[first] < owned], minlength=len(pairs))
            firsts, rests = ids[pairs // len(ids)], ids[pairs % len(ids)]
            mixed = (firsts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rests.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            out: list[tuple] = [(block, None, None, None, packed(gaps(positions[first]), made, owned))]
            for r, some in in_ranges(((mixed >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)):
                out.append((block, r, None, None, packed(gaps(some), counts[some], gaps(firsts[some]), rests[some])))
            yield batch_of(out, ARROW)

    return run


def _listed(words: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Frequent phrases as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for body in batch.column("body").to_pylist():
                ids, f, *kept = unpacked(body)
                if words:
                    langs, names = zip(*kept[0], strict=True)
                    columns = [pa.array(ids), pa.array(f), pa.array(langs, pa.string()), pa.array(names, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "f", "lang", "word"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(f), *map(pa.array, kept)], ["id", "f", "first", "rest"])

    return run


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _by_id(level: DataFrame, side: str) -> DataFrame:
    """A length's phrases as the first or last part of the next length's."""
    return level.select(*[F.col(c).alias(f"{side}_{c}") for c in level.columns])


def frequent_phrases(docs: DataFrame, mining: Mining, lang: str = "lang", text: str = "text") -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length, and ``lang, n``.

    A length's columns: ``id, lang, phrase, last`` (its last word), ``f``, and ``lefts, rights``: the occurrences of
    both sides of each cut, from the cut after the first word on.
    """
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(partitions(docs.sparkSession), -(-size // mining.range_bytes))
    held = staged(texts.mapInArrow(_words(mining, ranges), ROW))
    totals = held.filter("range is null").groupBy("lang").agg(F.sum("n").alias("n"))
    levels: list[DataFrame] = []
    while True:
        asked = held.filter("range is not null").repartition("range").sortWithinPartitions("range")
        told = staged(asked.mapInArrow(_frequent(mining, ranges), ROW))
        levels.append(_level(told.filter("block is null"), levels))
        if len(levels) == mining.longest:
            return levels, totals
        both = held.filter("range is null").unionByName(told.filter("block is not null"))
        held = staged(both.repartition("block").sortWithinPartitions("block").mapInArrow(_extended(ranges), ROW))


def _level(told: DataFrame, shorter: list[DataFrame]) -> DataFrame:
    """The frequent phrases of the next length, from those one word shorter."""
    if not shorter:
        words = told.mapInArrow(_listed(True), "id long, f long, lang string, word binary")
        word, none = F.col("word").cast("string"), F.array().cast("array<long>")
        return staged(words.select("id", "lang", word.alias("phrase"), word.alias("last"), "f", none.alias("lefts"), none.alias("rights")))
    pairs = told.mapInArrow(_listed(False), "id long, f long, first long, rest long")
    both = pairs.join(_by_id(shorter[-1], "first"), F.col("first") == F.col("first_id")).join(
        _by_id(shorter[-1], "rest"), F.col("rest") == F.col("rest_id")
    )
    return staged(both.select(
        "id", F.col("first_lang").alias("lang"), F.concat_ws(" ", "first_phrase", "rest_last").alias("phrase"),
        F.col("rest_last").alias("last"), "f", F.concat("first_lefts", F.array("first_f")).alias("lefts"),
        F.concat(F.array("rest_f"), "rest_rights").alias("rights"), "first", "rest",
    ))


def collocations(docs: DataFrame, mining: Mining | None = None, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language, by score.

    The score of a phrase is that of its weakest cut, ``floor(1000 * a * n / (l * r))``, in exact decimals. A
    phrase goes if a longer candidate around it is as frequent; it is enough to look at those one word longer,
    as such a phrase lies between any two and is at least as frequent as the longer one.

    A null language is ``und``, a null text is empty, and empty texts have no words. Repeated rows count each time.
    Texts of any length are cut into blocks that overlap, so no occurrence is lost or counted twice. Other
    columns are not looked at; an empty table gives no rows.
    """
    mining = mining or Mining()
    levels, totals = frequent_phrases(docs, mining, lang, text)
    kept = None
    for k, level in enumerate(levels[1:], 1):
        rows = level
        if k + 1 < len(levels):
            longer = levels[k + 1]
            around = longer.select(F.col("first").alias("id"), "f").unionByName(longer.select(F.col("rest").alias("id"), "f"))
            around = around.groupBy("id").agg(F.max("f").alias("longer"))
            absorbed = 100 * F.coalesce("longer", F.lit(-1)) >= mining.absorb * F.col("f")
            rows = level.join(around, "id", "left").filter(~absorbed)
        rows = rows.select("lang", "phrase", F.col("f").alias("a"), "lefts", "rights")
        kept = rows if kept is None else kept.unionByName(rows)
    if kept is None:
        raise ValueError("a phrase has two words at least")
    joined = kept.join(totals, "lang")
    sides = F.arrays_zip("lefts", "rights")
    above = F.lit(1000).cast("decimal(4,0)") * _exact(F.col("a")) * _exact(F.col("n"))

    def cut(side: Column, i: Column) -> Column:
        score = F.call_function("div", above, _exact(side["lefts"]) * _exact(side["rights"]))
        return F.struct(score.alias("score"), i.alias("cut"), side["lefts"].alias("l"), side["rights"].alias("r"))

    weakest = joined.select("lang", "phrase", "a", "n", F.array_min(F.transform(sides, cut)).alias("best"))
    scored = weakest.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    # the best of each part of a language first, so that one task never gets all of it
    some = scored.withColumn("part", salt)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= mining.top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= mining.top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(mining: Mining | None = None) -> str:
    """The same in SQL, from phrases of every length without pruning."""
    m = mining or Mining()
    upper, lower = UPPER.decode(), LOWER.decode()
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
words as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
phrases as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) as phrase
  from words, range(1, {m.longest + 1}) lengths(k)),
f as (select lang, k, phrase, count(*) as f from phrases group by all having count(*) >= {m.support}),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
candidates as (select *, string_split(phrase, ' ') as w from f where k >= 2),
parts as (
  select distinct lang, f, list_aggregate(w[s:s + size - 1], 'string_agg', ' ') as part
  from candidates, range(1, {m.longest + 1}) starts(s), range(2, {m.longest + 1}) sizes(size)
  where size < k and s + size - 1 <= k),
absorbed as (select lang, part, max(f) as longer from parts group by all),
kept as (
  select c.* from candidates c left join absorbed x on x.lang = c.lang and x.part = c.phrase
  where longer is null or 100 * longer < {m.absorb} * f),
cuts as (
  select c.lang, c.phrase, c.f as a, cut, l.f as l, r.f as r, n,
    (1000::hugeint * c.f * n) // (l.f::hugeint * r.f) as score
  from kept c join range(1, {m.longest}) cuts(cut) on cut < c.k
  join f l on l.lang = c.lang and l.phrase = list_aggregate(c.w[1:cut], 'string_agg', ' ')
  join f r on r.lang = c.lang and r.phrase = list_aggregate(c.w[cut + 1:], 'string_agg', ' ')
  join totals t on t.lang = c.lang),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as bigint) as rank, phrase, a, l, r, n,
  cast(score as bigint) as score
from weakest qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= {m.top}
"""
