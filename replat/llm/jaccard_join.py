"""Jaccard join of word shingles by partitioning the universe of tokens (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replat.llm.common import in_blocks, new_task, once, partitions, slices, staged
from replat.llm.components import components
from replat.llm.edits import FIRST_KEY, KEY, keyed, packed, unpacked
from replat.llm.shared_tokens import SENT, found_elsewhere, mix, sent

WORDS = 5
#: A pair links if PARTS * |intersection| >= SHARE * |union|.
SHARE, PARTS = 3, 4
REMEMBERED = 100_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SALT = np.uint64(0xD1B54A32D192ED03)
INFO = 5  # doc, version, two fingerprints of the set, its size
FIRST_PASS = SENT + ", info binary"
BY_SET = "part int, sets binary, hits binary, info binary"
DOCUMENTS = "doc long, version long, set1 long, set2 long, n_shingles long, reach long, candidate boolean"
SIGNED = "bucket int, docs binary, labels binary, sizes binary, reaches binary, sketches binary, owners binary, signatures binary"
#: Cells of a sketch: the tokens of a set are counted in so many parts of the universe.
CELLS = 128


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the text and 64-bit hash of each distinct shingle, in order of both.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer than ``WORDS`` words has
    its whole sequence as its one shingle; one without words has none.
    """
    known: dict[bytes, int] = once("word-hashes", dict)
    if len(known) > REMEMBERED:
        known.clear()
    words = [t.encode().lower().split() for t in texts]
    for w in set().union(*words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    counts = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((h for ws in words for h in map(known.__getitem__, ws)), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - WORDS + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(WORDS):
            rolled = rolled * BASE + hashes[k : k + n]
        whole = owner[:n] == owner[WORDS - 1 :] if n else np.zeros(0, bool)
        tokens, who = mix(rolled[whole]), owner[:n][whole]
        begin = np.cumsum(counts) - counts
        for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
            one = np.uint64(counts[i])
            for h in hashes[begin[i] : begin[i] + counts[i]]:
                one = one * BASE + h
            tokens, who = np.append(tokens, mix(np.array([one ^ SALT]))), np.append(who, np.int32(i))
    order = np.lexsort((tokens, who))
    tokens, who = tokens[order], who[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (who[1:] != who[:-1])
    return who[fresh], tokens[fresh]


def set_prints(owner: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit fingerprints and the size of each of ``n`` sets."""
    out = np.zeros((n, 3), np.uint64)
    if len(owner):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        who = owner[starts]
        with np.errstate(over="ignore"):
            out[who, 0] = np.add.reduceat(mix(tokens ^ SALT), starts)
            out[who, 1] = np.add.reduceat(mix(tokens + BASE), starts)
        out[who, 2] = np.diff(np.append(starts, len(owner)))
    return out


def _record(rows: list[dict[str, object]], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32() if n in ("bucket", "part") else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n, b"") for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)


def names_of(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _first_pass(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    new_task("jaccard_join")
    for batch in slices(batches):
        docs, versions = (np.array(batch.column(c).to_pylist(), np.int64) for c in KEY)
        texts = batch.column("text").to_pylist()
        rows: list[dict[str, object]] = []
        owners, tokens, info = [np.empty(0, np.int32)], [np.empty(0, np.uint64)], [np.empty((0, INFO), np.int64)]
        for a, b in in_blocks(texts):
            who, found = shingles(texts[a:b])
            prints = set_prints(who, found, b - a).view(np.int64)
            info.append(np.column_stack([docs[a:b], versions[a:b], prints]))
            owners.append(who + np.int32(a))
            tokens.append(found)
        every = np.concatenate(info)
        rows += sent(np.ascontiguousarray(every[:, 2]), np.concatenate(owners), np.concatenate(tokens), buckets)
        if len(every):
            rows.append({"bucket": int(every[0, 0] % buckets), "info": every.tobytes()})
        yield _record(rows, names_of(FIRST_PASS))


def _by_set(parts: int):
    """What a bucket found, dealt by set: how many of its shingles other sets have."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        info = np.frombuffer(b"".join(rows["info"]), np.int64).reshape(-1, INFO)
        sets, hits, _, _ = found_elsewhere(rows)
        sets, once = np.unique(sets, return_index=True)
        hits = hits[once]
        out = []
        of_hit, of_info = (mix(x.view(np.uint64)) % np.uint64(parts) for x in (sets, np.ascontiguousarray(info[:, 2])))
        for p in np.union1d(of_hit, of_info):
            a, b = of_hit == p, of_info == p
            out.append((int(p), sets[a].tobytes(), hits[a].astype(np.int32).tobytes(), info[b].tobytes()))
        return pd.DataFrame(out, columns=names_of(BY_SET))

    return run


def _documents(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each document; a candidate has enough of its shingles in other sets to link with one.

    Its ``reach`` is the size of the largest set it can link with: a pair has at most the shared shingles s of
    either in common, and s / (size + other - s) must reach the threshold.
    """
    info = pd.DataFrame(np.frombuffer(b"".join(rows["info"]), np.int64).reshape(-1, INFO), columns=["doc", "version", "set1", "set2", "n_shingles"])
    sets, hits = np.frombuffer(b"".join(rows["sets"]), np.int64), np.frombuffer(b"".join(rows["hits"]), np.int32)
    every, which = np.unique(sets, return_inverse=True)
    total = np.bincount(which, weights=hits, minlength=len(every)) if len(every) else np.zeros(0)
    at = np.minimum(np.searchsorted(every, info["set1"]), max(0, len(every) - 1))
    of_set = np.where(every[at] == info["set1"], total[at], 0) if len(every) else np.zeros(len(info))
    info["reach"] = (PARTS + SHARE) * of_set.astype(np.int64) // SHARE - info["n_shingles"]
    info["candidate"] = (PARTS * of_set >= SHARE * info["n_shingles"]) & (info["n_shingles"] > 0)
    return info


def documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, version, set1, set2, n_shingles, reach, candidate`` of every row.

    A linked pair shares three quarters of either set, so a document with fewer of its shingles in sets
    other than its own can't have a link to one. This leaves near copies, whose sets are made again.
    """
    buckets = partitions(docs.sparkSession)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _first_pass(buckets, batches)

    rows = keyed(docs, key, text).mapInArrow(first_pass, FIRST_PASS)
    dealt = rows.groupBy("bucket").applyInPandas(_by_set(buckets), BY_SET)
    return staged(dealt.groupBy("part").applyInPandas(_documents, DOCUMENTS))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    new_task("jaccard_join")
    for batch in slices(batches):
        texts = [t or "" for t in unpacked(batch.column("text"))]
        out = []
        for a, b in in_blocks(texts):
            who, tokens = shingles(texts[a:b])
            ends = np.searchsorted(who, np.arange(b - a + 1))
            out += [tokens[ends[i] : ends[i + 1]].tobytes() for i in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("reach"), pa.array(out, pa.binary())], ["doc", "reach", "tokens"])


def band(size: int) -> tuple[int, int]:
    """Least and greatest size of the band a size is in; bands grow by a third."""
    known = once("jaccard_bands", dict)
    if size not in known:
        low = 1
        while size > (high := max(low, low * 4 // 3 - 1)):
            low = high + 1
        known[size] = low, high
    return known[size]


def scheme(low: int, high: int) -> tuple[int, int]:
    """Greatest number of differing tokens of a linked pair whose larger set is in the band, and the number
    of segments: one more, and as many as a set of the band is likely to leave empty."""
    known = once("jaccard_schemes", dict)
    if (low, high) not in known:
        known[low, high] = _scheme(low, high)
    return known[low, high]


def _scheme(low: int, high: int) -> tuple[int, int]:
    differ = (PARTS - SHARE) * 2 * high // (PARTS + SHARE)
    segments = differ + 1
    for _ in range(20):
        empty = segments * np.exp(-low / segments)
        wanted = differ + 1 + int(np.ceil(empty + 3 * np.sqrt(empty)))
        if wanted <= segments:
            break
        segments = wanted
    return differ, segments


def signatures(tokens: np.ndarray) -> np.ndarray:
    """Signatures of a set: two linked sets have at least one in common.

    For its own band and each band a larger partner can be in, tokens are hashed to segments. A linked pair
    differs in at most d tokens, so at least (segments - d) segments agree. If fewer than that are
    empty here, the subsets of the segments that are not empty are signatures enough. Otherwise segments of
    two tokens and more are also given their one-deletion neighbourhoods, which cost a signature a token but
    tolerate one difference each; and where even these don't add up to d + 1, every token is a signature.
    """
    size = len(tokens)
    spread, out, low = mix(tokens + SALT), [], 0
    while True:
        low, high = band(size) if not low else band(high + 1)
        if low > size and low * SHARE > size * PARTS:
            return np.unique(np.concatenate(out))
        differ, segments = scheme(low, high)
        segment = ((tokens >> np.uint64(17)) % np.uint64(segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        ordered = segment[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.diff(np.append(starts, size))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(spread[order], starts)
            place = (ordered[starts].astype(np.uint64) + np.uint64(low) * BASE) * SALT
            out.append(mix(sums ^ mix(place)))
            if segments - len(starts) > segments - differ - 1:
                several = counts >= 2
                rest = np.repeat(sums, counts) - spread[order]
                kept = np.repeat(several, counts)
                out.append(mix(rest ^ mix(np.repeat(place, counts)))[kept])
                if 2 * several.sum() + (~several).sum() < differ + 1:
                    out.append(mix(spread ^ mix(np.array([low], np.uint64))))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """How many tokens lie in each cell. Two sets have at most the sum of the cells' smaller counts in common."""
    return np.bincount((tokens >> np.uint64(7)) % np.uint64(CELLS), minlength=CELLS).astype(np.uint32)


def _signed(buckets: int, across: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sends signatures to their buckets, with what each document there is told apart by."""
    new_task("jaccard_join")
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        docs, labels, reaches = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("doc", "label", "reach"))
        sets = [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
        rows = []
        if sets:
            signed = [signatures(s) for s in sets]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in signed])
            every, sizes = np.concatenate(signed), np.array([len(s) for s in sets], np.int64)
            sketches = np.array([sketch(s) for s in sets]) if across else np.empty((len(sets), 0), np.uint32)
            bucket = (every >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                who, at = np.unique(owner[part], return_inverse=True)
                held = {"docs": docs[who], "labels": labels[who], "sizes": sizes[who], "reaches": reaches[who], "owners": at.astype(np.int64), "sketches": sketches[who]}
                rows.append({"bucket": int(bucket[part[0]]), "signatures": every[part].tobytes()} | {n: compress(x.tobytes()) for n, x in held.items()})
        yield _record(rows, names_of(SIGNED))


def fits(size: np.ndarray, reach: np.ndarray, other: np.ndarray, its_reach: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can link, given the largest partner either can have."""
    alike = SHARE * np.maximum(size, other) <= PARTS * np.minimum(size, other)
    return alike & (other <= reach) & (size <= its_reach)


def _pairs(across: bool, parts_out: int):
    """Pairs with a signature in common. First each document with the smallest one that has the
    signature; once components are known, all pairs ``across`` two of them that sketches don't rule out."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        new_task("jaccard_join")
        expand = zstandard.ZstdDecompressor().decompress
        held = [np.frombuffer(b"".join(map(expand, rows[c])), np.int64) for c in ("docs", "labels", "sizes", "reaches")]
        sketches = np.frombuffer(b"".join(map(expand, rows["sketches"])), np.uint32).reshape(len(held[0]), -1)
        tables = [np.frombuffer(expand(x), np.int64) for x in rows["owners"]]
        begins = np.cumsum([0] + [int(t.max()) + 1 for t in tables])
        owners = np.concatenate([t + b for t, b in zip(tables, begins, strict=False)])
        marks = np.frombuffer(b"".join(rows["signatures"]), np.uint64)
        order = np.lexsort((held[0][owners], held[1][owners], marks))
        owners, marks = owners[order], marks[order]
        docs, labels, sizes, reaches = (x[owners] for x in held)

        def groups() -> tuple[np.ndarray, np.ndarray]:
            starts = np.flatnonzero(np.append(True, marks[1:] != marks[:-1])) if len(marks) else np.empty(0, np.int64)
            return starts, np.diff(np.append(starts, len(marks)))

        starts, counts = groups()
        if across and len(marks):
            # out with those that reach no size in their group: most copies too far from the others
            least = np.repeat(np.minimum.reduceat(sizes, starts), counts)
            near = reaches >= least
            docs, labels, sizes, reaches, owners, marks = (x[near] for x in (docs, labels, sizes, reaches, owners, marks))
            starts, counts = groups()
        if not len(marks):
            pairs = np.empty((0, 2), np.int64)
        elif not across:
            first = np.repeat(starts, counts)  # the smallest key, as rows of a signature stand in order of keys
            other = (docs != docs[first]) & fits(sizes, reaches, sizes[first], reaches[first])
            pairs = np.unique(np.stack([docs[first][other], docs[other]], axis=1), axis=0)
        else:
            several = np.flatnonzero((counts > 1) & (labels[starts] != labels[starts + counts - 1]))
            parts = [np.empty((0, 2), np.int64)]
            for s, n in zip(starts[several].tolist(), counts[several].tolist(), strict=True):
                d, lab, z, r, o = (x[s : s + n] for x in (docs, labels, sizes, reaches, owners))
                ends = np.searchsorted(lab, lab, side="right")  # partners are those with a later label
                for i in range(n):
                    j = np.arange(ends[i], n)
                    j = j[fits(z[j], r[j], z[i], r[i])]
                    common = np.minimum(sketches[o[j]], sketches[o[i]]).sum(axis=1, dtype=np.int64)
                    j = j[PARTS * common >= SHARE * (z[j] + z[i] - common)]
                    if len(j):
                        low, high = np.minimum(d[j], d[i]), np.maximum(d[j], d[i])
                        parts.append(np.stack([low, high], axis=1))
                if len(parts) > 1000:
                    parts = [np.unique(np.concatenate(parts), axis=0)]
            pairs = np.unique(np.concatenate(parts), axis=0)
        pairs = np.ascontiguousarray(pairs)
        part = (mix(mix(np.ascontiguousarray(pairs[:, 0]).view(np.uint64)) + np.ascontiguousarray(pairs[:, 1]).view(np.uint64)) % np.uint64(parts_out)).astype(np.int32)
        out = [(int(p), pairs[part == p].tobytes()) for p in np.unique(part)]
        return pd.DataFrame(out, columns=["part", "pairs"])

    return run


def _distinct(rows: pd.DataFrame) -> pd.DataFrame:
    """A pair comes from as many buckets as it has signatures in common; it is kept once."""
    pairs = np.unique(np.frombuffer(b"".join(rows["pairs"]), np.int64).reshape(-1, 2), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(PARTS * common >= SHARE * (len(both) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets reach the threshold. A set that many pairs name is joined last."""
    one = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("one"))
    two = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("two"))
    return staged(pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two").mapInArrow(_verified, "a long, b long"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, linked at a Jaccard similarity of 3/4.

    Rows with one set of shingles are one node, named by their smallest key. Near copies are first compared
    with the smallest key they share a signature with; then all pairs that share one and are not in one
    component yet. So no link between components is missed, though copies of one text are not all
    compared with each other. Shingles are compared as 64-bit hashes. A text without words has an empty set and is its
    own component; a null key has a null component. Rows with one key count as one node.
    """
    spark = docs.sparkSession
    buckets = 2 * partitions(spark)
    every = documents(docs, key, text)
    nodes = every.filter("candidate").groupBy("set1", "set2").agg(F.min("doc").alias("doc")).select("doc").distinct()
    versions = every.filter("candidate").join(nodes, "doc", "left_semi").select(*KEY, "reach").distinct()
    texts = packed(keyed(docs, key, text)).join(versions, KEY).select("doc", "reach", "text")
    sets = staged(texts.mapInArrow(_sets, "doc long, reach long, tokens binary").distinct())

    def pairs(labelled: DataFrame, across: bool) -> DataFrame:
        def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _signed(buckets, across, batches)

        rows = labelled.select("doc", "label", "reach", "tokens").mapInArrow(signed, SIGNED)
        found = rows.groupBy("bucket").applyInPandas(_pairs(across, buckets), "part int, pairs binary")
        return staged(found.groupBy("part").applyInPandas(_distinct, "a long, b long"))

    tried = pairs(sets.withColumn("label", F.col("doc")), across=False)
    linked = links(tried, sets)
    labels = staged(components(linked))
    labelled = sets.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    others = pairs(labelled.withColumn("label", F.coalesce("label", "doc")), across=True)
    more = links(others.join(tried, ["a", "b"], "left_anti"), sets)
    labels = staged(components(linked.union(more)))
    of_set = every.filter("n_shingles > 0").groupBy("set1", "set2").agg(F.min("doc").alias("node"))
    of_set = of_set.join(labels, "node", "left").select("set1", "set2", F.coalesce("label", "node").alias("label"))
    return every.join(of_set, ["set1", "set2"], "left").select(
        F.when(F.col("doc") != FIRST_KEY, F.col("doc")).alias("doc_id"),
        "n_shingles",
        F.when(F.col("doc") != FIRST_KEY, F.coalesce("label", "doc")).alias("component_id"),
    )
