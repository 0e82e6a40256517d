"""Token counts by rank-synchronous merging of ragged arrays (operator 2)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from replat.llm.common import in_blocks, keyed_text, once

# The split pattern of byte-level vocabularies, and their characters for bytes. Printable
# characters stand for themselves, the others follow from 256 on.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = ((33, 126), (161, 172), (174, 255))

NONE = np.iinfo(np.int64).max
#: Pre-tokens a worker remembers before it forgets them all.
REMEMBERED = 1_000_000


def byte_characters() -> list[str]:
    kept = {b for first, last in PRINTABLE for b in range(first, last + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class Merges:
    """A byte-level vocabulary as sorted arrays: key of a symbol pair, its rank, the symbol it becomes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.becomes = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.of_byte = np.array([vocab[c] for c in byte_characters()], dtype=np.int64)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(SPLIT)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty pre-token when no pair can be merged.

        A merge only makes pairs of higher rank than its own, so all places of a sequence's lowest rank
        can be merged at once; of overlapping places (a run of one symbol) every second one is merged.
        """
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        left = sizes.copy()
        while len(symbols) > 1:
            rank = self.pair_ranks(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = NONE
            rank = np.append(rank, NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            merge = (rank == np.repeat(lowest, lengths)) & (rank != NONE)
            at = np.flatnonzero(merge)
            if not len(at):
                break
            follows = np.append(False, np.diff(at) == 1)
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.becomes[rank[at]]
            keep = np.repeat(lowest != NONE, lengths)  # finished sequences leave the arrays
            keep[at + 1] = False
            np.subtract.at(left, owner[at], 1)
            symbols, owner = symbols[keep], owner[keep]
        return left


def _counted(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merges: Merges = once(f"merges:{path}", lambda: Merges(path))
    known: dict[str, int] = once(f"merge-counts:{path}", dict)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        totals: list[int] = []
        for first, last in in_blocks(texts):
            found, extra = [], []
            for text in texts[first:last]:
                parts = merges.special.split(text) if merges.special else [text]
                extra.append(len(parts) - 1)
                tokens = merges.split.findall(parts[0])
                for part in parts[1:]:
                    tokens += merges.split.findall(part)
                found.append(tokens)
            if len(known) > REMEMBERED:
                known.clear()
            new = list(set().union(*found).difference(known))
            for i in range(0, len(new), 100_000):
                some = new[i : i + 100_000]
                known.update(zip(some, merges.counts([t.encode() for t in some]).tolist(), strict=True))
            count = known.__getitem__
            totals += [sum(map(count, tokens)) + n for tokens, n in zip(found, extra, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(totals, pa.int64()),
            ],
            ["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """UTF-8 bytes and tokens of every text, as the vocabulary's own library counts them.

    ``vocabulary`` is the path of a byte-level BPE file on every machine. One row for each input row (rows
    with equal keys stay apart); a null or empty text has 0 tokens; the strings of added tokens count as one
    token each. A text without spaces is one long sequence; it takes more rounds, nothing is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(vocabulary, batches)

    return keyed_text(docs, key, text).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
