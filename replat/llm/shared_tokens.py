"""Which hashed tokens of a document occur in a document of other content too.

Both the similarity join and the suffix sort begin with this: documents send the hashes of their tokens once, four
bytes each, and get back those that another document has. A hash that two tokens share lets a document through for
nothing; it never hides one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SENT = "bucket int, contents binary, sizes binary, tokens binary"
FOUND = "content long, tokens binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a fixed bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)


def sent(contents: np.ndarray, owner: np.ndarray, tokens: np.ndarray, buckets: int) -> Iterator[dict[str, object]]:
    """Rows for the shuffle: one for each bucket, with the tokens of all given documents in it.

    ``contents`` has a 64-bit name of each document's content, ``owner`` the index of each token's document. A
    document's tokens are distinct and stand together.
    """
    bucket = bucket_of(tokens, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
    short = (tokens[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    bucket, owner = bucket[order], owner[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    for a, b in zip(starts, [*starts[1:], len(bucket)], strict=False):
        own = owner[a:b]
        firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        sizes = np.diff(np.append(firsts, len(own))).astype(np.uint32)
        yield {"bucket": int(bucket[a]), "contents": contents[own[firsts]].tobytes(), "sizes": sizes.tobytes(), "tokens": short[a:b].tobytes()}


def _joined(parts: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=kind)


def found_elsewhere(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contents of a bucket that hold tokens of others, how many, and these tokens in the contents' order."""
    contents, sizes = _joined(rows["contents"], np.int64), _joined(rows["sizes"], np.uint32).astype(np.int64)
    tokens = _joined(rows["tokens"], np.uint32)
    if not len(tokens):
        return contents, sizes, sizes, tokens
    owner = np.repeat(np.arange(len(contents), dtype=np.int32), sizes)
    order = np.argsort(tokens)
    ordered, content = tokens[order], contents[owner[order]]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    several = np.minimum.reduceat(content, starts) != np.maximum.reduceat(content, starts)
    flag = np.empty(len(tokens), bool)
    flag[order] = np.repeat(several, np.diff(np.append(starts, len(tokens))))
    hits = np.add.reduceat(flag, np.cumsum(sizes) - sizes, dtype=np.int64)
    who = np.flatnonzero(hits)
    return contents[who], hits[who], np.cumsum(hits[who]), tokens[flag]


def _dealt_by_content(parts: int):
    """What a bucket found, as one row for each part of the contents."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        contents, hits, ends, tokens = found_elsewhere(rows)
        # copies of one content have the same tokens
        contents, once = np.unique(contents, return_index=True)
        hits, ends = hits[once], ends[once]
        part = (mix(contents.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        out = []
        for p in np.unique(part):
            mine = part == p
            taken = [tokens[e - n : e] for e, n in zip(ends[mine].tolist(), hits[mine].tolist(), strict=True)]
            out.append((int(p), contents[mine].tobytes(), hits[mine].astype(np.uint32).tobytes(), np.concatenate(taken).tobytes()))
        return pd.DataFrame(out, columns=["bucket", "contents", "sizes", "tokens"])

    return run


def _of_content(rows: pd.DataFrame) -> pd.DataFrame:
    contents, sizes = _joined(rows["contents"], np.int64), _joined(rows["sizes"], np.uint32).astype(np.int64)
    tokens = _joined(rows["tokens"], np.uint32)
    owner = np.repeat(contents, sizes)
    order = np.argsort(owner, kind="stable")
    owner, tokens = owner[order], tokens[order]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, np.int64)
    parts = [tokens[a:b].tobytes() for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(tokens)], strict=False)]
    return pd.DataFrame({"content": owner[starts], "tokens": pd.Series(parts, dtype=object)})


def in_other_content(rows: DataFrame, parts: int) -> DataFrame:
    """``content, tokens``: the tokens of each content that others hold, one row each; contents without any are out.

    ``rows`` are those of ``sent``. Documents with one content (exact copies) don't count for each other. A bucket
    holds a share of all tokens, and a part a share of all contents, that the caller keeps small by their number.
    """
    dealt = rows.groupBy("bucket").applyInPandas(_dealt_by_content(parts), SENT)
    return dealt.groupBy("bucket").applyInPandas(_of_content, FOUND)
