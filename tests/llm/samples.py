"""Small tables for the operators: random prose with copies, and the odd rows every operator has to take."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names the operators use for themselves
    "row string, doc string, version string, marks string, score string, shard string, tokens string, kept_text string"
)


def docs(spark, rows, partitions=3):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *(["x"] * 8)) for r in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(partitions)


def prose(rng, words, vocabulary=400):
    out = []
    for i in range(words):
        out.append("w" + str(rng.randrange(vocabulary)))
        out.append("\n" if rng.random() < 0.06 else " ")
    return "".join(out)


def odd_rows():
    """Null, empty and blank texts, one word, a long text, copies, a repeated row, no key, other scripts."""
    rng = random.Random(5)
    text = prose(rng, 90)
    return [
        (1, None), (2, ""), (3, " \n\t\x0b "), (4, "word"), (5, "a b c d"), (6, "x" * 30_000), (7, prose(rng, 9_000)),
        (8, text), (9, text), (10, text), (10, text), (None, text), (None, None), (11, "Ünï côdé 日本語 😀 " * 20),
        (12, "same words " * 200), (13, "l1 a\nl2 b\nl3 c\nl4 d\nl5 e"), (14, "z\nl1 a\nl2 b\nl3 c\nl4 d"),
        (15, "\n".join(["again and again"] * 12)), (16, "<|endoftext|> a <|startoftext|>b"), (17, text + " tail"),
    ]


def mixed_rows(n=120, seed=1):
    """Prose with near copies of different distance and shared passages."""
    rng = random.Random(seed)
    rows, texts = [], []
    passage = prose(rng, 60)
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.35:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(1, 1 + max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            text = " ".join(words)
        elif kind < 0.5:
            text = prose(rng, rng.randrange(5, 60)) + passage + prose(rng, rng.randrange(5, 60))
        else:
            text = prose(rng, rng.randrange(1, 150), 4000)
        texts.append(text)
        rows.append((i * 3 + 1, text))
    return rows


def union_find(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return root
