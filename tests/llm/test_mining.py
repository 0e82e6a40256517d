from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from replat.llm import hard_negatives, phrases, posting_lists
from replat.llm.hard_negatives import Negatives
from replat.llm.phrases import Mining
from replat.llm.posting_lists import Index


def pieces_of(text):
    for c in ".,;:!?\n\x0b\x0c\r":
        text = text.replace(c, "\n")
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in text.split("\n")]


def phrases_of(rows, m):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = (r[2] if len(r) > 2 else "en") or "und"
        for w in pieces_of(r[1] or ""):
            n[lang] += len(w)
            for k in range(1, m.longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= m.support}
        gone = {d[i:j] for d, a in candidates.items() for i in range(len(d)) for j in range(i + 2, len(d) + 1)
                if j - i < len(d) and 100 * a >= m.absorb * candidates[d[i:j]]}
        rows_ = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(math.floor(Fraction(1000 * a * n[lang], counts[p[:k]] * counts[p[k:]])), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[: m.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("block_words", [7, 60, 1_000_000])
@pytest.mark.parametrize("absorb", [100, 60])
def test_phrases_equal_brute_force(spark, block_words, absorb):
    rng = random.Random(8)
    rows = samples.odd_rows() + [(100 + i, samples.prose(rng, rng.randrange(0, 90), 9).replace(" ", rng.choice([" ", "\t ", ", "]), 3)) for i in range(40)]
    rows += [(300 + i, "New York, new york; NEW YORK! Äpfel Äpfel\rx y z x y z", lang) for i, lang in enumerate(["de", None, "und", "de"])]
    m = Mining(support=3, absorb=absorb, top=40, block_words=block_words)
    got = phrases.collocations(samples.docs(spark, rows), m)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", "bigint", "bigint", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, got.collect())) == phrases_of(rows, m)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(samples.docs(spark, []), Mining()).count() == 0
    assert phrases.collocations(samples.docs(spark, [(1, None), (2, ""), (3, ".,;")]), Mining(support=1)).count() == 0


def test_long_texts_are_read_some_at_a_time():
    text = b"ab  cd\nef " * 1000
    whole = [t for t in text.replace(b"\n", b" \n ").split(b" ") if t]
    assert [t for some in phrases.tokens(text, 37) for t in some if t] == whole


SHAPE = "vec_id long, embedding array<float>, label int, score string, rank string, size string, list string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, *["x"] * 4) for i, v, label in rows], SHAPE).repartition(3)


ODD = [
    (1000, None, 1), (1050, [], 1), (1100, [0.0] * 8, 1), (1150, [float("nan")] + [1.0] * 7, 1), (1200, [None] + [1.0] * 7, 1),
    (1250, [float("inf")] + [0.1] * 7, 1), (None, [0.5] * 8, 1), (1300, [0.5] * 8, None), (1350, [0.5] * 3, 1), (1400, [0.25] * 3, 2),
    (1450, [0.75] * 3, 1), (1500, [0.375] * 3, 1),
]


def vectors(n, seed=3, dims=8, copies=0.3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[rng.random(n) < copies] = x[7]
    return [(int(i), x[i].tolist(), int(rng.integers(0, 4))) for i in range(n)]


def negatives_of(rows, r, anchors):
    use = [(i, [math.floor(r.scale * x) for x in v], label) for i, v, label in dict.fromkeys((i, tuple(v), label) for i, v, label in rows if ok(i, v) and label is not None)]
    out = []
    for i, v, label in use:
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other == label) for j, w, other in use if j != i and len(w) == len(v))
        for s, j, same in [x for x in scored if x[2]][: r.positives]:
            fits = [x for x in scored if not x[2] and r.low * -s <= 100 * -x[0] <= r.high * -s][: r.negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(fits, 1)]
    return sorted(out)


def ok(i, v):
    return i is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize(("shard_values", "block", "step"), [(100, 3, 2), (1 << 20, 1000, 64)])
def test_negatives_equal_brute_force(spark, shard_values, block, step):
    rows = vectors(300) + ODD + vectors(300)[:5]
    r = Negatives(scale=16, shard_values=shard_values, block_anchors=block, step=step)
    got = hard_negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, r).collect()
    wanted = negatives_of(rows, r, lambda i: i % 10 == 0)
    assert len(wanted) > 100 and sorted(map(tuple, got)) == wanted


def test_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(table(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(table(spark, [(0, [1e30] * 4, 1), (1, [1e30] * 4, 2)]), F.col("vec_id") % 10 == 0).count() == 0


def test_lists_stop_once_the_threshold_is_below():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, size=(5000, 3))
    order = np.argsort(x, axis=0, kind="stable").astype(np.int32).T.copy()
    lists = hard_negatives.Lists(hard_negatives.stored(x=x.astype(np.int32), order=order, ids=np.arange(5000), labels=np.zeros(5000, np.int64)))
    for anchor in (np.array([3, -2, 1]), np.array([0, 0, -4]), np.array([0, 0, 0])):
        best, met = hard_negatives.Best(5), 0
        for rows, scores, threshold in lists.walk(anchor, 8):
            best.take(scores, rows)
            met += len(rows)
            if threshold is None or best.settled(threshold):
                break
        true = np.lexsort((np.arange(5000), -(x @ anchor)))[:5]
        assert best.ids.tolist() == true.tolist() and (met < 4000 or not anchor.any())


def test_scores_stay_exact_when_large(spark):
    big = 16_000_000.0 / 256
    rows = [(0, [big, big, 1.0], 1), (1, [big, big, 0.0], 1), (2, [big, big, -1.0], 1), (3, [big / 2, big, 1.0], 2), (4, [big / 2, big, 1.5], 2)]
    got = sorted(map(tuple, hard_negatives.hard_negatives(table(spark, rows), F.col("vec_id") == 0).collect()))
    assert got == negatives_of(rows, Negatives(), lambda i: i == 0) and len(got) == 4


def nearest_of(rows, k, asks):
    use = list(dict.fromkeys((i, tuple(v)) for i, v, _ in rows if ok(i, v) and any(v)))
    out = {}
    for i, v in use:
        if asks(i):
            scored = sorted((-float((np.array(v) * np.array(w)).sum()), j) for j, w in use if j != i and len(v) == len(w))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_nearest_equal_brute_force_when_all_lists_are_read(spark):
    rows = vectors(400) + ODD + vectors(400)[:5]
    index = Index(k=5, list_rows=20, part_rows=16, recall=1.0, audited=10_000, first_lists=2)
    lists, _ = posting_lists.indexed(table(spark, rows), F.col("vec_id") % 10 == 0, index)
    assert len(lists.graphs[8].centres) > 5
    lists.ratio = 1e9
    got = defaultdict(list)
    for q, rank, j, score in sorted(map(tuple, lists.neighbours().collect())):
        got[q].append((j, score))
        assert rank == len(got[q])
    wanted = nearest_of(rows, 5, lambda i: i % 10 == 0)
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in wanted.items() if x}
    assert all(math.isclose(a[1], b[1], rel_tol=1e-12) for q in got for a, b in zip(got[q], wanted[q], strict=True))


def test_nearest_recall_and_boundaries(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12)) * 3
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 12))).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    index = Index(k=10, list_rows=100, audited=60, recall=0.95)
    lists, other = posting_lists.indexed(table(spark, rows), F.col("vec_id") % 20 == 0, index)
    asked = [r["query_id"] for r in lists.asking.collect()]
    sizes = [r["count"] for r in lists.member.groupBy("list").count().collect()]
    assert lists.member.select("rep").distinct().count() == 4000 < lists.member.count() and max(sizes) < 8 * np.mean(sizes)
    q, row, _ = posting_lists.best_of(x[asked].astype(float), x.astype(float), np.arange(4000), 11)
    true = {(asked[a], int(b)) for a, b in zip(q, row, strict=True) if asked[a] != b}
    got = {(r["query_id"], r["vec_id"]) for r in lists.neighbours().collect()}
    assert len(got & true) >= 0.9 * len(got) and len(got) == 10 * len(asked)
    assert lists.measured(other) >= 0.9
    read = sum(len(lists.graphs[12].within(lists.graphs[12].ask(x[asked].astype(float)), lists.ratio, 32)[0]) for _ in range(1))
    assert read < 0.8 * len(asked) * len(lists.graphs[12].centres)


def test_nearest_of_nothing(spark):
    assert posting_lists.nearest_vectors(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert posting_lists.nearest_vectors(table(spark, [(20, [1.0, 0.0], 1)]), F.col("vec_id") % 20 == 0).count() == 0
    assert posting_lists.nearest_vectors(table(spark, [(21, [1.0, 0.0], 1)]), F.col("vec_id") % 20 == 0).count() == 0
