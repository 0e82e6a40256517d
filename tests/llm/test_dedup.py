from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import samples
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from replat.llm import components, jaccard_join, line_runs, suffix_dedup, vector_links

FIRST = -(2**63)


def keyed(rows):
    """(key, text) with a null key first; equal rows are one document."""
    return [(FIRST if k is None else k, t or "") for k, t in rows]


# ---------------------------------------------------------------- components


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=90))
def test_components_equal_union_find(spark, pairs):
    pairs = [p for p in pairs if p[0] != p[1]]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    root = samples.union_find(pairs)
    got = {r["node"]: r["label"] for r in components.components(df).collect()}
    assert got == {x: root(x) for p in pairs for x in p}


def test_a_long_chain_and_a_large_star(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)]
    random.Random(2).shuffle(pairs)
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[2000 + i] for i in range(300)} == {1000}


# ---------------------------------------------------------------- lines


def brute_lines(rows, size):
    docs = sorted(set(keyed(rows)))
    split = {d: [x for x in d[1].split("\n") if line_runs.WORD.search(x)] for d in docs}
    places = defaultdict(list)
    for d in docs:
        for i in range(len(split[d]) - size + 1):
            places[tuple(split[d][i : i + size])].append((d, i))
    out = {}
    for d in docs:
        gone = set()
        for i in range(len(split[d]) - size + 1):
            same = places[tuple(split[d][i : i + size])]
            keys = Counter(p[0][0] for p in same)
            first = same[0]
            if keys and (first[0] != d or i - first[1] >= size):
                gone |= set(range(i, i + size))
        kept = [x for i, x in enumerate(split[d]) if i not in gone]
        out[d] = len(split[d]), len(gone), kept
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, size):
    rng = random.Random(size)
    rows = samples.odd_rows() + [(50 + i, "\n".join(rng.choice("abc") if rng.random() < 0.9 else "" for _ in range(rng.randrange(1, 14)))) for i in range(40)]
    out = line_runs.line_dedup(samples.docs(spark, rows), size).select("row.doc_id", "row.text", "n_lines", "n_removed", "kept_text", "kept_sha256").collect()
    want = brute_lines(rows, size)
    assert len(out) == len(rows)
    for r in out:
        lines, removed, kept = want[(FIRST if r["doc_id"] is None else r["doc_id"], r["text"] or "")]
        assert (r["n_lines"], r["n_removed"]) == (lines, removed)
        assert [x for x in r["kept_text"].split("\n") if line_runs.WORD.search(x)] == kept
        assert r["kept_sha256"] == hashlib.sha256(r["kept_text"].encode()).hexdigest()
        assert removed or r["kept_text"] == (r["text"] or "")
    assert line_runs.line_dedup(samples.docs(spark, []), size).count() == 0


def brute_copied_runs(rows, least):
    """Lines in runs of any length that hold ``least`` words and that an earlier, not overlapping run equals."""
    docs = sorted(set(keyed(rows)))
    split = [[x for x in t.split("\n") if line_runs.WORD.search(x)] for _, t in docs]
    first, out = {}, {}
    for d, lines in enumerate(split):
        for i in range(len(lines)):
            for n in range(1, len(lines) - i + 1):
                first.setdefault(tuple(lines[i : i + n]), (d, i))
    for d, lines in enumerate(split):
        gone = set()
        for i in range(len(lines)):
            for n in range(1, len(lines) - i + 1):
                run = lines[i : i + n]
                at = first[tuple(run)]
                if sum(len(line_runs.PIECE.findall(x)) for x in run) >= least and (at[0] != d or i - at[1] >= n):
                    gone |= set(range(i, i + n))
        out[docs[d]] = len(gone), [x for i, x in enumerate(lines) if i not in gone]
    return out


@pytest.mark.parametrize("least", [1, 3, 4, 9])
def test_copied_runs_go_by_their_words_however_few_lines_they_have(spark, least):
    rng = random.Random(least)
    kinds = ["a", "b", "c d", "e f g", "one two three four five", "日本語の文は空白なしで書かれるので長い一行でも一語になる"]
    lines = [[rng.choice(kinds) if rng.random() < 0.9 else "" for _ in range(rng.randrange(1, 12))] for _ in range(40)]
    boiler = " ".join(f"boilerplate{i}" for i in range(60))
    rows = [(100 + i, "\n".join(x)) for i, x in enumerate(lines)]
    rows += [(300 + i, f"own line number {i}\n{boiler}") for i in range(20)] + [(400, boiler), (401, f"{boiler}\n{boiler}")]
    rows += [r for r in samples.odd_rows() if r[0] != 7]
    rows = [(k, t) for k, t in rows if (t or "").count("\n") < 60]
    want = brute_copied_runs(rows, least)
    out = line_runs.line_dedup(samples.docs(spark, rows), min_words=least).select("row.doc_id", "row.text", "n_removed", "kept_text").collect()
    assert len(out) == len(rows)
    for r in out:
        removed, kept = want[(FIRST if r["doc_id"] is None else r["doc_id"], r["text"] or "")]
        assert (r["n_removed"], [x for x in r["kept_text"].split("\n") if line_runs.WORD.search(x)]) == (removed, kept)
    if least == 3:  # what the registered query takes
        default = line_runs.line_dedup(samples.docs(spark, rows)).select("row.doc_id", "n_removed").collect()
        assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in default) == sorted((r["doc_id"] or 0, r["n_removed"]) for r in out)
        assert sum(boiler in r["kept_text"] for r in out) == 1


# ---------------------------------------------------------------- suffixes


def brute_strings(rows, size):
    docs = sorted(set(keyed(rows)))
    least = {}
    for key, text in docs:
        raw = text.encode()
        for i in range(len(raw) - size + 1):
            least.setdefault(raw[i : i + size], key)
    out = {}
    for key, text in docs:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if least[raw[i : i + size]] < key:
                gone[i : i + size] = b"\1" * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key, text] = sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_brute_force(spark, seed):
    rows = samples.mixed_rows(90, seed) + [(5000 + (k or 0) if k else None, t) for k, t in samples.odd_rows() if len(t or "") < 20_000]
    rows += [(9000, "ab" * 60), (9001, "b" + "ab" * 80), (9002, "é" * 40), (9003, "xé" + "é" * 60), (9003, "other version " * 9), (9004, "other version " * 9)]
    table, want = samples.docs(spark, rows), brute_strings(rows, 50)
    out = suffix_dedup.suffix_dedup(table, whole_characters=False).select("row.doc_id", "row.text", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert len(out) == len(rows)
    for r in out:
        removed, spans, kept = want[FIRST if r["doc_id"] is None else r["doc_id"], r["text"] or ""]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len((r["text"] or "").encode()), removed, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    texts = suffix_dedup.suffix_dedup(table).select("kept_text", "n_removed", "row.text").collect()
    assert all(len(r["kept_text"].encode()) + r["n_removed"] == len((r["text"] or "").encode()) for r in texts)
    assert suffix_dedup.suffix_dedup(samples.docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=12, max_size=120), st.integers(2, 10))
def test_suffix_classes_are_equal_strings(bits, size):
    content = np.array(bits, np.uint8)
    at = np.arange(len(content) - size + 1)
    group = at % 2
    group_sorted = np.argsort(group, kind="stable")
    classes = suffix_dedup.suffix_classes(content, at[group_sorted], group[group_sorted], size)
    strings = [(int(g), content[i : i + size].tobytes()) for g, i in zip(group[group_sorted], at[group_sorted], strict=True)]
    assert len(set(zip(classes.tolist(), strings, strict=True))) == len(set(classes.tolist())) == len(set(strings))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=90), max_size=6), st.integers(16, 24))
def test_anchors_are_least_hashed_pieces(texts, size):
    raw = [t.encode() for t in texts]
    found = suffix_dedup.anchored(raw, size)
    want = []
    for who, t in enumerate(raw):
        marks = suffix_dedup.mark_of(np.frombuffer(t, np.uint8), np.arange(max(len(t) - suffix_dedup.GRAM + 1, 0))).tolist()
        for start in range(len(t) - size + 1):
            place = min(range(start, start + size - suffix_dedup.GRAM + 1), key=lambda p: (marks[p], p))
            if want and want[-1][0] == who and want[-1][3] == place:
                want[-1][2] = start
            else:
                want.append([who, start, start, place, marks[place]])
    columns = (found.owner, found.first, found.last, found.place, found.mark)
    assert [list(x) for x in zip(*(c.tolist() for c in columns), strict=True)] == want


def test_hash_collisions_are_caught(monkeypatch):
    monkeypatch.setattr(suffix_dedup.Prefixes, "pieces", lambda self, at, length: np.zeros(len(at), np.uint64))
    content = np.frombuffer(b"abcabdabcxyz", np.uint8)
    at = np.array([0, 3, 6, 9])
    classes = suffix_dedup.suffix_classes(content, at, np.zeros(4, np.int64), 3)
    assert classes[0] == classes[2] and len(set(classes.tolist())) == 3


@pytest.mark.parametrize("collide", [False, True])
@settings(max_examples=60, deadline=None)
@given(content=st.text("ab", min_size=1, max_size=60), places=st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(0, 2)), min_size=1, max_size=25))
def test_suffixes_are_in_order_to_either_side(collide, content, places):
    raw, n = content.encode(), len(content)
    at, sizes, group = (np.array(x) for x in zip(*[(i % n, min(k, n - i % n), g) for i, k, g in places], strict=True))
    array = np.frombuffer(raw, np.uint8)
    with pytest.MonkeyPatch.context() as patch:
        if collide:
            patch.setattr(suffix_dedup.Prefixes, "pieces", lambda self, at, length: np.zeros(len(at), np.uint64))
        after = suffix_dedup.suffix_order(array, at, sizes, group)
        before = suffix_dedup.suffix_order(array[::-1], n - at, sizes, group, before=True)
    strings = [raw[i : i + k] for i, k in zip(at.tolist(), sizes.tolist(), strict=True)]
    want = sorted(range(len(at)), key=lambda i: (group[i], strings[i]))
    for order, common in (after, before):
        assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
        pairs = zip(order[:-1], order[1:], strict=True)
        assert common.tolist() == [-1] + [len(os.path.commonprefix([strings[i], strings[j]])) if group[i] == group[j] else -1 for i, j in pairs]


def test_copies_come_from_sorting_what_surrounds_an_anchor(monkeypatch):
    line = "a line of some length that many of the documents have"
    texts = [f"{i:040d} {line}{' twice' * (i % 3)} {i * 7919:040d}".encode() for i in range(40)]
    marks = [suffix_dedup.anchored([t], 50).mark for t in texts]
    batch = pa.RecordBatch.from_pydict({
        "doc": list(range(40)), "version": list(range(40)), "text": [zstandard.compress(t) for t in texts],
        "tokens": [np.unique(m & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for m in marks],
    })
    rows = pa.Table.from_batches(suffix_dedup._snippets(1, 50, iter([batch]))).to_pandas()
    items, inner = [], suffix_dedup.merge_sorted
    monkeypatch.setattr(suffix_dedup, "merge_sorted", lambda order, *rest: items.append(len(order)) or inner(order, *rest))
    out = suffix_dedup._copies(50)(rows)
    found = {(doc, i) for doc, ranges in zip(out["doc"], out["ranges"], strict=True) for a, b in ranges.reshape(-1, 2) for i in range(a, b + 1)}
    least = {}
    for doc, t in enumerate(texts):
        for i in range(len(t) - 49):
            least.setdefault(t[i : i + 50], doc)
    assert found == {(doc, i) for doc, t in enumerate(texts) for i in range(len(t) - 49) if least[t[i : i + 50]] < doc}
    # once for each side, not once for each string over the anchor
    assert 0 < sum(items) <= 2 * len(suffix_dedup.expanded(rows, "sizes"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=60))
def test_mergesort_within_groups(items):
    items.sort(key=lambda x: x[0])
    group, value = (np.array(x) for x in zip(*items, strict=True))
    order = suffix_dedup.merge_sorted(np.arange(len(items)), group, lambda a, b: value[a] < value[b])
    assert [(items[i][0], items[i][1], i) for i in order] == sorted((g, v, i) for i, (g, v) in enumerate(items))


# ---------------------------------------------------------------- Jaccard


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    rows = samples.mixed_rows(140, seed) + [(9000 + k, t) for k, t in samples.odd_rows() if k is not None]
    rows += [(9500 + i, f"a b c d e f g h i j {i}") for i in range(4)] + [(9600, "A b"), (9601, "a B"), (9602, "a")]
    sets = {k: shingles(t) for k, t in rows}
    names = sorted(sets)
    pairs = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    root = samples.union_find(pairs)
    out = jaccard_join.jaccard_components(samples.docs(spark, [*rows, (None, "a b c d e f"), (None, None)])).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root(r["doc_id"]))
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    assert jaccard_join.jaccard_components(samples.docs(spark, [])).count() == 0


def test_copies_linked_only_through_a_third(spark):
    """Two texts that don't link with the smallest key of their signatures, but with each other."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(30):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(200)] = f"e{i}_{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(words)))
    far = list(base)
    for k in range(0, 60, 9):
        far[k] = f"far{k}"
    rows += [(1, " ".join(far)), (500, " ".join([*far[:100], "y", *far[101:]]))]
    sets = {k: shingles(t) for k, t in rows}
    root = samples.union_find([(a, b) for a in sets for b in sets if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(samples.docs(spark, rows)).collect()}
    assert got == {k: root(k) for k in sets}


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 120), st.integers(0, 40), st.integers(0, 40), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(size, fewer, more, seed):
    rng = np.random.default_rng(seed)
    tokens = rng.integers(0, 2**62, size + more).astype(np.uint64)
    x, y = np.unique(tokens[:size]), np.unique(np.concatenate([tokens[min(fewer, size) : size], tokens[size:]]))
    common = len(np.intersect1d(x, y))
    if len(y) and 4 * common >= 3 * (len(x) + len(y) - common):
        assert len(np.intersect1d(jaccard_join.signatures(x), jaccard_join.signatures(y)))


# ---------------------------------------------------------------- vectors


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 0, 1) for k, v in rows], "vec_id long, embedding array<float>, label int, rep long").repartition(3)


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    rows = [(i * 2, v.tolist()) for i, v in enumerate(base)]
    for i in range(260):  # copies at many distances, a large group among them
        source = base[i % 40 if i % 3 else 7]
        rows.append((1000 + i, (source + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.15, 0.25])).tolist()))
    rows += [(3000, rows[0][1]), (3001, rows[0][1]), (3002, [2 * x for x in rows[1][1]])]
    odd = [(4000, None), (4001, []), (4002, [0.0] * 16), (4003, [float("nan")] + [1.0] * 15), (4004, [float("inf")] * 16), (4005, [None] + [1.0] * 15), (4006, [1.0, 2.0]), (4007, [2.0, 4.0])]
    search = vector_links.Search(shards=3, block_rows=150, beam=16, build_beam=32, degree=8)
    table = vectors(spark, rows + odd + [(None, rows[0][1]), rows[5]])
    out = vector_links.vector_links(table, search).collect()
    x = np.array([np.array(v, np.float32) for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    ids = [k for k, _ in rows]
    root = samples.union_find([(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)])
    got = {r["vec_id"]: r for r in out if r["vec_id"] is not None}
    assert len(out) == len(rows) + len(odd) + 2
    found, wanted = sum(got[k]["n_links"] for k in ids), int(linked.sum())
    assert 0.99 * wanted <= found <= wanted
    assert all(got[k]["n_links"] <= n for k, n in zip(ids, linked.sum(axis=1).tolist(), strict=True))
    assert sum(got[k]["component_id"] == root(k) for k in ids) >= 0.99 * len(ids)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all((got[k]["n_links"], got[k]["component_id"]) == (0, k) for k in range(4000, 4006))
    assert (got[4006]["n_links"], got[4007]["component_id"]) == (1, 4006)
    null = next(r for r in out if r["vec_id"] is None)
    assert (null["n_links"], null["component_id"], null["kept"]) == (0, None, False)
    assert vector_links.vector_links(table.limit(0)).count() == 0


def test_graph_finds_neighbours():
    rng = np.random.default_rng(1)
    x = vector_links.unit(__import__("pandas").Series(list(rng.normal(size=(1500, 24)))))
    builder = vector_links.Builder(x, vector_links.Search())
    graph = builder.build()
    ids, _ = graph.search(x[:300].astype(np.float32), 48)
    best = (x[:300].astype(np.float32) @ graph.vectors.T).argmax(axis=1)
    assert (ids[:, 0] == best).mean() >= 0.97


def test_no_value_holds_a_whole_graph(spark, monkeypatch):
    """A graph is kept in rows of a bounded number of vectors, whatever their number in its shard."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, (v + 0.02).tolist()) for i, v in enumerate(base[:100])]
    rows += [(2000 + i, rng.normal(size=3).tolist()) for i in range(40)]
    kept, stage = [], vector_links.staged
    monkeypatch.setattr(vector_links, "staged", lambda df, **options: kept.append(stage(df, **options)) or kept[-1])
    out = vector_links.vector_links(vectors(spark, rows), vector_links.Search(shards=2, shard_rows=100, block_rows=20, beam=150)).collect()
    binary = [(df, name) for df in kept for name, kind in df.dtypes if kind == "binary"]
    assert binary and max(df.selectExpr(f"max(octet_length({name}))").first()[0] for df, name in binary) < 8_000
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    wanted = {}
    for size in (16, 3):
        ids = [k for k, v in rows if len(v) == size]
        x = np.array([np.array(v, np.float32) for _, v in rows if len(v) == size], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        linked = x @ x.T >= 0.95
        np.fill_diagonal(linked, False)
        root = samples.union_find([(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)])
        wanted |= {k: (int(n), root(k)) for k, n in zip(ids, linked.sum(axis=1), strict=True)}
    assert got == wanted


def test_shards_are_bounded_by_bytes():
    search = vector_links.Search()
    assert search.shards_of(50_000, 256) == search.shards
    for rows, size in ((15_000_000, 256), (2_000_000, 3072), (1_000_000, 8)):
        assert -(-rows // search.shards_of(rows, size)) <= min(search.shard_rows, -(-search.shard_bytes // size))


def test_any_length_in_either_precision(spark):
    """Vectors too large or small to be squared in their own type, and such in double precision."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 8))
    for kind, top, low in (("float", 1e37, 1e-37), ("double", 1e300, 1e-300)):
        rows = [(3 * i + j, (v * by).tolist()) for i, v in enumerate(base) for j, by in enumerate((1.0, top, low))]
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = {r["vec_id"]: r for r in vector_links.vector_links(table, vector_links.Search(shards=2)).collect()}
        x = base / np.linalg.norm(base, axis=1, keepdims=True)
        near = (x @ x.T >= 0.95).sum(axis=1)
        assert all(got[3 * i + j]["n_links"] == 3 * near[i] - 1 for i in range(60) for j in range(3))


def test_search_finds_no_node_twice():
    x = vector_links.unit(__import__("pandas").Series(list(np.random.default_rng(2).normal(size=(1500, 6)))))
    graph = vector_links.Builder(x.copy(), vector_links.Search(threshold=0.9999)).build()
    queries = x[np.argsort(-(x @ x[0]))[:400]].astype(np.float32)  # those around the first node
    ids, _ = graph.search(queries, 40)
    assert all(len(set(row[row >= 0].tolist())) == (row >= 0).sum() for row in ids)


def test_members_go_behind_nodes():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 12))
    x = np.concatenate([base, base[rng.integers(0, 300, 900)] + rng.normal(size=(900, 12)) * 0.02])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(1200)].astype(np.float32)
    builder = vector_links.Builder(x.copy(), vector_links.Search())
    m = builder.build().size
    assert m < 400 and (np.sort(builder.order) == np.arange(1200)).all() and (builder.all == x[builder.order]).all()
    assert (builder.node_of[:m] == np.arange(m)).all()
    assert (np.einsum("nd,nd->n", builder.all, builder.all[builder.node_of]) >= np.cos(vector_links.Search().radius) - 1e-5).all()


def test_forests_one_after_another_connect_the_same():
    import pandas as pd

    rng = np.random.default_rng(5)
    parts = [pd.DataFrame(rng.integers(0, 400, (25, 2)), columns=["a", "b"]) for _ in range(20)]
    made = list(components._forest(iter(parts), held=40))
    links = [(a, b) for p in parts for a, b in p.to_numpy().tolist()]
    one, other = samples.union_find(links), samples.union_find([(a, b) for p in made for a, b in p.to_numpy().tolist()])
    nodes = {x for link in links for x in link}
    assert len(made) > 3 and max(map(len, made)) <= 100 and all(one(x) == other(x) for x in nodes)


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """What goes to workers holds the code it calls: it runs where the package can't be imported."""
    import pickle
    import subprocess
    import sys

    from pyspark import cloudpickle

    from replat.llm import hard_negatives, phrases, posting_lists

    held = [jaccard_join.signatures, hard_negatives.Lists, phrases.tokens, posting_lists.best_of]
    (tmp_path / "held").write_bytes(cloudpickle.dumps(held))
    code = (
        "import pickle, sys, numpy as np; sys.path = [p for p in sys.path if 'repo' not in p]\n"
        "signatures, lists, tokens, best = pickle.load(open('held', 'rb'))\n"
        "print(len(signatures(np.arange(40, dtype=np.uint64))), list(tokens(b'a b')), 'replat' in sys.modules)"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True, check=True)
    assert out.stdout.split()[0] != "0" and out.stdout.strip().endswith("False")
    assert pickle.loads(cloudpickle.dumps(jaccard_join.band))(7) == jaccard_join.band(7)
