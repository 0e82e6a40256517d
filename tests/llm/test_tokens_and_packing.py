from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import zlib

import numpy as np
import pytest
import samples
from hypothesis import given, settings
from hypothesis import strategies as st

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from replat.llm import packing, piece_bpe, token_counts  # noqa: E402

JSON, RANKS, WORDS = (public.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
ODD = [
    *(r[1] for r in samples.odd_rows() if r[1]), "it's I'LL we're  123,456 \r\n\t x", "aaaaaaaaaaaaaaaaaaaa" * 9,
    "".join(chr(c) + (" " if c % 5 == 0 else "") for c in range(1, 0x2100)), "a\x1cb\x1d c\x85d\xa0e", "é e\u0301 ΑΣ ΣΑΣ İ ﬁ",
]


def plain():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(JSON)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(900, None), (901, ""), (902, "twice"), (902, "twice"), (None, "no key")]
    out = token_counts.token_counts(samples.docs(spark, rows), JSON).collect()
    want = sorted(((i or -1), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert token_counts.token_counts(samples.docs(spark, []), JSON).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=60))
def test_merging_equals_the_library(text):
    merges, library = cached("merges", lambda: token_counts.Merges(JSON)), cached("library", lambda: Tokenizer.from_file(JSON))
    found = merges.split.findall(text)
    n = int(merges.counts([t.encode() for t in found]).sum()) if found else 0
    assert n == len(library.encode(text, add_special_tokens=False).ids)


MADE = {}


def cached(name, make):
    return MADE.setdefault(name, None) or MADE.update({name: make()}) or MADE[name]


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=60))
def test_piece_model_round_trip(text):
    import regex

    codec, library = cached("codec", lambda: piece_bpe.Codec(RANKS)), cached("plain", plain)
    ids = piece_bpe.encode_text(codec, regex.compile(public.PATTERN), text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_encoding_equals_the_library_and_decodes(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(900, None), (901, ""), (902, "twice"), (902, "twice")]
    table, library = samples.docs(spark, rows), plain()
    ids = piece_bpe.encoded(table, RANKS, public.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in rows}
    back = {r["doc_id"]: bytes(r["content"]) for r in piece_bpe.decoded(ids, RANKS).collect()}
    assert back == {i: (t or "").encode() for i, t in rows}
    for r in piece_bpe.coded_digests(table, RANKS, public.PATTERN).collect():
        text = dict(rows)[r["doc_id"]] or ""
        wanted = library.encode_ordinary(text)
        assert r["n_tokens"] == len(wanted)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert piece_bpe.coded_digests(samples.docs(spark, []), RANKS, public.PATTERN).count() == 0


def test_word_ids_equal_the_library():
    library, codec = Tokenizer.from_file(WORDS), packing.WordCodec(WORDS)
    for text, ids in zip(ODD, codec.encode(ODD), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing_is_complete_tight_and_whole(spark):
    rows = samples.mixed_rows(150) + [(10_000 + i, t) for i, (_, t) in enumerate(samples.odd_rows())]
    rows += [(None, "no key"), (20_000, "twice"), (20_000, "twice")]
    options = {"capacity": 256, "shard_tokens": 4000, "merged": 8}
    out = packing.packed(samples.docs(spark, rows), WORDS, **options).toPandas()
    library = Tokenizer.from_file(WORDS)
    want = []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want.append((key if key is not None else -1, k, at, len(part), zlib.crc32(part.tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out.fillna({"doc_id": -1})[columns].astype("int64").to_numpy().tolist())) == sorted(want)
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        ends = np.cumsum(part["length"].to_numpy())
        assert ends[-1] <= 256
        assert part["offset"].tolist() == [0, *ends[:-1].tolist()]
    least = -(-int(out["length"].sum()) // 256)
    assert out["sequence_id"].nunique() <= least * 1.03 + 2
    assert packing.packed(samples.docs(spark, []), WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_pack_fits_and_wastes_little(lengths):
    sequence, offset = packing.pack(np.array(lengths, np.int64), 64)
    fill = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths, strict=True)):
        assert o == fill.get(s, 0)
        fill[s] = o + n
    assert all(v <= 64 for v in fill.values())
    assert sum(v <= 32 for v in fill.values()) <= 1 or not any(n <= 16 for n in lengths)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize(("low", "high", "over"), [(200, 4096, 1.01), (1025, 3000, 1.01), (1025, 4096, 1.08), (1100, 1500, 1.055)])
def test_long_documents_take_few_sequences(low, high, over):
    """Against best fit, and the volume bound (which the longest and the shortest ranges can't come near)."""
    lengths = np.random.default_rng(low + high).integers(low, high + 1, 20_000)
    sequence, _ = packing.pack(lengths, 4096)
    assert np.bincount(sequence, weights=lengths).max() <= 4096
    used, bound = int(sequence.max()) + 1, -(-int(lengths.sum()) // 4096)
    assert used <= best_fit_decreasing(lengths.tolist(), 4096) and used <= over * bound


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(17, 64), min_size=1, max_size=5, unique=True), st.data())
def test_the_mix_of_configurations_is_the_best(sizes, data):
    wanted = [data.draw(st.integers(1, 9)) for _ in sizes]
    sizes = sorted(sizes)
    configs = [c for n in (1, 2, 3) for c in itertools.combinations_with_replacement(range(len(sizes)), n) if sum(sizes[i] for i in c) <= 64]
    mix = packing.fractional(sizes, wanted, 64)
    for i, n in enumerate(wanted):
        assert sum(x * c.count(i) for x, c in mix) == pytest.approx(n)
    assert all(c in configs for _, c in mix)
    # dual values that no configuration exceeds, and that add up to the same number, prove it
    base = np.array([[c.count(i) for _, c in mix] for i in range(len(sizes))], float)
    price = np.linalg.solve(base.T, np.ones(len(sizes)))
    assert max(sum(price[i] for i in c) for c in configs) <= 1 + 1e-6
    assert sum(x for x, _ in mix) == pytest.approx(float(price @ wanted)) and min(x for x, _ in mix) >= 0


@pytest.mark.parametrize(("low", "high", "share"), [(1025, 3000, 0.9), (1025, 4096, 0.4), (1100, 1500, 0.5)])
def test_sequences_come_from_the_mix_of_configurations(low, high, share):
    """In the second range a third of the documents are too long for any partner, and stand alone in any packing."""
    lengths = np.random.default_rng(low + high).integers(low, high + 1, 20_000)
    order = np.argsort(-lengths, kind="stable")
    made = packing.configured(lengths, 4096, 144, 0.01, order)
    placed = np.flatnonzero(made.sequence >= 0)
    fill = np.bincount(made.sequence[placed], weights=lengths[placed])
    assert (fill >= 0.99 * 4096).all() and (fill <= 4096).all()
    sequence, _ = packing.pack(lengths, 4096)
    assert len(fill) >= share * (int(sequence.max()) + 1)
    assert (sequence[placed] == made.sequence[placed]).all()


def test_every_shard_opens_all_its_part_empty_sequences(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "the " * int(n)) for i, n in enumerate(rng.integers(65, 190, 900))]
    out = packing.packed(samples.docs(spark, rows), WORDS, capacity=256, shard_tokens=8000).toPandas()
    lengths = out["length"].tolist()
    assert sorted(out["doc_id"]) == [k for k, _ in rows] and out.groupby("sequence_id")["length"].sum().max() <= 256
    assert out["sequence_id"].nunique() <= 1.02 * best_fit_decreasing(lengths, 256)
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part["offset"].tolist() == [0, *np.cumsum(part["length"])[:-1].tolist()]


def test_a_worker_remembers_a_bounded_number_of_words():
    library, codec, most = Tokenizer.from_file(WORDS), packing.WordCodec(WORDS), 0
    for block in range(14):
        text = " ".join(f"word{i}" for i in range(block * 40_000, (block + 1) * 40_000))
        codec.encode([text])
        most = max(most, len(codec.words))
    assert 100_000 < most < 500_000
    text = "word1 again, word559999!"
    assert codec.encode([text]) == [packing.pack_ids(library.encode(text, add_special_tokens=False).ids)]
