"""Compression classifier: dictionaries of good and bad text, calibrated size differences (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.llm.common import keyed_text, new_task


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample and of the dictionaries; scoring has no bound.

    ``per_class`` texts of each class make its dictionaries, one of ``dictionary`` and one of
    ``small`` bytes; ``calibration`` other texts set the score. Only labelled texts of at most ``longest`` bytes are
    learned from; of each, a dictionary takes at most ``pieces`` pieces.
    """

    per_class: int = 600
    calibration: int = 3000
    longest: int = 65_536
    pieces: int = 8
    dictionary: int = 112_640
    small: int = 16_384
    piece: int = 1024
    level: int = 3
    ridge: float = 0.01


@dataclass(frozen=True)
class Model:
    """``dictionaries``: pairs, of good and of bad text. ``constant``: the score where there is nothing to tell by."""

    dictionaries: tuple[tuple[bytes, bytes], ...]
    weights: tuple[float, ...]
    piece: int
    level: int
    constant: float | None = None


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def pieces(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


class Sizes:
    """Compressed bytes of whole texts, piece by piece, under each dictionary and without one."""

    def __init__(self, model: Model):
        plain = {"level": model.level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}

        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=model.level)
            return zstandard.ZstdCompressor(dict_data=held, **plain)

        self.piece = model.piece
        self.pairs = [(compressor(good), compressor(bad)) for good, bad in model.dictionaries]
        self.plain = zstandard.ZstdCompressor(**plain)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Differences of sizes over their sums: good from bad, both from no dictionary, and these from the text as it is."""
        cut = [pieces(t, self.piece) for t in texts]

        def size(c: zstandard.ZstdCompressor) -> np.ndarray:
            return np.array([sum([len(c.compress(p)) for p in ps]) for ps in cut], float)

        def gap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (b - a) / (b + a)

        whole, plain = np.array([len(t) + 1.0 for t in texts]), size(self.plain)
        columns = [np.ones(len(texts)), gap(plain, whole)]
        for n, pair in enumerate(self.pairs):
            good, bad = size(pair[0]), size(pair[1])
            columns += [gap(good, bad), gap(good, plain), gap(bad, plain)] + [gap(good, whole)] * (n == 0)
        return np.stack(columns, axis=1)


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps on standardised columns; the weights returned apply to the columns as they are."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    mean[0], spread[0] = 0, 1
    z = (x - mean) / spread
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = logistic(z, w)
        slope = z.T @ (p - y) + ridge * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    w /= spread
    w[0] -= mean @ w - mean[0] * w[0]
    return w


def sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> list[tuple[bytes, int]]:
    """Labelled texts for fitting in a fixed order, equal texts once; none of the held-out rows.

    Rows are taken by a hash of their text, so the choice is the same for any partitioning. It has at
    most 2 * ``per_class`` + ``calibration`` texts, whatever the size of the tables.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    usable = docs.filter(F.col("text").isNotNull() & (F.octet_length("text") <= fit.longest))
    usable = usable.withColumn("hash", F.xxhash64("text"))
    # narrow rows meet the labels; the texts of those chosen are fetched in the same job
    distinct = usable.select("doc_id", "hash").join(known, "doc_id").groupBy("hash").agg(F.min(F.struct("doc_id", "quality")).alias("row"))
    order = distinct.select(F.xxhash64("hash").alias("at"), "hash", "row.doc_id", "row.quality")
    # dictionaries from one end of the order, the calibration from the other, in the classes' true shares
    first, last = ("at", "doc_id"), (F.desc("at"), F.desc("doc_id"))
    good, bad = (order.filter(F.col("quality") == q).orderBy(*first).limit(fit.per_class) for q in (1, 0))
    chosen = good.union(bad).union(order.orderBy(*last).limit(fit.calibration)).distinct()
    found = usable.join(F.broadcast(chosen), ["doc_id", "hash"]).select("at", "doc_id", "hash", "quality", "text")
    rows = {(r["at"], r["doc_id"], r["hash"], r["quality"]): r["text"] for r in found.collect()}  # bounded by the fit
    return [(rows[k].encode(), k[3]) for k in sorted(rows)]


def trained(rows: list[tuple[bytes, int]], fit: Fit) -> Model:
    """Dictionaries from the first ``per_class`` texts of each class, the calibration from the others."""
    of = {q: [t for t, label in rows if label == q] for q in (0, 1)}
    # a class needs texts for its dictionary; with few of them half are left for the calibration
    use = {q: min(fit.per_class, (len(t) + 1) // 2) for q, t in of.items()}
    constant = Model((), (), fit.piece, fit.level, (len(of[1]) + 1) / (len(of[0]) + len(of[1]) + 2))
    if min(map(len, of.values())) < 8:
        return constant

    def dictionary(texts: list[bytes], size: int) -> bytes:
        parts = [p for t in texts for p in pieces(t, fit.piece)[: fit.pieces]]
        try:
            return zstandard.train_dictionary(size, parts).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
            return b"".join(parts)[-size:]

    made = tuple((dictionary(of[1][: use[1]], size), dictionary(of[0][: use[0]], size)) for size in (fit.dictionary, fit.small))
    model = Model(made, (), fit.piece, fit.level)
    seen = {q: set(of[q][: use[q]]) for q in (0, 1)}
    rest = [(t, q) for t, q in rows if t not in seen[q]]
    rest = rest[-fit.calibration :]
    y = np.array([q for _, q in rest], float)
    if len(set(y)) < 2:
        return constant
    weights = fit_logistic(Sizes(model).features([t for t, _ in rest]), y, fit.ridge)
    return Model(made, tuple(weights.tolist()), fit.piece, fit.level)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row as column ``row`` with its ``score``; whole texts are compressed, a null text is empty."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_task("quality_classifier")
        sizes = Sizes(model) if model.constant is None else None
        weights = np.array(model.weights)
        for batch in batches:
            score: list[float] = []
            for i in range(0, batch.num_rows, 500):
                texts = [(t or "").encode() for t in batch.column("text").slice(i, 500).to_pylist()]
                score += logistic(sizes.features(texts), weights).tolist() if sizes else [model.constant] * len(texts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score, pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def fitted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fit: Fit | None = None) -> DataFrame:
    """``row`` (all columns of the input), ``score``, ``predicted``, by a model learned from the labelled rows, and
    ``modelled``: whether there were enough of these, so that scores tell rows apart at all."""
    fit = fit or Fit()
    model = trained(sample(keyed_text(docs), labels, fit), fit)
    rows = scored(docs, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return rows.withColumn("modelled", F.lit(model.constant is None))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, fit: Fit | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Learns from a bounded sample (``Fit``) of labelled rows that are not held out; neither the labels nor
    language, source or key enter a score. Without eight usable texts of each class every score is the
    smoothed share of good labels. A null key is never held out. Repeated rows give repeated rows.
    """
    return fitted(keyed_text(docs), labels, threshold, fit).select(
        "row.doc_id", F.coalesce(held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"), "score", "predicted"
    )
