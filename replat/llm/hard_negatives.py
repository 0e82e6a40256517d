"""Hard negatives by the threshold algorithm over sorted candidate lists (operator 13).

Candidates are dealt over shards. A shard keeps its vectors and, for each dimension, its rows in the order of
that component. An anchor walks these lists from the end its own sign prefers; rows met for the first time are
scored by random access, and the sum of the values last met, times the anchor's, bounds every row not met yet.
Shards stay where they are: anchors come to them in blocks, one after the other.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replat.llm.common import slices, staged


@dataclass(frozen=True)
class Negatives:
    """``scale``: components become ``floor(scale * x)``. ``low``, ``high``: a negative's score lies between these
    shares of the positive's, in percent. ``shard_values``: numbers in a shard's vectors. ``block_anchors``: anchors
    that travel together. ``largest``: rows with a scaled component beyond it are left out, as scores would not
    fit 64 bits. ``step``: entries of every list that the first round reads; each round reads twice as many."""

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    shard_values: int = 1 << 20
    block_anchors: int = 1024
    largest: int = 1 << 24
    step: int = 64


def stored(**arrays: np.ndarray) -> bytes:
    file = io.BytesIO()
    np.savez(file, **arrays)
    return file.getvalue()


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    """The stored lists of a shard: ``order[d]`` has its rows in ascending order of component ``d``."""
    rows = rows.sort_values(["vec_id", "label"], kind="stable")
    x = matrix(rows["vector"])
    order = np.argsort(x, axis=0, kind="stable").astype(np.int32).T.copy()
    held = stored(x=x.astype(np.int32), order=order, ids=rows["vec_id"].to_numpy(np.int64), labels=rows["label"].to_numpy(np.int64))
    return pd.DataFrame({"size": [rows["size"].iloc[0]], "shard": [rows["shard"].iloc[0]], "kind": [0], "held": [held]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """Anchors that travel together, with their windows (positive, least and largest score of a negative)."""
    rows = rows.sort_values("vec_id", kind="stable")
    windows = [np.array([[w["positive_id"], w["positive_score"], w["least"], w["most"]] for w in ws], np.int64).reshape(-1, 4) for ws in rows["windows"]]
    held = stored(
        x=matrix(rows["vector"]), ids=rows["vec_id"].to_numpy(np.int64), labels=rows["label"].to_numpy(np.int64),
        windows=np.concatenate(windows), ends=np.cumsum([len(w) for w in windows]),
    )
    return pd.DataFrame({"size": [rows["size"].iloc[0]], "kind": [1], "held": [held]})


class Lists:
    """A shard in a task."""

    def __init__(self, held: bytes):
        arrays = np.load(io.BytesIO(held))
        self.x, self.order, self.ids, self.labels = (arrays[k] for k in ("x", "order", "ids", "labels"))
        self.largest = np.abs(self.x).max(axis=0, initial=0).astype(np.int64)
        self.as_type: dict[type, np.ndarray] = {np.int64: self.x}

    def exact(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and anchor in a type in which every partial sum of a score is an exact integer."""
        most = int(np.abs(anchor) @ self.largest)
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        if kind not in self.as_type:
            self.as_type[kind] = self.x.astype(kind)
        return self.as_type[kind], anchor.astype(kind)

    def walk(self, anchor: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rounds of sorted access: rows met for the first time, their scores, and the threshold that no row
        not met so far exceeds (None once all have been met)."""
        n, (x, weights) = len(self.ids), self.exact(anchor)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            yield np.arange(n), np.zeros(n, np.int64), None
            return
        seen = np.zeros(n, bool)
        depth = 0
        while True:
            to = min(n, depth + step)
            before = seen.copy()
            seen[self.order[up, n - to : n - depth]] = True
            seen[self.order[down, depth:to]] = True
            rows = np.flatnonzero(seen & ~before)
            scores = (x[rows] @ weights).astype(np.int64)
            if to == n or seen.all():
                yield rows, scores, None
                return
            last = anchor[up] @ self.x[self.order[up, n - to], up] + anchor[down] @ self.x[self.order[down, to - 1], down]
            yield rows, scores, int(last)
            depth, step = to, 2 * step


class Best:
    """The first ``k`` rows by score, then id, with scores from ``least`` to ``most``."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.least, self.most = k, least, most
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.least is not None:
            fits = (scores >= self.least) & (scores <= self.most)
            scores, ids = scores[fits], ids[fits]
        if len(self.scores) == self.k:
            better = scores >= self.scores[-1]
            scores, ids = scores[better], ids[better]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]

    def settled(self, threshold: int) -> bool:
        """No row that scores at most ``threshold`` can be among the first: an equal one could, by its id."""
        if len(self.scores) == self.k:
            return threshold < self.scores[-1]
        return self.least is not None and threshold < self.least


def _searches(lists: Lists, anchor: int, label: int, windows: np.ndarray, rules: Negatives) -> tuple[np.ndarray, list[Best]]:
    """Which rows of the shard count for an anchor, and the searches it asks for."""
    if len(windows):
        fits = (lists.labels != label) & (lists.ids != anchor)
        return fits, [Best(rules.negatives, least, most) for _, _, least, most in windows.tolist()]
    fits = (lists.labels == label) & (lists.ids != anchor)
    return fits, [Best(min(rules.positives, int(fits.sum())))]


def _asked(rules: Negatives) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stored shards and blocks of anchors, in the order of shards: each shard stands before its blocks."""

    def answers(lists: Lists, held: bytes) -> pa.RecordBatch:
        block = np.load(io.BytesIO(held))
        x, ids, labels, windows, ends = (block[k] for k in ("x", "ids", "labels", "windows", "ends"))
        out: list[tuple[np.ndarray, ...]] = []
        for i, anchor in enumerate(ids.tolist()):
            own = windows[ends[i - 1] if i else 0 : ends[i]]
            fits, searches = _searches(lists, anchor, int(labels[i]), own, rules)
            open_ = [s for s in searches if s.k and (s.least is None or s.least <= s.most)]
            if open_ and fits.any():
                for rows, scores, threshold in lists.walk(x[i], rules.step):
                    good = fits[rows]
                    scores, row_ids = scores[good], lists.ids[rows[good]]
                    for s in open_:
                        s.take(scores, row_ids)
                    if threshold is None:
                        break
                    open_ = [s for s in open_ if not s.settled(threshold)]
                    if not open_:
                        break
            for j, s in enumerate(searches):
                about = own[j, :2] if len(own) else (0, 0)
                out.append((np.full(len(s.ids), anchor), np.full(len(s.ids), about[0]), np.full(len(s.ids), about[1]), s.ids, s.scores))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "positive_score", "other_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lists = None, None
        for batch in slices(batches, 1):
            where = (batch.column("size")[0].as_py(), batch.column("shard")[0].as_py())
            held = batch.column("held")[0].as_py()
            if batch.column("kind")[0].as_py() == 0:
                at, lists = where, Lists(held)
            elif at == where:
                yield answers(lists, held)

    return run


_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def _put(anchors: DataFrame, shards: DataFrame, rules: Negatives) -> DataFrame:
    """Every anchor put to every shard of its dimension."""
    blocks = anchors.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / rules.block_anchors).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("blocks")).alias("block")
    held = anchors.join(blocks, "size").select(*anchors.columns, block).groupBy("size", "block").applyInPandas(_block, "size int, kind int, held binary")
    names = shards.select("size", "shard").distinct()
    asked = staged(held).join(names, "size").select("size", "shard", "kind", "held")
    rows = shards.select("size", "shard", "kind", "held").unionByName(asked)
    return rows.repartition("size", "shard").sortWithinPartitions("size", "shard", "kind").mapInArrow(_asked(rules), _FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("other_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def finite(embedding: Column) -> Column:
    """Not null, and no component null or not finite."""
    return F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def hard_negatives(
    vectors: DataFrame, anchors: Column, rules: Negatives | None = None, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``vec_id``. Scores are integer inner products. An anchor's positives are its first
    rows of the same label; for each, the first rows of other labels within its window are returned.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part, nor do those with
    a scaled component beyond ``largest``; zero vectors do, with score 0. Vectors of another dimension than the
    anchor's are not compared with it, and empty ones with none. Equal rows are one. Rows of one key
    with different vectors or labels are candidates each; each is an anchor, and rows under the same key come
    out together. Other columns are not looked at; an empty table gives no rows.
    """
    rules = rules or Negatives()
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("x")
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("x")) & (F.size("x") > 0))
    rows = rows.filter(F.forall("x", lambda c: F.abs(c * float(rules.scale)) < float(rules.largest)))
    whole = F.transform("x", lambda c: F.floor(c * float(rules.scale)).cast("int"))
    rows = staged(rows.select("vec_id", "label", whole.alias("vector"), F.size("x").alias("size")).distinct())
    sizes = rows.groupBy("size").agg(F.ceil(F.count(F.lit(1)) * F.col("size") / rules.shard_values).cast("long").alias("shards"))
    dealt = rows.join(sizes, "size").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards"))).drop("shards")
    shards = staged(dealt.groupBy("size", "shard").applyInPandas(_shard, "size int, shard long, kind int, held binary"))
    chosen = rows.filter(anchors)
    none = F.array().cast("array<struct<positive_id:long,positive_score:long,least:long,most:long>>")
    same = _put(chosen.withColumn("windows", none), shards, rules).select("anchor_id", "other_id", "score").distinct()
    positives = staged(_first(same, ["anchor_id"], rules.positives))
    lower, upper = rules.low * F.col("score"), rules.high * F.col("score")
    # whole scores within the shares: the lower end rounded up, the upper one down
    window = F.struct(
        F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.call_function("div", lower + F.pmod(-lower, F.lit(100)), F.lit(100)).alias("least"),
        F.call_function("div", upper - F.pmod(upper, F.lit(100)), F.lit(100)).alias("most"),
    )
    windows = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(window).alias("windows"))
    found = _put(chosen.join(windows, "vec_id"), shards, rules).distinct()
    first = _first(found, ["anchor_id", "positive_id"], rules.negatives)
    return first.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def oracle(rules: Negatives | None = None) -> str:
    """The registered query in SQL, over all pairs of anchors and rows."""
    r = rules or Negatives()
    return f"""
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor({r.scale} * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
  from usable a, usable b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= {r.positives})
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by score desc, other_id) as integer) as rank,
  other_id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id
  and not same and {r.low} * positive_score <= 100 * score and 100 * score <= {r.high} * positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by score desc, other_id) <= {r.negatives}
"""
