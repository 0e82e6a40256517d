"""Nearest vectors by inner product, from balanced posting lists (operator 12).

Centroids are fitted on a bounded sample; every vector is put into the list of its nearest centroid and, near a
boundary, of others. A graph over the centroids, held in memory, finds the lists of a vector or a query. A query
reads the lists whose distance is within a ratio of its nearest one's; the ratio comes from an audit against brute
force. Vectors get one more component that makes all equally long, so that the largest inner product is the
least distance. Lists stay where they are: queries come to them.
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
class Index:
    """``k``: neighbours of a query. ``list_rows``: vectors for each centroid, while there are fewer centroids than
    ``centroids``. ``sample_values``: numbers in the vectors that centroids are fitted on, at most. ``replicas``,
    ``boundary``: a vector is in at most so many lists, within so many times its nearest distance. ``part_rows``:
    vectors of a list that are kept together; longer lists have several parts. ``audited``: queries compared with
    brute force; the ratio is the least with which these find ``recall`` of their neighbours. ``first_lists``: lists
    read before the others, to bound what these send back."""

    k: int = 20
    list_rows: int = 1000
    centroids: int = 4096
    sample_values: int = 1 << 22
    replicas: int = 4
    boundary: float = 1.05
    part_rows: int = 4096
    degree: int = 16
    beam: int = 32
    audited: int = 200
    recall: float = 0.96
    first_lists: int = 4


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0.0)


def balanced(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """``n`` centroids with lists of like length: a list's price rises with its excess over the mean."""
    centres = x[np.random.default_rng(11).permutation(len(x))[:n]].copy()
    price = np.zeros(n)
    for _ in range(rounds):
        owner, sizes, spread = np.empty(len(x), np.int64), np.zeros(n), 0.0
        for i in range(0, len(x), 4096):
            away = squares(x[i : i + 4096], centres)
            owner[i : i + 4096] = (away + price).argmin(axis=1)
            spread += away.min(axis=1).sum()
        sizes = np.bincount(owner, minlength=n)
        price += 0.1 * (spread / len(x)) * np.clip(sizes / (len(x) / n) - 1.0, -1.0, 1.0)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, x)
        filled = sizes > 0
        centres[filled] = sums[filled] / sizes[filled, None]
    return centres


class CentroidGraph:
    """Centroids, each linked with near ones; queries walk along the links, all in step."""

    def __init__(self, centres: np.ndarray, length: float, degree: int):
        self.centres, self.length = centres, length
        n = len(centres)
        width = min(n - 1, 4 * degree)
        self.links = np.full((n, 2 * degree), -1, np.int32)
        chosen: list[list[int]] = [[] for _ in range(n)]
        between = squares(centres, centres)
        np.fill_diagonal(between, np.inf)
        for i in range(n):
            near = np.argsort(between[i], kind="stable")[:width]
            for j in near.tolist():
                # a link that one already taken leads to is not needed
                if len(chosen[i]) < degree and all(between[j, m] > between[i, j] for m in chosen[i]):
                    chosen[i].append(j)
        order = self._reachable_order(between)
        for a, b in [(i, j) for i in range(n) for j in chosen[i]] + order:
            for x, y in ((a, b), (b, a)):
                row = self.links[x]
                if y not in row:
                    free = np.flatnonzero(row < 0)
                    if len(free):
                        row[free[0]] = y
                    else:
                        self.links = np.concatenate([self.links, np.full((n, degree), -1, np.int32)], axis=1)
                        self.links[x, -degree] = y
        self.start = int(squares(centres, centres.mean(axis=0)[None, :]).argmin()) if n else 0

    @staticmethod
    def _reachable_order(between: np.ndarray) -> list[tuple[int, int]]:
        """The links of a least spanning tree: every centroid can be reached."""
        n = len(between)
        away, via, out = between[0].copy(), np.zeros(n, np.int64), []
        todo = np.ones(n, bool)
        todo[0] = False
        for _ in range(n - 1):
            j = int(np.where(todo, away, np.inf).argmin())
            out.append((int(via[j]), j))
            todo[j] = False
            nearer = between[j] < away
            away[nearer], via[nearer] = between[j][nearer], j
        return out

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Stored vectors with the component that makes all of them equally long."""
        rest = self.length**2 - (vectors * vectors).sum(axis=1)
        return np.concatenate([vectors, np.sqrt(np.maximum(rest, 0.0))[:, None]], axis=1)

    def ask(self, queries: np.ndarray) -> np.ndarray:
        """Queries as points of the same length, for which the nearest point has the largest inner product."""
        long = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        return np.concatenate([queries * (self.length / long), np.zeros((len(queries), 1))], axis=1)

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids met and their squared distances, in order."""
        n, rows = len(points), np.arange(len(points))
        width = min(width, len(self.centres))
        own, norms = (points * points).sum(1), (self.centres * self.centres).sum(1)
        ids = np.full((n, width), -1, np.int64)
        away = np.full((n, width), np.inf)
        ids[:, 0] = self.start
        away[:, 0] = own + norms[self.start] - 2 * points @ self.centres[self.start]
        done = ids < 0
        seen = np.zeros((n, len(self.centres)), bool)
        seen[:, self.start] = True
        active = rows
        while len(active):
            open_ = np.where(done[active], np.inf, away[active])
            best = open_.argmin(axis=1)
            more = open_[np.arange(len(active)), best] < np.inf
            active, best = active[more], best[more]
            if not len(active):
                break
            done[active, best] = True
            to = self.links[ids[active, best]]
            fresh = (to >= 0) & ~seen[active[:, None], to]
            seen[active[:, None], np.where(fresh, to, self.start)] = True
            far = own[active, None] + norms[to] - 2 * np.einsum("qd,qmd->qm", points[active], self.centres[to])
            far[~fresh] = np.inf
            both = np.concatenate([away[active], far], axis=1)
            order = np.argsort(both, axis=1, kind="stable")[:, :width]
            away[active] = np.take_along_axis(both, order, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], to], axis=1), order, axis=1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], axis=1), order, axis=1)
        return ids, np.maximum(away, 0.0)

    def within(self, points: np.ndarray, ratio: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, centroid, rank) of the centroids within ``ratio`` times the nearest distance. A search whose whole
        beam lies within that is repeated with a wider one."""
        found, todo = [], np.arange(len(points))
        while len(todo):
            ids, away = self.nearest(points[todo], beam)
            fits = (np.sqrt(away) <= ratio * np.sqrt(away[:, :1])) & (ids >= 0)
            full = fits.all(axis=1) & (ids.shape[1] < len(self.centres))
            p, rank = np.nonzero(fits & ~full[:, None])
            found.append(np.stack([todo[p], ids[p, rank], rank]))
            todo, beam = todo[full], 2 * beam
        out = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
        return out[0], out[1], out[2]


def homes(graph: CentroidGraph, points: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(point, list): the nearest list, and near ones unless one that is taken lies between."""
    ids, away = graph.nearest(points, max(index.beam, 2 * index.replicas))
    wide = min(ids.shape[1], 2 * index.replicas)
    ids, far = ids[:, :wide], np.sqrt(away[:, :wide])
    taken = np.zeros(ids.shape, bool)
    for j in range(wide):
        to = graph.centres[np.maximum(ids[:, j], 0)]
        between = np.sqrt(((graph.centres[np.maximum(ids, 0)] - to[:, None, :]) ** 2).sum(axis=2))
        blocked = (taken & (between < far[:, j, None])).any(axis=1)
        taken[:, j] = (ids[:, j] >= 0) & ~blocked & (far[:, j] <= index.boundary * far[:, 0]) & (taken.sum(axis=1) < index.replicas)
    p, j = np.nonzero(taken)
    return p, ids[p, j]


def vectors_of(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("size").to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        yield size, batch.filter(pa.array(sizes == size))


Graphs = dict[int, CentroidGraph]


def _listed(graphs: Graphs, index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            for size, some in by_size(batch):
                p, lists = homes(graphs[size], graphs[size].place(vectors_of(some.column("embedding"))), index)
                yield pa.RecordBatch.from_arrays([some.column("rep").take(pa.array(p)), pa.array(lists)], ["rep", "list"])

    return run


def _routed(graphs: Graphs, ratio: float, index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            for size, some in by_size(batch):
                p, lists, rank = graphs[size].within(graphs[size].ask(vectors_of(some.column("embedding"))), ratio, index.beam)
                columns = [some.column("rep").take(pa.array(p)), pa.array(lists), pa.array(rank < index.first_lists)]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "list", "early"])

    return run


def best_of(queries: np.ndarray, vectors: np.ndarray, reps: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's first ``k`` rows by score, then ``rep``; scores summed alike wherever a row is."""
    quick = queries @ vectors.T
    if quick.shape[1] > k + 8:
        # a margin for rows whose quick scores differ in the last bits only
        edge = -np.partition(-quick, k - 1, axis=1)[:, k - 1 : k]
        q, row = np.nonzero(quick >= edge - 1e-9 * (1 + np.abs(edge)))
    else:
        q, row = np.nonzero(np.ones(quick.shape, bool))
    score = np.einsum("nd,nd->n", queries[q], vectors[row])
    order = np.lexsort((reps[row], -score, q))
    q, row, score = q[order], row[order], score[order]
    starts = np.searchsorted(q, np.arange(len(queries)))
    first = np.arange(len(q)) - starts[q] < k
    return q[first], row[first], score[first]


def _part(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep", kind="stable")
    file = io.BytesIO()
    kind = np.float32 if isinstance(rows["embedding"].iloc[0], np.ndarray) and rows["embedding"].iloc[0].dtype == np.float32 else np.float64
    np.savez(file, reps=rows["rep"].to_numpy(np.int64), vectors=np.array(rows["embedding"].tolist(), kind))
    own = {c: [rows[c].iloc[0]] for c in ("size", "list", "part")}
    return pd.DataFrame(own | {"kind": [0], "held": [file.getvalue()], "rep": [None], "embedding": [None], "least": [None]})


def _searched(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parts of lists and queries, in order: each part stands before the queries that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reps, vectors = None, None, None
        for batch in slices(batches, 512):
            place = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "list", "part", "kind")], axis=1)
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
                *where, kind = place[start].tolist()
                if kind == 0:
                    held = np.load(io.BytesIO(batch.column("held")[start].as_py()))
                    at, reps, vectors = where, held["reps"], held["vectors"].astype(np.float64)
                elif at == where:
                    some = batch.slice(start, end - start)
                    q, row, score = best_of(vectors_of(some.column("embedding")), vectors, reps, k)
                    least = some.column("least").to_numpy(zero_copy_only=False).astype(np.float64)[q]
                    good = ~(score < least)  # without a bound, all
                    ids = some.column("rep").to_numpy(zero_copy_only=False)[q]
                    columns = [pa.array(c[good]) for c in (ids, reps[row], score)]
                    yield pa.RecordBatch.from_arrays(columns, ["query", "rep", "score"])

    return run


_FOUND = "query long, rep long, score double"
_FLOAT = "array<float>"


def _search(parts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Rows of ``query, rep, score``: the first ``k`` of each query in each part it reads."""
    asked = asked.select(
        "size", "list", "part", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("held"), "rep", "embedding", "least",
    )
    rows = parts.unionByName(asked).repartition("size", "list", "part").sortWithinPartitions("size", "list", "part", "kind")
    return rows.mapInArrow(_searched(k), _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("rep"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _brute(queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The audited queries against all vectors: one running list for each query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, 2000):
            for size, some in by_size(batch):
                if size not in queries:
                    continue
                reps, asked = some.column("rep").to_numpy(zero_copy_only=False), queries[size][1]
                q, row, score = best_of(asked, vectors_of(some.column("embedding")), reps, k)
                q, rep = q.astype(np.int64), reps[row]
                if size in best:
                    q, rep, score = (np.concatenate([a, b]) for a, b in zip(best[size], (q, rep, score), strict=True))
                order = np.lexsort((rep, -score, q))
                q, rep, score = q[order], rep[order], score[order]
                first = np.arange(len(q)) - np.searchsorted(q, q) < k
                best[size] = (q[first], rep[first], score[first])
        for size, (q, rep, score) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(queries[size][0][q]), pa.array(rep), pa.array(score)], ["query", "rep", "score"])

    return run


def usable(embedding: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _hashed_share(key: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


class PostingLists:
    """The index over all usable rows of a table, and its searches."""

    def __init__(self, vectors: DataFrame, queries: Column, index: Index, key: str, embedding: str):
        self.index = index
        kind = dict(vectors.dtypes)[embedding]
        rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast(kind if kind == _FLOAT else "array<double>").alias("embedding"))
        rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).distinct()
        rows = rows.withColumn("hash", F.xxhash64("embedding"))
        # of equal vectors the smallest ids: no query needs more than k of them besides its own
        order = Window.partitionBy("hash", "embedding").orderBy("vec_id")
        some = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= index.k + 1)
        same = some.groupBy("hash", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        entry = same.select(F.col("ids")[0].alias("rep"), "hash", "embedding", "ids", F.size("embedding").alias("size"))
        # a key with several vectors: their entries still need names of their own
        entry = entry.withColumn("named", F.row_number().over(Window.partitionBy("rep").orderBy("hash", "embedding")))
        self.entries = staged(entry.select("*", F.monotonically_increasing_id().alias("entry")))
        asking = rows.filter(queries)
        self.asking = asking.join(self.entries.select("hash", "embedding", "entry"), ["hash", "embedding"]).select(F.col("vec_id").alias("query_id"), "entry")
        self.asking = staged(self.asking)
        self.asked = self.asking.select("entry").distinct().join(self.entries, "entry")
        self.numbered = self.entries.select(F.col("entry").alias("rep"), "size", "embedding")
        self.graphs = self._graphs()
        self.ratio = 1.0

    def _graphs(self) -> Graphs:
        """A graph for each dimension, from centroids of a sample of at most ``sample_values`` numbers on average."""
        norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        facts = self.entries.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("length")).collect()
        values = sum(r["n"] * r["size"] for r in facts)
        picked = self.entries.filter(_hashed_share(F.col("entry"), self.index.sample_values / max(1, values)))
        table = picked.select("entry", "size", "embedding").toArrow()
        sizes, graphs = table.column("size").to_numpy(), {}
        for r in facts:
            some = table.filter(pa.array(sizes == r["size"])).sort_by("entry").column("embedding").combine_chunks()
            x = vectors_of(some) if len(some) else np.zeros((1, r["size"]))
            blank = CentroidGraph(np.zeros((1, r["size"] + 1)), r["length"], self.index.degree)
            points = blank.place(x)
            n = max(1, min(-(-r["n"] // self.index.list_rows), self.index.centroids, len(points) // 8 or 1))
            graphs[r["size"]] = CentroidGraph(balanced(points, n), r["length"], self.index.degree)
        return graphs

    def build(self) -> None:
        """Every entry to its lists, and long lists cut into parts."""
        lists = self.numbered.mapInArrow(_listed(self.graphs, self.index), "rep long, list long")
        self.member = staged(lists.join(self.numbered.select("rep", "size"), "rep"))
        counts = self.member.groupBy("size", "list").agg(F.ceil(F.count(F.lit(1)) / self.index.part_rows).cast("long").alias("parts"))
        self.counts = staged(counts)
        part = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts")).alias("part")
        dealt = self.member.join(self.counts, ["size", "list"]).select("rep", "list", part).join(self.numbered, "rep")
        kind = dict(self.entries.dtypes)["embedding"]
        shape = f"size int, list long, part long, kind int, held binary, rep long, embedding {kind}, least double"
        self.parts = staged(dealt.groupBy("size", "list", "part").applyInPandas(_part, shape))

    def audit(self) -> tuple[DataFrame, DataFrame]:
        """True neighbours of the audited queries, for the ratio and for a measure of recall: two halves."""
        n = self.asked.count()
        share = 2 * self.index.audited / max(1, n)
        picked = self.asked.filter(_hashed_share(F.col("entry"), share)).select(F.col("entry").alias("rep"), "size", "embedding")
        table = picked.toArrow()
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = table.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            some = table.filter(pa.array(sizes == size)).sort_by("rep")
            held[size] = (some.column("rep").to_numpy(), vectors_of(some.column("embedding").combine_chunks()))
        found = self.numbered.mapInArrow(_brute(held, self.index.k + 1), _FOUND)
        true = staged(_first(found.filter("query <> rep"), self.index.k).select("query", "rep", "score"))
        half = F.pmod(F.xxhash64("query", F.lit(5)), F.lit(2))
        self.audited = held
        return true.filter(half == 0), true.filter(half == 1)

    def fit(self, true: DataFrame) -> float:
        """The least ratio with which the audited queries read lists that hold ``recall`` of their neighbours."""
        rows = true.join(self.member, "rep").select("query", "rep", "size", "list").toPandas()
        need = []
        for size, some in rows.groupby("size"):
            graph = self.graphs[size]
            queries, vectors = self.audited[size]
            away = np.sqrt(squares(graph.ask(vectors), graph.centres))
            away /= away.min(axis=1, keepdims=True)
            at = np.searchsorted(queries, some["query"].to_numpy())
            ratios = pd.Series(away[at, some["list"].to_numpy()], index=some.index)
            need.append(ratios.groupby([some["query"], some["rep"]]).min())
        if not need:
            return 1.0
        wanted = np.sort(pd.concat(need).to_numpy())
        return float(wanted[min(len(wanted) - 1, int(np.ceil(self.index.recall * len(wanted))) - 1)]) * (1 + 1e-9)

    def search(self, asked: DataFrame) -> DataFrame:
        """``query, rep, score``: the nearest entries of query entries (``rep, size, embedding``), in all lists the ratio admits."""
        width = self.index.k + 1
        routed = staged(asked.mapInArrow(_routed(self.graphs, self.ratio, self.index), "rep long, list long, early boolean"))
        cut = self.counts.select("size", "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        known = routed.join(asked, "rep")
        early = known.filter("early").join(cut, ["size", "list"]).withColumn("least", F.lit(None).cast("double"))
        first = staged(_first(_search(self.parts, early, width).distinct(), width))
        # a query's last early score, if it has enough of them, bounds what other lists need to send
        bound = first.filter(F.col("place") == width).select(F.col("query").alias("rep"), F.col("score").alias("least"))
        late = known.filter("not early").join(bound, "rep", "left").join(cut, ["size", "list"])
        rest = _search(self.parts, late, width)
        return _first(first.drop("place").unionByName(rest).distinct(), width)

    def neighbours(self) -> DataFrame:
        found = self.search(self.asked.select(F.col("entry").alias("rep"), "size", "embedding"))
        answers = self.asking.join(found, self.asking["entry"] == found["query"])
        rows = answers.join(self.entries.select(F.col("entry").alias("rep"), F.explode("ids").alias("vec_id")), "rep").filter("vec_id <> query_id")
        best = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.index.k)
        return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def measured(self, true: DataFrame) -> float:
        """Share of the true neighbours of the other audited queries that a search returns."""
        asked = self.asked.select(F.col("entry").alias("rep"), "size", "embedding").join(true.select(F.col("query").alias("rep")).distinct(), "rep")
        found = self.search(asked).select("query", "rep", F.lit(1).alias("hit"))
        hits = true.join(found, ["query", "rep"], "left").agg(F.sum("hit").alias("hit"), F.count(F.lit(1)).alias("all")).first()
        return (hits["hit"] or 0) / hits["all"] if hits["all"] else 1.0


def indexed(vectors: DataFrame, queries: Column, index: Index | None = None, key: str = "vec_id", embedding: str = "embedding") -> tuple[PostingLists, DataFrame]:
    """The index with its fitted ratio, and the audited queries it was not fitted on."""
    lists = PostingLists(vectors, queries, index or Index(), key, embedding)
    lists.build()
    fitted, other = lists.audit()
    lists.ratio = lists.fit(fitted)
    return lists, other


def nearest_vectors(vectors: DataFrame, queries: Column, index: Index | None = None, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's nearest rows found, by inner product in double precision.

    ``queries`` is a condition on ``vec_id``. Every usable row is in the index. Equal vectors are one entry with its
    smallest ids, which is all that ties let through, so large groups of copies cost one row; a
    query's own id is taken out last. Rows with a null key, or with a vector that is null, empty, zero or not finite,
    take no part. Vectors of another dimension are not compared. Repeated rows are one; a key with
    several vectors asks with each and is answered once for each row, by its best score. Other columns are not
    looked at; an empty table gives no rows. ``PostingLists.measured`` gives the recall over audited queries.
    """
    return indexed(vectors, queries, index, key, embedding)[0].neighbours()
