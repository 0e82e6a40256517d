"""Embedding near-dedup over navigable small-world graphs, one for each shard (operator 4)."""

from __future__ import annotations

import io
import itertools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replat.llm.common import new_task, staged
from replat.llm.components import components


#: Nodes of a beam whose neighbours are looked at in one step. Their lists together have under 256 places.
EXPANDED = 4

#: Bytes that one step of a build or a search puts in memory beside the graph, about.
STEP_BYTES = 16_000_000

#: Bytes of vectors that are multiplied at a time, as many as a core's cache holds.
CACHE_BYTES = 500_000


@dataclass(frozen=True)
class Search:
    """``threshold``: least cosine of a link. ``shards``: graphs of a dimension at the least; more where one would get
    over ``shard_rows`` vectors or ``shard_bytes`` of components. ``block_rows``: queries that are put to one graph at a
    time; fewer where these would get over ``block_bytes``. ``degree``: neighbours of a
    node in the upper layers, half of those in the lowest. ``beam``: nodes a search keeps at first; it doubles
    while the ``audited`` queries of a block, compared with brute force, find less than ``recall``."""

    threshold: float = 0.95
    shards: int = 6
    shard_rows: int = 500_000
    shard_bytes: int = 48_000_000
    block_rows: int = 20_000
    block_bytes: int = 8_000_000
    degree: int = 16
    beam: int = 48
    build_beam: int = 64
    audited: int = 50
    recall: float = 0.995

    @property
    def angle(self) -> float:
        return float(np.arccos(self.threshold))

    @property
    def radius(self) -> float:
        """A vector this close to a node is kept with it, not as a node. Members of one node link with it."""
        return self.angle / 2

    def shards_of(self, rows: int, row_bytes: int) -> int:
        return max(self.shards, -(-rows // self.shard_rows), -(-rows * row_bytes // self.shard_bytes))


MARGIN = 1e-6


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def unit(embeddings: pd.Series | np.ndarray) -> np.ndarray:
    x = np.array(list(embeddings), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that nothing is rounded and no product leaves the range of its type."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def inverse_lengths(vectors: np.ndarray) -> np.ndarray:
    """In double precision, whatever the vectors are in."""
    out = np.empty(len(vectors))
    step = max(1, STEP_BYTES // (8 * vectors.shape[1]))
    for i in range(0, len(vectors), step):
        x = vectors[i : i + step].astype(np.float64)
        out[i : i + step] = 1 / np.sqrt(np.einsum("nd,nd->n", x, x))
    return out


def nearest_first(cosines: np.ndarray, width: int) -> np.ndarray:
    """Columns of the ``width`` greatest of each row; the first of equal ones comes first."""
    if cosines.dtype != np.float32:
        return np.argsort(-cosines, axis=1, kind="stable")[:, :width]
    bits = cosines.view(np.int32)
    key = ~(bits ^ ((bits >> 31) & 0x7FFFFFFF))  # falls as the number rises
    both = key.astype(np.int64) << 32 | np.arange(cosines.shape[1])
    both.sort(axis=1)
    return both[:, :width] & 0xFFFFFFFF


class Graph:
    """Layers of neighbour lists over vectors; whole batches of nodes and queries move in step.

    ``vectors`` are the first ``size`` rows of ``rows``, which has place for all that may come; ``inverse`` has one over
    the length of each. All nodes have a list in the lowest layer; those with a height have a ``slot`` in the others.
    """

    def __init__(self, rows: np.ndarray, inverse: np.ndarray, lists: list[np.ndarray], height: np.ndarray, size: int):
        self.rows, self.inverse, self.lists, self.height, self.size = rows, inverse, lists, height, size
        raised = height[:size] > 0
        self.raised = int(raised.sum())
        self.slot = np.full(len(height), -1, np.int32)
        self.slot[:size][raised] = np.arange(self.raised)

    @property
    def vectors(self) -> np.ndarray:
        return self.rows[: self.size]

    def cosines(self, queries: np.ndarray, of: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Of unit queries, one for each node."""
        out = np.empty(len(nodes), self.rows.dtype)
        step = max(1, CACHE_BYTES // (2 * self.rows.itemsize * self.rows.shape[1]))
        for i in range(0, len(nodes), step):
            some = nodes[i : i + step]
            asked, held = queries.take(of[i : i + step], axis=0), self.rows.take(some, axis=0)
            out[i : i + step] = np.einsum("nd,nd->n", asked, held) * self.inverse.take(some)
        return out

    def beam(self, queries: np.ndarray, entries: np.ndarray, width: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of one layer: ids and cosines of the ``width`` best nodes seen by each query."""
        n, neighbours = len(queries), self.lists[layer]
        ids = np.full((n, width), -1, np.int32)
        near = np.full((n, width), -np.inf, self.rows.dtype)
        k = min(entries.shape[1], width)
        ids[:, :k] = entries[:, :k]
        q, j = np.nonzero(ids >= 0)
        near[q, j] = self.cosines(queries, q, ids[q, j])
        done = ids < 0
        seen = np.zeros((n, self.raised if layer else self.size), np.uint8)
        seen[q, self.slot[ids[q, j]] if layer else ids[q, j]] = 1
        active = np.arange(n)
        while True:
            open_ = ~done[active]
            active, open_ = active[(some := open_.any(axis=1))], open_[some]
            if not len(active):
                break
            rank = np.cumsum(open_, axis=1, dtype=np.int16)
            row, column = np.nonzero(open_ & (rank <= EXPANDED))
            done[active[row], column] = True
            from_ = ids[active[row], column]
            to = np.full((len(active), EXPANDED, neighbours.shape[1]), -1, np.int32)
            to[row, rank[row, column] - 1] = neighbours[self.slot[from_] if layer else from_]
            to = to.reshape(len(active), -1)
            place = self.slot[to] if layer else to
            row, column = np.nonzero((to >= 0) & (seen[active[:, None], place] == 0))
            # the last of a node's places counts
            seen[active[row], place[row, column]] = column + 1
            once = seen[active[row], place[row, column]] == column + 1
            row, column = row[once], column[once]
            cosine = np.full(to.shape, -np.inf, near.dtype)
            cosine[row, column] = self.cosines(queries, active[row], to[row, column])
            all_near = np.concatenate([near[active], cosine], axis=1)
            order = nearest_first(all_near, width)
            near[active] = np.take_along_axis(all_near, order, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], to], axis=1), order, axis=1)
            done[active] = np.take_along_axis(np.concatenate([done[active], cosine == -np.inf], axis=1), order, axis=1)
        ids[near == -np.inf] = -1
        return ids, near

    def step(self, width: int) -> int:
        """How many queries are searched for at a time: what they have seen and found has a bound."""
        return max(1, min(512, 2 * STEP_BYTES // max(1, self.size), STEP_BYTES // (16 * max(width, self.rows.shape[1]))))

    def search(self, queries: np.ndarray, width: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.lists) - 1
        starts = np.flatnonzero(self.height[: self.size] == top)[:4].astype(np.int32)
        out_ids, out_near = np.empty((len(queries), width), np.int32), np.empty((len(queries), width), self.rows.dtype)
        step = self.step(width)
        for i in range(0, len(queries), step):
            some = queries[i : i + step]
            ids = np.repeat(starts[None, :], len(some), axis=0)
            for layer in range(top, down_to - 1, -1):
                ids, near = self.beam(some, ids, width if layer == down_to else 4, layer)
            out_ids[i : i + step], out_near[i : i + step] = ids, near
        return out_ids, out_near


def chosen(near: np.ndarray, between: np.ndarray, degree: int) -> np.ndarray:
    """Which candidates (the nearest first) become neighbours: one that is nearer to the node than to those
    taken before it; if these are too few, the nearest of the others."""
    n, width = near.shape
    taken = np.zeros((n, width), bool)
    for j in range(width):
        closest = np.where(taken, between[:, j, :], -np.inf).max(axis=1, initial=-np.inf)
        taken[:, j] = (near[:, j] > closest) & (taken.sum(axis=1) < degree) & (near[:, j] > -np.inf)
    rest = np.argsort(np.where(taken, -1, 0), axis=1, kind="stable")
    missing = degree - taken.sum(axis=1)
    at = np.cumsum(~np.take_along_axis(taken, rest, axis=1), axis=1)
    fill = (at <= missing[:, None]) & ~np.take_along_axis(taken, rest, axis=1)
    np.put_along_axis(taken, rest, np.take_along_axis(taken, rest, axis=1) | fill, axis=1)
    return taken & (near > -np.inf)


class Builder:
    """Puts vectors (which it owns from then on, and sorts: the nodes come first) into a graph. ``order`` has the place
    that each had at first, ``node_of`` its node, which is its own place if it is one."""

    def __init__(self, vectors: np.ndarray, search: Search):
        self.all, self.search = vectors, search
        self.inverse = inverse_lengths(vectors).astype(vectors.dtype)
        self.order = np.arange(len(vectors))
        self.node_of = np.full(len(vectors), -1, np.int32)

    def build(self) -> Graph:
        """Vectors go in by batches that double up to a limit; each batch is searched for in the graph so far
        and compared with itself. Vectors near a node become its members, the others new nodes."""
        search, n = self.search, len(self.all)
        close = np.cos(search.radius - MARGIN)
        levels = np.minimum((np.random.default_rng(7).exponential(size=n) / np.log(search.degree)).astype(np.int32), 6)
        levels[0] = 6
        raised = int((levels > 0).sum())
        lists = [np.full((raised if layer else n, search.degree if layer else 2 * search.degree), -1, np.int32) for layer in range(7)]
        graph = Graph(self.all, self.inverse, lists, np.zeros(n, np.int8), 0)
        at = 0
        while at < n:
            some = np.arange(at, min(n, at + max(1, min(512, at))))
            at = int(some[-1]) + 1
            batch = self.all[some] * self.inverse[some, None]
            ids, near = np.full((len(some), 0), -1, np.int32), np.zeros((len(some), 0), batch.dtype)
            if graph.size:
                ids, near = graph.search(batch, search.build_beam)
                held = near[:, 0] >= close
                self.node_of[some[held]] = ids[held, 0]
                some, batch, ids, near = some[~held], batch[~held], ids[~held], near[~held]
            among = batch @ batch.T
            lead: list[int] = []
            for i in range(len(some)):  # within the batch the first of close vectors is the node
                j = lead[int(among[i, lead].argmax())] if lead else i
                if j != i and among[i, j] >= close:
                    self.node_of[some[i]] = self.node_of[some[j]]
                else:
                    self.node_of[some[i]] = graph.size + len(lead)
                    lead.append(i)
            if lead:
                heights = levels[some[lead]]
                self.forward(some[lead], graph.size)
                self.add(graph, batch[lead], among[np.ix_(lead, lead)], heights, ids[lead], near[lead])
        return graph

    def forward(self, rows: np.ndarray, to: int) -> None:
        """Swaps these rows with those in the places from ``to`` on."""
        places = np.arange(to, to + len(rows))
        out, free = np.setdiff1d(places, rows), np.setdiff1d(rows, places)
        if len(out):
            a, b = np.concatenate([places, free]), np.concatenate([rows, out])
            for held in (self.all, self.inverse, self.order, self.node_of):
                held[a] = held[b]

    def add(self, graph: Graph, batch: np.ndarray, among: np.ndarray, levels: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
        """``ids`` and ``near``: what the search found for each in the lowest layer."""
        old, new, degree = graph.size, len(batch), self.search.degree
        found = {0: (np.arange(new), ids, near)}
        for layer in range(1, len(graph.lists)):  # all searches come before the new nodes
            here = np.flatnonzero(levels >= layer)
            ids, near = np.full((len(here), 0), -1, np.int32), np.zeros((len(here), 0), batch.dtype)
            if len(here) and (graph.height[:old] >= layer).any():
                ids, near = graph.search(batch[here], self.search.build_beam, layer)
            found[layer] = here, ids, near
        graph.height[old : old + new] = levels
        raised = old + np.flatnonzero(levels > 0)
        graph.slot[raised] = np.arange(graph.raised, graph.raised + len(raised))
        graph.raised, graph.size = graph.raised + len(raised), old + new
        for layer, (here, ids, near) in found.items():
            if not len(here):
                continue
            own = among[np.ix_(here, here)].copy()
            np.fill_diagonal(own, -np.inf)
            ids = np.concatenate([ids, np.repeat((old + here)[None, :].astype(np.int32), len(here), axis=0)], axis=1)
            near = np.concatenate([near, own], axis=1)
            width = min(3 * degree, near.shape[1])
            order = nearest_first(near, width)
            ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
            taken = np.zeros(near.shape, bool)
            step = max(1, STEP_BYTES // (batch.itemsize * width * (width + batch.shape[1])))
            for i in range(0, len(here), step):
                held = graph.rows[ids[i : i + step]] * graph.inverse[ids[i : i + step], None]
                taken[i : i + step] = chosen(near[i : i + step], held @ held.transpose(0, 2, 1), degree)
            lists, at = graph.lists[layer], graph.slot if layer else np.arange(graph.size)
            q, k = np.nonzero(taken)
            source, target, cosine = (old + here[q]).astype(np.int32), ids[q, k], near[q, k]
            # both directions; a full list keeps its nearest
            a, b, c = np.concatenate([source, target]), np.concatenate([target, source]), np.concatenate([cosine, cosine])
            touched = np.unique(a)
            width = lists.shape[1]
            current = lists[at[touched]]
            x, y = np.nonzero(current >= 0)
            a = np.concatenate([a, touched[x]])
            b = np.concatenate([b, current[x, y]])
            units = graph.rows[touched] * graph.inverse[touched, None]
            c = np.concatenate([c, graph.cosines(units, x, current[x, y])])
            order = np.lexsort((b, -c, a))
            a, b = a[order], b[order]
            pair = a.astype(np.int64) << 32 | b
            _, once = np.unique(pair, return_index=True)
            once.sort()
            a, b = a[once], b[once]
            starts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
            lists[at[touched]] = -1
            fits = rank < width
            lists[at[a[fits]], rank[fits]] = b[fits]


#: A stored graph is rows of one slice of its vectors each (``ids`` and ``copies`` of these, the node of each, the lists of
#: those that are nodes); ``upper`` of the first has the heights and the upper layers.
STORED = "size int, shard long, part int, parts int, total long, nodes long, ids binary, copies binary, vectors binary, node_of binary, lists binary, upper binary"


def stored(size: int, shard: int, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, search: Search) -> Iterator[pa.RecordBatch]:
    builder = Builder(vectors, search)
    graph = builder.build()
    n, m = len(vectors), graph.size
    upper = io.BytesIO()
    np.savez(upper, height=graph.height[:m], **{f"layer{i}": x[: graph.raised] for i, x in enumerate(graph.lists) if i})
    each = min(n, search.block_rows, max(1, search.block_bytes // (vectors.itemsize * size)))
    parts = -(-n // each)
    each = -(-n // parts)
    parts = -(-n // each)
    for part in range(parts):
        here = slice(part * each, min(n, (part + 1) * each))
        nodes = slice(here.start, min(m, here.stop))
        order = builder.order[here]
        row = {
            "size": size, "shard": shard, "part": part, "parts": parts, "total": n, "nodes": m, "ids": ids[order].tobytes(),
            "copies": copies[order].tobytes(), "vectors": vectors[here].tobytes(), "node_of": builder.node_of[here].tobytes(),
            "lists": graph.lists[0][nodes].tobytes(), "upper": None if part else upper.getvalue(),
        }
        yield pa.RecordBatch.from_pylist([row], SCHEMA)


SCHEMA = pa.schema(
    [("size", pa.int32()), ("shard", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("total", pa.int64()), ("nodes", pa.int64())]
    + [(name, pa.binary()) for name in ("ids", "copies", "vectors", "node_of", "lists", "upper")]
)


def _indexed(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The graphs of vectors that come by size and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_task("op4")
        of, n = None, 0
        ids, copies, vectors = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 1), np.float32)
        for batch in batches:
            size, shard, *columns = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("size", "shard", "rep", "copies"))
            starts = np.flatnonzero((np.diff(size, prepend=-1) != 0) | (np.diff(shard, prepend=-1) != 0))
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(size)], strict=True):
                values = batch.column("embedding").slice(i, j - i).flatten().to_numpy(zero_copy_only=False)
                here = int(size[i]), int(shard[i])
                if here != of:
                    if of:
                        yield from stored(*of, ids[:n], copies[:n], vectors[:n], search)
                    of, n = here, 0
                    ids, copies, vectors = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, here[0]), values.dtype)
                if n + j - i > len(ids):
                    more = (n + j - i) * 5 // 4
                    for held in (ids, copies, vectors):  # grows where it stands
                        held.resize((more, *held.shape[1:]), refcheck=False)
                ids[n : n + j - i], copies[n : n + j - i] = (x[i:j] for x in columns)
                vectors[n : n + j - i] = scaled(values.reshape(j - i, -1))
                n += j - i
        if of:
            yield from stored(*of, ids[:n], copies[:n], vectors[:n], search)

    return run


class Shard:
    """A stored graph with the members of its nodes, put together from its parts."""

    def __init__(self, search: Search, total: int, nodes: int, size: int, dtype: np.dtype):
        self.search, self.nodes, self.missing = search, nodes, None
        self.vectors = np.empty((total, size), dtype)
        self.reps, self.counts, self.node_of = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int32)
        self.lists = np.empty((nodes, 2 * search.degree), np.int32)
        self.upper = b""

    def take(self, part: int, parts: int, ids: bytes, copies: bytes, vectors: bytes, node_of: bytes, lists: bytes, upper: bytes | None) -> None:
        self.missing = set(range(parts)) if self.missing is None else self.missing
        if part not in self.missing:
            return
        self.missing.remove(part)
        total, size = self.vectors.shape
        start = part * -(-total // parts)
        here = slice(start, start + len(ids) // 8)
        self.reps[here], self.counts[here] = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.vectors[here] = np.frombuffer(vectors, self.vectors.dtype).reshape(-1, size)
        self.node_of[here] = np.frombuffer(node_of, np.int32)
        listed = np.frombuffer(lists, np.int32).reshape(-1, self.lists.shape[1])
        self.lists[start : start + len(listed)] = listed
        self.upper = upper or self.upper
        if not self.missing:
            self.complete()

    def complete(self) -> None:
        held = np.load(io.BytesIO(self.upper))
        self.upper = b""
        layers = [held[f"layer{i}"] for i in range(1, len(held.files))]
        self.inverse = inverse_lengths(self.vectors)
        self.graph = Graph(self.vectors, self.inverse.astype(self.vectors.dtype), [self.lists, *layers], held["height"], self.nodes)
        self.order = np.argsort(self.node_of, kind="stable")
        self.starts = np.searchsorted(self.node_of[self.order], np.arange(self.nodes + 1))
        self.reach = np.zeros(self.nodes)
        members = np.arange(self.nodes, len(self.vectors))
        step = self.rows_at_once()
        for i in range(0, len(members), step):
            some = members[i : i + step]
            own = self.node_of[some]
            away = angles(np.einsum("nd,nd->n", self.exact(some), self.exact(own)))
            np.maximum.at(self.reach, own, away)
        self.weight = np.zeros(self.nodes, np.int64)
        np.add.at(self.weight, self.node_of, self.counts)
        self.by_rep = np.argsort(self.reps, kind="stable")

    def rows_at_once(self) -> int:
        return max(1, STEP_BYTES // (16 * self.vectors.shape[1]))

    def exact(self, rows: np.ndarray) -> np.ndarray:
        """Unit vectors in double precision."""
        return self.vectors[rows].astype(np.float64) * self.inverse[rows, None]

    def row_of(self, ids: np.ndarray) -> np.ndarray:
        """The row of each id, -1 where it is in another shard."""
        at = self.by_rep[np.minimum(np.searchsorted(self.reps, ids, sorter=self.by_rep), len(self.reps) - 1)]
        return np.where(self.reps[at] == ids, at, -1)

    def near_nodes(self, queries: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) that can hold a link, some at a time: the angle is within the limit and the node's reach.

        A query whose whole beam lies within that angle is searched again with a wider one.
        """
        limit = self.graph.rows.dtype.type(np.cos(min(np.pi, self.search.angle + self.reach.max(initial=0) + 1e-3)))
        todo = np.arange(len(queries))
        while len(todo):
            wide = [todo[:0]]
            brute = 4 * beam >= self.nodes
            step = max(1, STEP_BYTES // (8 * self.nodes)) if brute else self.graph.step(beam)
            for i in range(0, len(todo), step):
                some = todo[i : i + step]
                if brute:
                    cosine = (queries[some].astype(self.graph.rows.dtype) @ self.graph.vectors.T) * self.graph.inverse[: self.nodes]
                    q, k = np.nonzero(cosine >= limit)
                    yield some[q], k
                    continue
                ids, near = self.graph.search(queries[some].astype(self.graph.rows.dtype), beam)
                full = near[:, -1] >= limit
                wide.append(some[full])
                q, k = np.nonzero((near >= limit) & ~full[:, None])
                yield some[q], ids[q, k]
            todo = np.concatenate(wide)
            beam *= 2

    def links(self, queries: np.ndarray, ids: np.ndarray, beam: int, tie: Callable[[np.ndarray, np.ndarray], None] | None = None) -> np.ndarray:
        """Number of vectors each query links with (itself left out); ``tie`` gets pairs (query, node) with a link."""
        counts = np.zeros(len(queries), np.int64)
        row = self.row_of(ids)
        own = np.where(row >= 0, self.node_of[row], -1)
        own_count = np.where(row >= 0, self.counts[row], 0)
        step = self.rows_at_once()
        for q, k in self.near_nodes(queries, beam):
            between = np.empty(len(q))
            for i in range(0, len(q), step):
                between[i : i + step] = angles(np.einsum("nd,nd->n", queries[q[i : i + step]], self.exact(k[i : i + step])))
            # every member is within the angle, whatever its direction from the node
            whole = between + self.reach[k] <= self.search.angle - MARGIN
            np.add.at(counts, q[whole], self.weight[k[whole]])
            mine = q[whole & (own[q] == k)]
            np.subtract.at(counts, mine, own_count[mine])
            linked = whole
            part = np.flatnonzero(~whole & (between - self.reach[k] <= self.search.angle + MARGIN))
            ends = np.cumsum(self.starts[k[part] + 1] - self.starts[k[part]])
            for i in range(0, int(ends[-1]) if len(ends) else 0, step):  # over the members of all these nodes, in a row
                place = np.arange(i, min(i + step, int(ends[-1])))
                p = np.searchsorted(ends, place, side="right")
                a, b = q[part[p]], k[part[p]]
                m = self.order[self.starts[b + 1] - (ends[p] - place)]
                hit = (np.einsum("nd,nd->n", queries[a], self.exact(m)) >= self.search.threshold) & (self.reps[m] != ids[a])
                np.add.at(counts, a[hit], self.counts[m[hit]])
                linked[part[p[hit]]] = True
            if tie:
                tie(q[linked], k[linked])
        return counts

    def wanted(self, queries: np.ndarray, ids: np.ndarray) -> int:
        """Links of these queries by brute force."""
        out, step = 0, self.rows_at_once()
        for i in range(0, len(self.vectors), step):
            some = np.arange(i, min(i + step, len(self.vectors)))
            brute = (queries @ self.exact(some).T >= self.search.threshold) & (self.reps[None, some] != ids[:, None])
            out += int((brute * self.counts[some]).sum())
        return out

    def answer(self, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        """Links of a block of queries: a row for each query that has some with their number, and links enough to
        connect what is connected here."""
        search = self.search
        queries = unit(vectors)
        audit = np.argsort((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")[: search.audited]
        wanted = self.wanted(queries[audit], ids[audit])
        beam = search.beam
        while 4 * beam < self.nodes:
            if int(self.links(queries[audit], ids[audit], beam).sum()) >= search.recall * wanted:
                break
            beam *= 2
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root.setdefault(root[x], root[x])
            return x

        pairs: list[tuple[int, int]] = []

        def tie(q: np.ndarray, k: np.ndarray) -> None:
            for a, b in zip(ids[q].tolist(), self.reps[k].tolist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    pairs.append((a, b))

        counts = self.links(queries, ids, beam, tie)
        some = counts != 0
        tied = np.array(pairs, np.int64).reshape(-1, 2)
        a, b = np.concatenate([tied[:, 0], ids[some]]), np.concatenate([tied[:, 1], ids[some]])
        n = np.concatenate([np.zeros(len(tied), np.int64), counts[some]])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, n)], ["a", "b", "n"])


def _asked(search: Search, itemtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows are each part of a graph with each block of queries; blocks come with the last part, and wait where
    other parts come later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_task("op4")
        shards: dict[tuple[int, int], Shard] = {}
        waiting: dict[tuple[int, int], list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("size", "shard", "part", "parts", "total", "nodes", "q_ids", "q_vectors")}
                of = row["size"], row["shard"]
                if of not in shards:
                    shards[of] = Shard(search, row["total"], row["nodes"], row["size"], np.dtype(itemtype))
                shard = shards[of]
                if shard.missing is None or row["part"] in shard.missing:
                    shard.take(row["part"], row["parts"], *(batch.column(x)[i].as_py() for x in ("ids", "copies", "vectors", "node_of", "lists", "upper")))
                blocks = waiting.setdefault(of, [])
                if row["q_ids"] is not None:
                    blocks.append((row["q_ids"], row["q_vectors"]))
                del row
                while blocks and not shard.missing:
                    ids, vectors = blocks.pop()
                    yield shard.answer(np.frombuffer(ids, np.int64), np.frombuffer(vectors, itemtype).reshape(-1, of[0]))
        if any(waiting.values()):
            raise ValueError(f"parts of graphs are missing: {[of for of, x in waiting.items() if x]}")

    return run


def usable(embedding: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


@contextmanager
def one_row_batches(spark: SparkSession) -> Iterator[None]:
    """For rows of megabytes: what is run within sends them to Python one by one."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def vector_links(vectors: DataFrame, search: Search | None = None, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Equal vectors are one entry with a count. Entries are dealt at random over shards, each shard's graph is
    built once, and every entry is a query to every shard of its dimension. Of a link's two ends either finds it; all that
    are reported are checked in double precision, or follow from the angles to a common node. Vectors that
    are null, empty, zero or not finite link with nothing, nor do those of different dimensions. A null key is left
    out: 0 links, null component, not kept. Repeated rows are one vector.
    """
    search = search or Search()
    spark = vectors.sparkSession
    itemtype = "float" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast(f"array<{itemtype}>").alias("embedding"))
    good = F.when(usable(F.col("embedding")) & F.col("vec_id").isNotNull(), F.transform("embedding", lambda x: x + F.lit(0.0).cast(itemtype)))
    rows = rows.withColumn("embedding", good)
    entries = rows.filter(F.col("embedding").isNotNull()).distinct().groupBy("embedding")
    entries = staged(entries.agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("size", F.size("embedding")))
    sizes = sorted(entries.groupBy("size").count().collect())
    shards = [search.shards_of(n, size * (4 if itemtype == "float" else 8)) for size, n in sizes]
    of_size = lambda values: F.element_at(F.map_from_arrays(F.lit([size for size, _ in sizes]), F.lit(values)), F.col("size"))
    tasks = min(max(1, sum(shards)), 10_000)
    if sizes:
        shard = F.pmod(F.xxhash64("rep"), of_size(shards).cast("long"))
        first = of_size(list(itertools.accumulate(shards, initial=0))[:-1])
    else:
        shard = first = F.lit(0).cast("long")
    task = F.pmod(first + F.col("shard"), F.lit(tasks)).cast("int")
    dealt = entries.withColumn("shard", shard).repartitionById(tasks, task).sortWithinPartitions("size", "shard", "rep")
    # a row group has few rows, as these are large
    small = {"parquet.block.size": 16_000_000, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    graphs = staged(dealt.select("size", "shard", "rep", "copies", "embedding").mapInArrow(_indexed(search), STORED), **small)
    # the whole of a graph in one task, and each block of queries read where it lies: not an equal size, which would be dealt out by it
    blocks = graphs.select(F.col("size").alias("q_size"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    met = graphs.repartitionById(tasks, task).join(blocks, F.abs(F.col("size") - F.col("q_size")) < 1)
    last = F.col("part") == F.col("parts") - 1
    met = met.select(*graphs.columns, *(F.when(last, F.col(x)).alias(x) for x in ("q_ids", "q_vectors")))
    with one_row_batches(spark):
        answered = staged(met.mapInArrow(_asked(search, "float32" if itemtype == "float" else "float64"), "a long, b long, n long"))
    counts = answered.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    labels = components(answered.filter("a != b").select("a", "b"))
    # equal vectors have equal hashes of 128 bits; vectors themselves are long
    same = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    hashed = [F.when(F.col("embedding").isNotNull(), h).alias(name) for h, name in zip(same, ("h1", "h2"), strict=True)]
    known = entries.select("rep", "copies", *same).join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component"))
    out = rows.select("vec_id", *hashed).join(known, ["h1", "h2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
