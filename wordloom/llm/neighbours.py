"""Nearest neighbours by largest inner product, with collision-counting hashing.

Published as QALSH ("Query-aware locality-sensitive hashing", Huang et al., 2015): each of
``PROJECTIONS`` random lines orders the vectors once, and a query looks at the windows around
its own place on every line. A vector within distance ``R`` lies in the window of half width
``HALF_WIDTH * R`` of a line with probability ``p``; it is a candidate as soon as it lies in
``THRESHOLD`` windows, and ``THRESHOLD`` is the largest number that a vector at distance ``R``
reaches with probability ``1 - MISSED`` at least. Virtual rehashing makes the windows of all
lines wider by ``STEP`` at a time, reading only what is new in them. Candidates are verified
on the vectors themselves, in double precision, and a query is done when its ``k`` best are
nearer than the radius of its windows. Windows end at the whole line, so that a query with
few candidates gets all of them.

The windows are wide: a neighbour lies outside of few, other vectors outside of more, and
where a window holds over half of a line, what lies outside is counted instead. The first
radius is one that the best rows so far are known to fit in, or one step less than the query before
needed; a first radius that is too large costs verifications, and no row.

Inner products become distances by a further coordinate: a vector ``x`` of a block whose
longest has norm ``M`` stands for ``(x, sqrt(M^2 - |x|^2)) / M`` and a query for ``(q, 0) / |q|``,
which are ``sqrt(2 - 2 q.x / (M |q|))`` apart.

The index is a table of blocks of up to ``BLOCK`` vectors with their sorted lines, made in the
tasks that read the vectors, without a shuffle. The queries, a stated set, meet the blocks in
tiles of a few blocks and a few chunks of queries, which bounds a task. In a tile the best
found in one block bound the windows of the next.

Vectors that are null, empty, zero or hold a null or non-finite component take no part.
Vectors are compared with those of their own length. Ids are whole numbers; ties go to the
smaller id, rows without an id last. A query does not find rows of its own id. Repeated rows
are candidates each, and queries each, so a repeated query has its rows twice. No vectors or
no queries give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.shipping import send_code
from wordloom.sources.scratch import written

PROJECTIONS = 128
HALF_WIDTH = 2.0
MISSED = 0.02
STEP = 1.08
RADII = np.append(2.0 * STEP ** -np.arange(32.0, -1, -1), np.inf)  # 2 is as far as can be
BLOCK, CHUNK = 8192, 256
BLOCKS_A_TILE, CHUNKS_A_TILE = 4, 4
SEED = 42


def _threshold() -> int:
    p, left = math.erf(HALF_WIDTH / math.sqrt(2)), 1.0
    for hits in range(PROJECTIONS + 1):
        left -= math.comb(PROJECTIONS, hits) * p**hits * (1 - p) ** (PROJECTIONS - hits)
        if left < 1 - MISSED:
            return hits
    return PROJECTIONS


THRESHOLD = _threshold()


def _lines(dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim)).standard_normal((dim + 1, PROJECTIONS))


@dataclass
class Block:
    """Vectors with, for each line, their positions in the order of their places on it."""

    ids: np.ndarray
    no_id: np.ndarray
    vectors: np.ndarray
    longest: float
    order: np.ndarray
    places: np.ndarray


def _norms(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1)
    return scale * np.sqrt(np.square(vectors / scale[:, None]).sum(axis=1))


def sorted_lines(vectors: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The longest norm of ``vectors`` and, line by line, their order and their places."""
    norms = _norms(vectors)
    longest = float(norms.max())
    further = np.sqrt(np.maximum(0, 1 - np.square(norms / longest)))
    placed = np.column_stack([vectors / longest, further]) @ _lines(vectors.shape[1])
    placed = np.ascontiguousarray(placed.T, np.float32)
    order = np.argsort(placed, axis=1, kind="stable")
    return longest, order, np.take_along_axis(placed, order, axis=1)


@dataclass
class Best:
    """The ``k`` best rows of one query so far, best first."""

    k: int
    score: np.ndarray
    no_id: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, k: int) -> Best:
        return cls(k, np.empty(0), np.empty(0, bool), np.empty(0, np.int64))

    @property
    def least(self) -> float:
        """What a row must score to be among the best."""
        return self.score[-1] if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        score = np.concatenate([self.score, score[good]])
        no_id = np.concatenate([self.no_id, no_id[good]])
        ids = np.concatenate([self.ids, ids[good]])
        first = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.no_id, self.ids = score[first], no_id[first], ids[first]


class Windows:
    """The windows of some queries on the lines of a block, step by step."""

    def __init__(self, block: Block, at: np.ndarray) -> None:
        self._block, self._at = block, at
        self._known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of each query begin and end on each line."""
        if step not in self._known:
            reach = HALF_WIDTH * RADII[step]
            lows, highs = (
                np.column_stack(
                    [
                        np.searchsorted(places, own + shift, side)
                        for places, own in zip(self._block.places, self._at.T)
                    ]
                )
                for shift, side in ((-reach, "left"), (reach, "right"))
            )
            self._known[step] = lows, highs
        return self._known[step]

    def first(self, query: int, least: int) -> int:
        """The first step whose windows hold ``least`` places in all, by bisection."""
        low, high = 0, len(RADII) - 1
        while low < high:
            middle = (low + high) // 2
            lows, highs = self.at(middle)
            if (highs[query] - lows[query]).sum() >= least:
                high = middle
            else:
                low = middle + 1
        return low

    def collisions(self, query: int, step: int) -> np.ndarray:
        """For each vector, the number of windows of ``query`` it lies in."""
        lows, highs = (edges[query] for edges in self.at(step))
        n = len(self._block.ids)
        wide = 2 * (highs - lows) > n
        rows = list(zip(self._block.order, lows.tolist(), highs.tolist(), wide.tolist()))
        parts = [row[low:high] for row, low, high, out in rows if not out]
        counts = np.bincount(np.concatenate(parts), minlength=n) if parts else np.zeros(n, np.int64)
        parts = [row[:low] for row, low, _, out in rows if out]
        parts += [row[high:] for row, _, high, out in rows if out]
        if parts:
            counts -= np.bincount(np.concatenate(parts), minlength=n)
        return counts + int(wide.sum())

    def further(self, query: int, step: int) -> np.ndarray:
        """What ``step`` adds to the collisions of the step before."""
        (old_lows, old_highs), (lows, highs) = (
            tuple(edges[query].tolist() for edges in self.at(s)) for s in (step - 1, step)
        )
        parts = [row[a:b] for row, a, b in zip(self._block.order, lows, old_lows)]
        parts += [row[a:b] for row, a, b in zip(self._block.order, old_highs, highs)]
        return np.bincount(np.concatenate(parts), minlength=len(self._block.ids))


def search_block(
    block: Block, query_ids: np.ndarray, no_query_id: np.ndarray, queries: np.ndarray, best: list[Best]
) -> int:
    """Add what ``queries`` find in ``block`` to ``best``; returns how many rows were verified."""
    lengths, verified, last = _norms(queries), 0, None
    at = (queries / lengths[:, None]) @ _lines(queries.shape[1])[:-1]
    windows = Windows(block, at.astype(np.float32))
    # A row within the radius of a step scores at least this.
    floors = block.longest * lengths[:, None] * (1 - np.square(RADII) / 2)
    for q, found in enumerate(best):
        if found.least > -np.inf:
            start = int(np.argmax(floors[q] <= found.least))
        elif last is not None:
            start = max(0, last - 1)
        else:
            start = windows.first(q, found.k * THRESHOLD)
        seen = np.zeros(len(block.ids), bool)
        if not no_query_id[q]:
            seen |= (block.ids == query_ids[q]) & ~block.no_id
        counts = windows.collisions(q, start)
        for step in range(start, len(RADII)):
            if step > start:
                counts += windows.further(q, step)
            fresh = np.flatnonzero((counts >= THRESHOLD) & ~seen)
            seen[fresh] = True
            verified += len(fresh)
            found.add(block.vectors[fresh] @ queries[q], block.no_id[fresh], block.ids[fresh])
            last = step
            if found.least >= floors[q, step]:
                break
    return verified


def _packed(vectors: DataFrame, kind: np.dtype, rows: int, lined: bool) -> DataFrame:
    """``(dim, ids, vectors)`` with up to ``rows`` of ``(id, vector)`` each; ``lined``: with lines."""
    columns = "dim int, ids array<bigint>, vectors binary"
    if lined:
        columns += ", longest double, order binary, places binary"

    def packed(ids: list[pa.Array], parts: list[np.ndarray], dim: int) -> pa.RecordBatch:
        flat = np.concatenate(parts)
        held = pa.concat_arrays(ids)
        made = [
            pa.array([dim], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
            pa.array([flat.tobytes()], pa.binary()),
        ]
        names = ["dim", "ids", "vectors"]
        if lined:
            longest, order, places = sorted_lines(flat.astype(np.float64))
            made += [
                pa.array([longest], pa.float64()),
                pa.array([order.astype(np.uint16 if rows <= 65536 else np.uint32).tobytes()], pa.binary()),
                pa.array([places.tobytes()], pa.binary()),
            ]
            names += ["longest", "order", "places"]
        return pa.RecordBatch.from_arrays(made, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list[pa.Array], list[np.ndarray]]] = {}
        n = 0
        for batch in batches:
            dims = batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(dims):
                own = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
                flat = own.column(1).flatten().to_numpy().astype(kind).reshape(-1, dim)
                ids, parts = waiting.setdefault(int(dim), ([], []))
                at = 0
                while at < len(flat):
                    take = min(len(flat) - at, rows - sum(map(len, ids)))
                    ids.append(own.column(0).slice(at, take))
                    parts.append(flat[at : at + take])
                    at, n = at + take, n + take
                    if sum(map(len, ids)) == rows:
                        yield packed(ids, parts, int(dim))
                        ids.clear(), parts.clear()
                        n -= rows
            if n >= 2 * rows:  # of many lengths
                for dim, (ids, parts) in waiting.items():
                    if ids:
                        yield packed(ids, parts, dim)
                waiting, n = {}, 0
        for dim, (ids, parts) in waiting.items():
            if ids:
                yield packed(ids, parts, dim)

    return vectors.mapInArrow(run, columns)


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, np.dtype]:
    found = F.col(f"`{vector}`")
    element = vectors.select(found).schema[0].dataType.elementType.simpleString()
    single = element == "float"
    if not single:
        found = F.transform(found, lambda x: x.cast("double"))
    table = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), found.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    table = table.where(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return table, np.dtype("<f4" if single else "<f8")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    no_id = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), no_id


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The blocks of all vectors with their sorted lines, written to the shared folder."""
    send_code(vectors.sparkSession)
    table, kind = _usable(vectors, vec_id, vector)
    found = _packed(table, kind, block, lined=True)
    return written(found.withColumn("block", F.monotonically_increasing_id()), "vector-index")


def nearest(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: up to ``k`` rows of ``vectors`` for each of ``queries``."""
    send_code(queries.sparkSession)
    index = build_index(vectors, vec_id, vector, block)
    wanted, query_kind = _usable(queries, vec_id, vector)
    chunks = _packed(wanted, query_kind, chunk, lined=False)
    chunks = written(chunks.withColumn("chunk", F.monotonically_increasing_id()), "vector-queries")
    kind = _usable(vectors, vec_id, vector)[1]
    place = np.dtype(np.uint16 if block <= 65536 else np.uint32)
    block_groups = max(1, -(-index.count() // BLOCKS_A_TILE))
    chunk_groups = max(1, -(-chunks.count() // CHUNKS_A_TILE))

    def dealt(name: str, groups: int):
        return F.pmod(F.xxhash64(name), F.lit(groups)).cast("int")

    def all_of(groups: int):
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    left = index.withColumn("bg", dealt("block", block_groups)).withColumn("cg", all_of(chunk_groups))
    right = chunks.withColumn("cg", dealt("chunk", chunk_groups)).withColumn("bg", all_of(block_groups))

    def search(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        best: list[list[Best]] = []
        groups = []
        for row in range(asked.num_rows):
            ids, no_id = _ids(asked["ids"][row].values)
            flat = np.frombuffer(asked["vectors"][row].as_py(), query_kind).reshape(len(ids), -1)
            groups.append((ids, no_id, flat.astype(np.float64)))
            best.append([Best.none(k) for _ in ids])
        for row in range(blocks.num_rows):
            ids, no_id = _ids(blocks["ids"][row].values)
            flat = np.frombuffer(blocks["vectors"][row].as_py(), kind).reshape(len(ids), -1)
            order = np.frombuffer(blocks["order"][row].as_py(), place).reshape(PROJECTIONS, -1)
            places = np.frombuffer(blocks["places"][row].as_py(), np.float32).reshape(PROJECTIONS, -1)
            held = Block(
                ids, no_id, flat.astype(np.float64), blocks["longest"][row].as_py(), order.astype(np.intp), places
            )
            for (query_ids, no_query_id, vectors_of), found in zip(groups, best):
                search_block(held, query_ids, no_query_id, vectors_of, found)
        rows = [
            (asked["chunk"][row].as_py(), at, None if gone else int(query_id), found)
            for row, ((ids, no_id, _), own) in enumerate(zip(groups, best))
            for at, (query_id, gone, found) in enumerate(zip(ids, no_id, own))
        ]
        sizes = [len(r[3].ids) for r in rows]
        repeated = lambda column, type_: pa.array(column, type_).take(
            pa.array(np.repeat(np.arange(len(rows)), sizes))
        )
        every = lambda name, kind_: np.concatenate(
            [np.empty(0, kind_), *[getattr(r[3], name) for r in rows]]
        )
        made = {
            "chunk": repeated([r[0] for r in rows], pa.int64()),
            "at": repeated([r[1] for r in rows], pa.int32()),
            "query_id": repeated([r[2] for r in rows], pa.int64()),
            "vec_id": pa.array(every("ids", np.int64), pa.int64(), mask=every("no_id", bool)),
            "score": pa.array(every("score", np.float64), pa.float64()),
        }
        return pa.table(made)

    keys = ["dim", "bg", "cg"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(search, "chunk bigint, at int, query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("chunk", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
