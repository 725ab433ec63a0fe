"""Exact top-k inner-product search with a KD-tree per shard.

Space is cut into cells by median splits over a bounded sample, and a cell into shards by a hash, so a shard has some ten
thousand vectors however many equal ones there are, and shards of different cells have different boxes. A shard's tree splits
at the median of the widest dimension down to leaves, by position and not by value, and every node keeps its tight
box. The sum over dimensions of the larger of q x low and q x high bounds the product of a query with whatever lies in a box.

Queries go through a tree in blocks, best first: of all nodes that wait, the one with the highest bound is next; a query
goes on into a node only while its bound there reaches the query's kth score so far. Each query first searches the shard it
lies in. The kth score found there goes along: a query is sent to the shards of another cell only if the cell's box can
reach it, and starts there with that score as its floor.

A task reads the vectors of a shard, builds the tree and then streams the queries past it; vectors are moved once for
each `block` queries of the whole run. Only each shard's k best of a query leave a task.

Vectors that are null or hold null or non-finite components take no part. Vectors are compared with those of their own
length. Ties go to the smaller vec_id. Rows without a vec_id take no part. Repeated rows of one vec_id are candidates
each, and never of a query with that vec_id. Products of 2**53 and more are worked out in integers of any size, vector by
vector; scores beyond a long are held to its range. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import Workspace


@dataclass(frozen=True)
class Search:
    """scale: components become floor(scale * x). every: vec_ids divisible by it are queries. shard: vectors of a shard, as
    expected from the hash that deals them. cells: at most, and sample: vectors a cell that the splits are made from. block: queries
    for which vectors are moved once. leaf: vectors of a leaf. together: queries that go through a tree as one block."""

    k: int = 20
    scale: int = 64
    every: int = 20
    shard: int = 16384
    cells: int = 1024
    sample: int = 16
    block: int = 262_144
    leaf: int = 128
    together: int = 256


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    return np.floor(scale * np.asarray(column.flatten(), dtype=np.float64)).reshape(len(column), -1)


class Tree:
    """A KD-tree over integer vectors: node n has a box and the smallest vec_id in it, and either two children or, in order of
    vec_id, the vectors of a leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int):
        self.low, self.high, self.least, self.children, self.leaves, self.cut = [], [], [], [], [], []
        waiting = [(np.argsort(ids, kind="stable"), None)]
        while waiting:
            rows, parent = waiting.pop()
            node, inside = len(self.low), vectors[rows]
            if parent is not None:
                self.children[parent].append(node)
            lo, hi = inside.min(0), inside.max(0)
            self.low.append(lo)
            self.high.append(hi)
            self.least.append(ids[rows].min())
            self.children.append([])
            if len(rows) <= leaf:
                rows = rows[np.argsort(ids[rows], kind="stable")]
                self.leaves.append((ids[rows], vectors[rows]))
                self.cut.append(None)
                continue
            wide = int(np.argmax(hi - lo))
            order = np.argsort(inside[:, wide], kind="stable")
            half = len(rows) // 2
            self.leaves.append(None)
            self.cut.append((wide, inside[order[half], wide]))
            waiting += [(np.sort(rows[order[half:]]), node), (np.sort(rows[order[:half]]), node)]  # the lower half is taken next

    def places(self, queries: np.ndarray) -> np.ndarray:
        """A number for each query that is equal for those that lie in the same leaf and near for those in near ones."""
        place = np.zeros(len(queries), np.int64)
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            node, rows = waiting.pop()
            place[rows] = node
            if len(rows) and self.cut[node] is not None:
                upper = queries[rows, self.cut[node][0]] >= self.cut[node][1]
                waiting += zip(self.children[node], (rows[~upper], rows[upper]), strict=True)
        return place


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, together: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, vec_id, score) of each query's k best in the tree; scores below `floor` may be left out."""
    order = np.argsort(tree.places(queries), kind="stable")
    found = []
    for a in range(0, len(order), together):
        rows = order[a : a + together]
        row, name, score = _best_first(tree, query_ids[rows], queries[rows], floor[rows], k)
        found.append((rows[row], name, score))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _best_first(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    worst = np.iinfo(np.int64).max
    best, name = np.full((len(queries), k), -np.inf), np.full((len(queries), k), worst)
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    waiting: list[tuple] = []

    def wait(node: int, rows: np.ndarray) -> None:
        bound = plus[rows] @ tree.high[node] + minus[rows] @ tree.low[node]
        heapq.heappush(waiting, (-bound.max(), node, rows, bound))

    wait(0, np.arange(len(queries)))
    while waiting:
        _, node, rows, bound = heapq.heappop(waiting)
        kth = best[rows, -1]
        # a box whose vectors could at best equal the kth score matters only if one of them has a smaller vec_id
        stay = (bound >= np.maximum(kth, floor[rows])) & ((bound > kth) | (tree.least[node] < name[rows, -1]))
        rows = rows[stay]
        if not len(rows):
            continue
        if tree.leaves[node] is None:
            for child in tree.children[node]:
                wait(child, rows)
            continue
        ids, vectors = tree.leaves[node]
        score = queries[rows] @ vectors.T
        score[(query_ids[rows][:, None] == ids) | (score < floor[rows][:, None])] = -np.inf
        some = score.max(1) >= best[rows, -1]
        rows, score = rows[some], score[some]
        if len(rows):
            scores = np.concatenate([best[rows], score], axis=1)
            names = np.concatenate([name[rows], np.broadcast_to(ids, score.shape)], axis=1)
            names[scores == -np.inf] = worst
            top = np.lexsort((names, -scores), axis=1)[:, :k]
            best[rows], name[rows] = np.take_along_axis(scores, top, 1), np.take_along_axis(names, top, 1)
    row, place = np.nonzero(best > -np.inf)
    return row, name[row, place], best[row, place]


def _by_integers(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[list, list, list]:
    """The same by exact integers of any size, without a tree."""
    whole = [[int(x) for x in v] for v in vectors.tolist()]
    out = ([], [], [])
    for q, vector in enumerate(queries.tolist()):
        own = [int(x) for x in vector]
        scores = ((-sum(a * b for a, b in zip(own, v, strict=True)), i) for v, i in zip(whole, ids.tolist(), strict=True) if i != query_ids[q])
        for s, i in heapq.nsmallest(k, scores):
            for x, value in zip(out, (q, i, max(-(1 << 63), min((1 << 63) - 1, -s))), strict=True):
                x.append(value)
    return out


_FOUND = "query_id long, vec_id long, score long"
_TO_SHARDS = "shard string, asks boolean, vec_id long, embedding array<{}>, floor long"


def _searcher(conf: Search):
    """Rows in order of (shard, asks): a shard's vectors, and then the queries that it is asked."""

    def answer(tree: Tree | None, ids: np.ndarray, vectors: np.ndarray, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        query_ids, queries, floor = np.asarray(rows.column("vec_id")), _matrix(rows.column("embedding"), conf.scale), np.asarray(rows.column("floor"))
        size = np.abs(queries).max(1) * np.abs(vectors).max() * vectors.shape[1]
        exact = size < 2.0**53
        if exact.any():
            at = np.flatnonzero(exact)
            row, name, score = search(tree, query_ids[at], queries[at], floor[at].astype(np.float64), conf.k, conf.together)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[at][row]), pa.array(name), pa.array(score.astype(np.int64))], ["query_id", "vec_id", "score"])
        if not exact.all():
            at = np.flatnonzero(~exact)
            row, name, score = _by_integers(ids, vectors, query_ids[at], queries[at], conf.k)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[at][row]), pa.array(name, pa.int64()), pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tree, ids, vectors = None, [], None, None, None
        for batch in batches:
            names, asks = batch.column("shard").to_pylist(), batch.column("asks").to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if (names[i], asks[i]) != (names[i - 1], asks[i - 1])), len(names)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if names[a] != shard:
                    shard, parts, tree = names[a], [], None
                rows = batch.slice(a, b - a)
                if not asks[a]:
                    parts.append((np.asarray(rows.column("vec_id")), _matrix(rows.column("embedding"), conf.scale)))
                    continue
                if tree is None and parts:
                    ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
                    parts, tree = [], Tree(ids, vectors, conf.leaf)
                if tree is not None:
                    yield from answer(tree, ids, vectors, rows)

    return run


class Cells:
    """Median splits of a sample; vectors of another length than most are in the one cell -1 of theirs."""

    def __init__(self, sample: np.ndarray, number: int):
        self.width, self.depth = sample.shape[1], max(0, (number - 1).bit_length())
        self.dimension, self.value = np.zeros((1 << self.depth) - 1, np.int64), np.zeros((1 << self.depth) - 1)
        groups = [sample]
        for node in range(len(self.dimension)):
            inside = groups[node]
            if len(inside):
                wide = int(np.argmax(inside.max(0) - inside.min(0)))
                self.dimension[node], self.value[node] = wide, np.median(inside[:, wide])
            upper = inside[:, self.dimension[node]] > self.value[node]
            groups += [inside[~upper], inside[upper]]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), np.int64)
        for _ in range(self.depth):
            upper = vectors[np.arange(len(vectors)), self.dimension[node]] > self.value[node]
            node = 2 * node + 1 + upper
        return node - len(self.dimension)


def _by_width(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(width, rows) of vectors of equal length."""
    width = np.asarray(column.value_lengths())
    for w in np.unique(width):
        yield int(w), np.flatnonzero(width == w)


def _dealer(cells: Cells | None, conf: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.full(batch.num_rows, -1, np.int64)
            for width, rows in _by_width(batch.column("embedding")):
                if cells is not None and width == cells.width:
                    cell[rows] = cells.of(_matrix(batch.column("embedding").take(pa.array(rows)), conf.scale))
            yield batch.append_column("cell", pa.array(cell))

    return run


def _boxer(width: int, conf: Search):
    """A task's own boxes of the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cell = np.asarray(batch.column("cell"))
            for c in np.unique(cell):
                inside = _matrix(batch.column("embedding").take(pa.array(np.flatnonzero(cell == c))), conf.scale)
                lo, hi = boxes.get(int(c), (inside[0], inside[0]))
                boxes[int(c)] = np.minimum(lo, inside.min(0)), np.maximum(hi, inside.max(0))
        for c, (lo, hi) in boxes.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * width), pa.array(range(width)), pa.array(lo), pa.array(hi)], ["cell", "dimension", "low", "high"])

    return run


def _router(boxes: dict[int, tuple[np.ndarray, np.ndarray]], parts: dict[tuple[int, int], int], conf: Search):
    """Queries to the shards that their own one leaves open: those of their length in every cell that can reach their floor."""
    names = [c.split()[0] for c in _TO_SHARDS.split(", ")]
    low, high = (np.asarray([boxes[c][k] for c in sorted(boxes)]) for k in (0, 1))
    number = {c: i for i, c in enumerate(sorted(boxes))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows in _by_width(batch.column("embedding")):
                own = batch.take(pa.array(rows))
                queries, floor = _matrix(own.column("embedding"), conf.scale), np.asarray(own.column("floor")).astype(np.float64)
                bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T if boxes and low.shape[1] == width else None
                home, turn = own.column("shard").to_pylist(), own.column("turn").to_pylist()
                for (w, cell), n in parts.items():
                    if w != width:
                        continue
                    # rounding of large products may take a bound down by this much
                    open_ = np.arange(len(rows)) if bound is None or cell not in number else np.flatnonzero(bound[:, number[cell]] * (1 + 1e-9 * np.sign(bound[:, number[cell]])) >= floor)
                    for part in range(n):
                        name = f"{w}:{cell}:{part}"
                        to = [int(i) for i in open_ if home[i] != name]
                        if to:
                            some = own.take(pa.array(to))
                            yield pa.RecordBatch.from_arrays([pa.array([f"{name}:{turn[i]}" for i in to]), pa.array([True] * len(to)), *(some.column(c) for c in names[2:])], names)

    return run


def _searched(rows: DataFrame, conf: Search) -> DataFrame:
    return rows.repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(_searcher(conf), _FOUND)


def top_k(vectors: DataFrame, conf: Search = Search()) -> DataFrame:
    """`vectors(vec_id, embedding)` to `(query_id, rank, vec_id, score)`."""
    work = Workspace(vectors.sparkSession, "kdtree")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # single precision stays as it is on the way, and is made double before anything is worked out
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = usable.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)

    # cells from a bounded sample; one cell needs none
    n = usable.count()
    wanted, cells = min(conf.cells, -(-n // conf.shard)), None
    if wanted > 1:
        some = [np.floor(conf.scale * np.asarray(r[0], np.float64)) for r in usable.orderBy(F.xxhash64("vec_id"), "vec_id").select("embedding").limit(conf.sample * wanted).collect()]
        width = Counter(map(len, some)).most_common(1)[0][0]
        cells = Cells(np.asarray([v for v in some if len(v) == width]), wanted)
    dealt = work.keep(usable.mapInArrow(_dealer(cells, conf), f"vec_id long, embedding array<{kind}>, cell long"), "dealt")
    dealt = dealt.withColumn("width", F.size("embedding"))
    # a row for each length and cell; lengths are few
    parts = {(r.width, r.cell): -(-r["n"] // conf.shard) for r in dealt.groupBy("width", "cell").agg(F.count("*").alias("n")).collect()}
    boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if cells is not None:
        own = dealt.filter((F.col("width") == cells.width) & (F.col("cell") >= 0)).mapInArrow(_boxer(cells.width, conf), "cell long, dimension long, low double, high double")
        rows = own.groupBy("cell", "dimension").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        for r in rows.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("dimension", "low", "high"))).alias("b")).collect():
            boxes[r.cell] = np.asarray([x.low for x in r.b]), np.asarray([x.high for x in r.b])
    counts = dealt.sparkSession.createDataFrame([(w, c, p) for (w, c), p in parts.items()], "width int, cell long, parts int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))
    placed = dealt.join(F.broadcast(counts), ["width", "cell"]).withColumn("shard", F.concat_ws(":", "width", "cell", part))
    asked = placed.filter(F.col("vec_id") % conf.every == 0).dropDuplicates(["vec_id", "embedding"])
    turns = max(1, -(-asked.count() // conf.block)) if n else 1
    asked = asked.withColumn("turn", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(turns)))

    low = F.lit(-(1 << 62)).cast("long")
    to = lambda rows, shard, asks, floor: rows.select(shard.alias("shard"), F.lit(asks).alias("asks"), "vec_id", "embedding", floor.alias("floor"))
    home = _searched(to(placed, F.col("shard"), False, low).union(to(asked, F.col("shard"), True, low)), conf)
    found = home = work.keep(home, "home")
    if sum(parts.values()) > 1:
        kth = home.groupBy("query_id").agg(F.count("*").alias("m"), F.min("score").alias("kth"))
        known = asked.join(kth, asked["vec_id"] == kth["query_id"], "left").withColumn("floor", F.when(F.col("m") >= conf.k, F.col("kth")).otherwise(low))
        away = known.select("shard", "turn", "vec_id", "embedding", "floor").mapInArrow(_router(boxes, parts, conf), _TO_SHARDS.format(kind))
        copies = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        found = home.union(_searched(to(copies, F.concat_ws(":", "shard", "turn"), False, low).union(away), conf))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= conf.k).select("query_id", "rank", "vec_id", "score")


#: The same in SQL by comparing every query with every row.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
