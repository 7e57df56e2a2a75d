"""Exact top-k by inner product: queries and data in cover trees, walked together, pruned by covering radii."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged

LEAF = 64
CELLS = 32
DATA_ROWS = 8192
QUERY_ROWS = 2048
LEVELS = 12
SPREAD = 8
EXACT = 1 << 52
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NO_ID = np.iinfo(np.int64).max


@dataclass
class Node:
    """rows: the points below; every one is within radius of centre."""

    rows: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, centre: int | None = None) -> Node:
    """A cover tree of the rows of x: each level's centres are points more than half the parent's radius apart, and each
    point is below the nearest of them. Nodes of LEAF points or of equal points are leaves."""
    rows = np.arange(len(x)) if rows is None else rows
    c = x[rows[0] if centre is None else centre].astype(float)
    far = np.sqrt(((x[rows] - c) ** 2).sum(axis=1))
    radius = float(far.max(initial=0.0))
    node = Node(rows, c, radius * (1 + 1e-12))
    if len(rows) <= LEAF or radius == 0:
        return node
    nearest, owner, centres = far, np.zeros(len(rows), np.int64), [int(np.argmin(far))]
    while nearest.max() > radius / 2 and len(centres) < 32:
        new = int(np.argmax(nearest))
        to_new = np.sqrt(((x[rows] - x[rows[new]].astype(float)) ** 2).sum(axis=1))
        closer = to_new < nearest
        owner[closer], nearest = len(centres), np.minimum(nearest, to_new)
        centres.append(new)
    for k, at in enumerate(centres):
        own = rows[owner == k]
        if len(own):
            node.children.append(cover_tree(x, own, int(rows[at])))
    return node


class Best:
    """The k best (score, then smaller id) of each query so far; a place not yet taken has NO_ID."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.score = np.full((n, k), LEAST, dtype=np.int64)
        self.id = np.full((n, k), NO_ID, dtype=np.int64)
        self.taken = np.zeros((n, k), dtype=bool)
        self.floor = np.full(n, -np.inf) if floor is None else floor

    def worst(self, rows: np.ndarray) -> float:
        """The least score that could still change any of these queries' results."""
        last = np.where(self.taken[rows, -1], self.score[rows, -1].astype(float), -np.inf)
        return float(np.maximum(last, self.floor[rows]).min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """scores: rows x candidates; own marks those that are no candidates, the query itself."""
        s = np.concatenate([self.score[rows], scores], axis=1)
        i = np.concatenate([self.id[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        t = np.concatenate([self.taken[rows], ~own], axis=1)
        order = np.lexsort((i, ~s, ~t), axis=1)[:, : self.score.shape[1]]  # ~s falls as s rises, and no long overflows
        self.score[rows], self.id[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        self.taken[rows] = np.take_along_axis(t, order, 1)


def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products. Doubles hold them exactly below 2**52; larger ones are made of whole numbers, and those
    that no long holds end at LEAST or MOST."""
    high = float(np.sqrt((q.astype(float) ** 2).sum(1).max(initial=0) * (x.astype(float) ** 2).sum(1).max(initial=0)))
    if high < EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    whole = q.astype(object) @ x.astype(object).T
    return np.minimum(np.maximum(whole, LEAST), MOST).astype(np.int64)


def dual_search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Walk both trees at once, best pairs first; a pair is left out if no point below could enter any query's results.

    The most that a query and a point below the two nodes can score is c.d + |c| r + |d| s + r s, with centres c, d
    and radii s, r. Ties are kept, for a smaller id may still enter. Gives the number of leaf pairs scored.
    """
    done = 0

    def most(a: Node, b: Node) -> float:
        c, d = a.centre, b.centre
        bound = c @ d + np.linalg.norm(c) * b.radius + np.linalg.norm(d) * a.radius + a.radius * b.radius
        return float(bound) + 1e-9 * abs(float(bound)) + 1e-6

    top = cover_tree(q), cover_tree(x)
    stack = [(most(*top), *top)]
    while stack:
        bound, a, b = stack.pop()
        if bound < best.worst(a.rows):
            continue
        if not a.children and not b.children:
            for part in range(0, len(b.rows), 1024):
                at = b.rows[part: part + 1024]
                s = product(q[a.rows], x[at])
                best.add(a.rows, s, ids[at], q_ids[a.rows][:, None] == ids[at][None, :])
            done += 1
            continue
        pairs = [(most(u, v), u, v) for u in a.children or [a] for v in b.children or [b]]
        stack.extend(sorted(pairs, key=lambda p: p[0]))
    return done


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim): floor(256 * x) of each component; vectors that are null, empty or hold null or non-finite are left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.floor(c * 256).cast("long"))
    return vectors.select("vec_id", "embedding").filter(
        F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine).select(
        "vec_id", v.alias("v"), F.size("embedding").alias("dim"))


def _drawn(rows: DataFrame, big: DataFrame, cells: int, draw: Column) -> DataFrame:
    """(path, pivots): of a sample of each big cell, SPREAD * cells vectors at most, the up to cells that lie farthest apart.

    Each next pivot is the sampled vector farthest from those before, so a group of vectors apart from the others gets its own.
    """
    most = SPREAD * cells
    share = F.lit(float(1 << 40)) * 2 * most / F.col("n")
    low = draw.bitwiseAND(F.lit((1 << 40) - 1))
    first = F.slice(F.array_sort(F.collect_list(F.struct(low.alias("draw"), "v"))), 1, most)
    sample = rows.join(big, "path").filter(low < share).groupBy("path").agg(F.transform(first, lambda e: e.v).alias("sample"))

    def apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            chosen = []
            for own in batch["sample"]:
                x = np.stack([np.asarray(v, dtype=float) for v in own])
                taken, near = [0], ((x - x[0]) ** 2).sum(1)
                while len(taken) < cells and near.max() > 0:
                    taken.append(int(near.argmax()))
                    near = np.minimum(near, ((x - x[taken[-1]]) ** 2).sum(1))
                chosen.append([own[k] for k in taken])
            yield pd.DataFrame({"path": batch.path, "pivots": chosen})

    return sample.mapInPandas(apart, "path string, pivots array<array<long>>")


def _nearest(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """Rows (path, part) with the path of their nearest pivot's cell. A task holds one part and its cell's pivots."""
    def assigned(own: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        if own.empty or of.empty:
            return own.head(0).drop(columns="part")
        x, p = np.stack(own.v).astype(float), np.stack([np.asarray(v, dtype=float) for v in of.pivots.iloc[0]])
        nearest = np.argmin((p * p).sum(1)[None, :] - 2 * x @ p.T, axis=1)
        return own.drop(columns="part").assign(path=[f"{a}.{b}" for a, b in zip(own.path, nearest)])

    key = ["path", "part"]
    shape = "path string, vec_id long, v array<long>, is_query boolean"
    return rows.select("path", "vec_id", "v", "is_query", "part").groupBy(*key).cogroup(pivots.groupBy(*key)).applyInPandas(assigned, shape)


def in_cells(rows: DataFrame, most: int, cells: int, seed: int) -> tuple[DataFrame, int]:
    """(path, block, vec_id, v, is_query) of rows (dim, vec_id, v, is_query), and how deep the deepest path is.

    The upper levels of a cover tree, one level a pass: a cell of more than most rows is cut into the cells of its pivots, so
    radii shrink as cells become many. A path is the dimension and the cell's number on each level. Only a cell
    whose drawn vectors are all equal, or one LEVELS deep, is cut by a hash into blocks of about most rows instead.
    """
    rows = staged(rows.select(F.col("dim").cast("string").alias("path"), "vec_id", "v", "is_query"))
    done = []
    for level in range(LEVELS + 1):
        draw = F.xxhash64(F.lit(seed + level), "vec_id", "v")
        sizes = staged(rows.groupBy("path").agg(F.count("*").alias("n")))
        big = sizes.filter(F.col("n") > most)
        pivots = staged(_drawn(rows, big, cells if level < LEVELS else 0, draw).filter(F.size("pivots") > 1))
        parts = big.withColumn("parts", F.ceil(F.col("n") / most).cast("int"))
        cut = sizes.join(pivots, "path", "left_anti").select("path", F.ceil(F.col("n") / most).cast("int").alias("parts"))
        part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int")
        done.append(rows.join(cut, "path").select(
            "path", F.concat("path", F.lit("#"), part.cast("string")).alias("block"), "vec_id", "v", "is_query"))
        if pivots.isEmpty():
            return staged(functools.reduce(DataFrame.union, done)), level
        open_cells = pivots.join(parts, "path")
        each = open_cells.select("path", "pivots", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        rows = staged(_nearest(rows.join(open_cells.select("path", "parts"), "path").withColumn("part", part), each))
    raise AssertionError("the last level draws no pivots")


def _mean(rows: DataFrame, key: list[str], total: str = "total") -> DataFrame:
    """(key, n, centre) of rows (key, n, total): sums of vectors added up component by component."""
    return (
        rows.select(*key, "n", F.posexplode(total).alias("k", "x")).groupBy(*key, "k")
        .agg(F.sum("n").alias("n"), (F.sum("x") / F.sum("n")).alias("x")).groupBy(*key)
        .agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda e: e.x).alias("centre")))


def _gap(a: str, b: str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))


def block_balls(placed: DataFrame) -> DataFrame:
    """(node, parent, n, centre, radius) of each block, merged from what each batch of its rows gives."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, block), own in batch.groupby(["path", "block"], sort=True):
                yield pd.DataFrame([(path, block, len(own), np.stack(own.v).astype(float).sum(axis=0))],
                                   columns=["parent", "node", "n", "total"])
    found = placed.select("path", "block", "v").mapInPandas(sums, "parent string, node string, n long, total array<double>")
    centre = staged(_mean(found, ["node", "parent"]))
    far = placed.select(F.col("block").alias("node"), "v").join(centre, "node").groupBy("node").agg(
        (F.max(_gap("v", "centre")) * (1 + 1e-9)).alias("radius"))
    return staged(centre.join(far, "node"))


def tree_balls(blocks: DataFrame, depth: int) -> DataFrame:
    """The blocks' balls and those of all cells above them: each holds the balls of its children."""
    blocks = blocks.select("node", "parent", "n", "centre", "radius", F.lit(True).alias("leaf"))
    every, below = [blocks], {}
    level = F.size(F.split("parent", "\\."))
    for at in range(depth + 1, 0, -1):
        own = blocks.filter(level == at)
        children = own.union(below[at]) if at in below else own
        centre = _mean(children.withColumn("total", F.transform("centre", lambda x: x * F.col("n"))), ["parent"])
        held = children.select("parent", F.col("centre").alias("c"), F.col("radius").alias("r")).join(centre, "parent").groupBy("parent").agg(
            (F.max(_gap("c", "centre") + F.col("r")) * (1 + 1e-9)).alias("radius"))
        cells = staged(centre.join(held, "parent").select(
            F.col("parent").alias("node"), F.when(F.instr("parent", ".") > 0, F.regexp_replace("parent", r"\.[^.]*$", "")).alias("parent"),
            "n", "centre", "radius", F.lit(False).alias("leaf")))
        every.append(cells)
        below[at - 1] = cells
    return staged(functools.reduce(DataFrame.union, every))


def meetings_within(queries: DataFrame, tree: DataFrame, depth: int) -> DataFrame:
    """(q_block, d_block): the pairs that may hold a result, found down the tree.

    queries (q_block, root, qc, qr, least): balls of query blocks, and the least floor of their queries. A pair of a block and a cell
    whose best possible score stays below that floor ends there, with all that is below the cell.
    """
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    most = dot("qc", "centre") + F.sqrt(dot("qc", "qc")) * F.col("radius") + F.sqrt(dot("centre", "centre")) * F.col("qr") + F.col("qr") * F.col("radius")
    pairs, found = queries.select("q_block", F.col("root").alias("at")), []
    for level in range(1, depth + 2):
        children = tree.filter(F.size(F.split("parent", "\\.")) == level)
        met = staged(
            pairs.join(children, F.col("at") == F.col("parent")).join(queries, "q_block")
            .filter(most + F.abs(most) * 1e-9 + 1e-6 >= F.col("least")).select("q_block", F.col("node").alias("at"), "leaf"))
        found.append(met.filter("leaf").select("q_block", F.col("at").alias("d_block")))
        pairs = met.filter("not leaf").select("q_block", "at")
    return functools.reduce(DataFrame.union, found)


RESULT = "query_id long, vec_id long, score long"


def _searched(meetings: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The k best of each query (q_block, vec_id, v, floor) within each meeting of a query block and a data block."""
    key, other = ["q_block", "d_block"], ["r_q", "r_d"]
    left = meetings.select(*key).join(queries.select("q_block", "vec_id", "v", "floor"), "q_block")
    right = meetings.select(F.col("q_block").alias("r_q"), F.col("d_block").alias("r_d")).join(
        data.select(F.col("block").alias("r_d"), "vec_id", "v"), "r_d")

    def search(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if q.empty or d.empty:
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        q, d = q.sort_values("vec_id"), d.sort_values("vec_id")
        best = Best(len(q), k, q.floor.to_numpy(dtype=float))
        dual_search(np.stack(q.v), q.vec_id.to_numpy(), np.stack(d.v), d.vec_id.to_numpy(), best)
        at, rank = np.nonzero(best.taken)
        return pd.DataFrame({"query_id": q.vec_id.to_numpy()[at], "vec_id": best.id[at, rank], "score": best.score[at, rank]})

    return left.groupBy(*key).cogroup(right.groupBy(*other)).applyInPandas(search, RESULT)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, gathered by partial aggregation: at most k rows of each meeting."""
    order = F.array_sort(F.collect_set(F.struct(F.bitwise_not("score").alias("less"), "vec_id")))
    return found.groupBy("query_id").agg(F.slice(order, 1, k).alias("best"))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, cells: int = CELLS, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products over all other vectors.

    vectors (vec_id, embedding) become whole numbers. Queries and data have a tree each. Its upper levels are cells around
    pivots (in_cells), down to blocks of bounded size; the lower levels are cover trees built in the tasks.
    Every query first meets the data block of its own cell, which gives it a floor for its kth score. Then each query block goes
    down the data tree and meets the blocks whose covering radii let them reach the least floor of its queries.

    Scores are exact over the whole range of a long; those beyond it end at its ends. Ties go to smaller ids. Vectors of another
    dimension than a query's are no candidates. Rows that repeat an id with an equal vector count once. Queries
    without candidates give no rows.
    """
    rows = staged(whole_vectors(vectors).withColumn("is_query", F.coalesce(is_query, F.lit(False))).dropDuplicates(["vec_id", "v"]))
    data, depth = in_cells(rows, DATA_ROWS, cells, seed)
    queries, _ = in_cells(rows.filter("is_query"), QUERY_ROWS, cells, seed)
    tree = tree_balls(block_balls(data), depth)
    home = data.filter("is_query").select(
        F.concat("path", F.lit("#"), F.pmod(F.xxhash64("vec_id"), F.lit(-(-DATA_ROWS // QUERY_ROWS))).cast("string")).alias("q_block"),
        F.concat("path", F.lit("#0")).alias("d_block"), "vec_id", "v", F.lit(float("-inf")).alias("floor"))
    first = staged(_searched(home.select("q_block", "d_block").distinct(), home, data, k))
    kth = _best_of(first, k).select(
        F.col("query_id").alias("vec_id"),
        F.when(F.size("best") == k, F.bitwise_not(F.col("best")[k - 1]["less"]).cast("double")).otherwise(float("-inf")).alias("floor"))
    known = staged(queries.select(F.col("block").alias("q_block"), "path", "vec_id", "v").join(kth, "vec_id", "left").withColumn(
        "floor", F.coalesce("floor", F.lit(float("-inf")))))
    lowest = known.groupBy("q_block").agg(F.min("floor").alias("least"))
    balls = block_balls(queries).select(
        F.col("node").alias("q_block"), F.substring_index("parent", ".", 1).alias("root"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    rest = _searched(meetings_within(staged(balls.join(lowest, "q_block")), tree, depth), known, data, k)
    best = _best_of(first.union(rest), k)
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.bitwise_not("b.less").alias("score"))
