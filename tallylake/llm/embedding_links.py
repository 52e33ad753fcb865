"""Links between embeddings by an epsilon grid order join.

Unit vectors are turned to their principal axes. The cells of a grid as wide as the greatest
distance of a link, on the leading axes, put them in one sequence, which is cut into blocks.
A block knows the box its vectors lie in, and boxes of whole runs of blocks come from theirs. From the
pair (whole sequence, whole sequence) on, pairs of intervals are opened level by level and those whose
boxes lie too far apart are left out, so only pairs of blocks that may hold a link meet. Inside a
pair of blocks the same recursion goes on down to tiles of vectors, and a bound on the cosine
from the leading axes picks the pairs whose cosine is then taken in double precision.

The bound never excludes a link: with x = p + r, p on the leading axes, x.y <= p.q + |r| |s|.
Equal vectors are one class throughout. A pair of blocks puts out one row per vector with links:
their number and one vector of its group there, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.components import components
from tallylake.llm.hot_keys import join_facts
from tallylake.llm.tables import Batches, map_batches, written

GRID_AXES = 8  # axes of the grid and of the boxes of blocks
BOUND_AXES = 24  # axes of the bound on the cosine
BLOCK_BYTES = 2 << 20  # vectors of a block
TILE = 512  # vectors of the smallest interval
FANOUT = 32  # intervals that one of the level above is made of
SLACK = 1e-4  # more than single precision can be off by
CLASS = ("key", "node", "members", "vector")


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def keyed(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, np.dtype]:
    """(vec_id, key, vector) and the vectors' number type; key and vector are NULL for those without links."""
    element = vectors.schema[embedding].dataType.elementType
    name, dtype = ("float", np.float32) if isinstance(element, T.FloatType) else ("double", np.float64)
    width = np.dtype(dtype).itemsize

    def key(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy() * width
            numbers = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype).tobytes()
            raw = [
                numbers[low:high] if known else None
                for low, high, known in zip(offsets, offsets[1:], lists.is_valid().to_pylist())
            ]
            keys = [None if v is None else xxhash.xxh3_128_digest(v) for v in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())],
                names=["vec_id", "key", "vector"],
            )

    vector = F.col(embedding).cast(f"array<{name}>")
    chosen = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.when(_usable(vector), vector).alias("vector")
    )
    return map_batches(chosen, key, "vec_id long, key binary, vector binary"), np.dtype(dtype)


@dataclass(frozen=True)
class Grid:
    """All that places a vector: the principal axes (as columns) and the width of a cell."""

    axes: np.ndarray
    width: float
    dtype: np.dtype

    @property
    def dims(self) -> int:
        return len(self.axes)

    def matrix(self, vectors: list[bytes]) -> np.ndarray:
        """The vectors as rows; shorter ones are filled up with zeros."""
        full = self.dims * self.dtype.itemsize
        joined = b"".join(v if len(v) == full else v.ljust(full, b"\0") for v in vectors)
        return np.frombuffer(joined, self.dtype).reshape(len(vectors), self.dims)

    def units(self, matrix: np.ndarray) -> np.ndarray:
        wide = matrix.astype(np.float64)
        wide /= np.abs(wide).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
        return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]

    def leading(self, units: np.ndarray) -> np.ndarray:
        """Coordinates on the leading axes and the length of the rest."""
        on_axes = units @ self.axes[:, :BOUND_AXES]
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", on_axes, on_axes)))
        return np.column_stack([on_axes, rest])


def fitted(classes: DataFrame, dtype: np.dtype, threshold: float) -> Grid | None:
    """The grid of all classes; None without any. The driver gets one number per pair of dimensions."""
    longest = classes.agg(F.max(F.length("vector"))).first()[0]
    if longest is None:
        return None
    dims = longest // dtype.itemsize
    plain = Grid(np.eye(dims), math.sqrt(2 - 2 * threshold), dtype)
    upper = np.triu_indices(dims + 1)

    def moments(batches: Batches) -> Batches:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            if batch.num_rows:
                units = plain.units(plain.matrix(batch.column(0).to_pylist()))
                units = np.column_stack([np.ones(len(units)), units])
                total += units.T @ units
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])],
            names=["row", "column", "value"],
        )

    parts = map_batches(classes.select("vector"), moments, "row long, column long, value double")
    sums = np.zeros((dims + 1, dims + 1))
    for r in parts.groupBy("row", "column").agg(F.sum("value").alias("value")).collect():
        sums[r.row, r.column] = sums[r.column, r.row] = r.value
    mean = sums[0, 1:] / sums[0, 0]
    _, axes = np.linalg.eigh(sums[1:, 1:] / sums[0, 0] - np.outer(mean, mean))
    return Grid(axes[:, ::-1].copy(), plain.width, dtype)


def sequence(classes: DataFrame, grid: Grid) -> DataFrame:
    """(rank, key, node, members, vector): the classes in grid order, numbered from 0."""
    depth = min(GRID_AXES, grid.dims)
    cells = [f"c{k}" for k in range(depth)]

    def place(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = grid.units(grid.matrix(batch.column("vector").to_pylist()))
            cell = np.floor(units @ grid.axes[:, :depth] / grid.width).astype(np.int32)
            columns = [batch.column(name) for name in CLASS]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(cell[:, k]) for k in range(depth)]],
                names=[*CLASS, *cells],
            )

    def number(batches: Batches) -> Batches:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, part, np.int32)),
                    pa.array(np.arange(at, at + size)),
                    *[batch.column(name) for name in CLASS],
                ],
                names=["part", "at", *CLASS],
            )
            at += size

    columns = "key binary, node long, members long, vector binary"
    schema = columns + "".join(f", {c} int" for c in cells)
    placed = map_batches(classes.select(*CLASS), place, schema)
    ordered = placed.orderBy(*cells, "node", "key")
    numbered = written(map_batches(ordered, number, f"part int, at long, {columns}"), "ego-sequence")
    # one row per partition, so the window holds no more rows than the session has partitions
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = (F.col("first") + F.col("at")).alias("rank")
    return numbered.join(first, "part").select(rank, *CLASS)


BLOCK_SCHEMA = "block long, keys binary, nodes binary, members binary, lengths binary, vectors binary, low array<double>, high array<double>"


def blocks(ordered: DataFrame, grid: Grid, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of the sequence: its vectors packed, and their box on the grid's axes and the rest."""
    size = max(TILE, block_bytes // (grid.dims * grid.dtype.itemsize))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        vectors = table["vector"].to_pylist()
        lengths = np.array([len(v) for v in vectors], np.int32)
        matrix = grid.matrix(vectors)
        leading = grid.leading(grid.units(matrix))
        box = np.column_stack([leading[:, : min(GRID_AXES, grid.dims)], leading[:, -1]])
        row = {
            "block": table["block"][0].as_py(),
            "keys": b"".join(table["key"].to_pylist()),
            "nodes": table["node"].to_numpy().astype(np.int64).tobytes(),
            "members": table["members"].to_numpy().astype(np.int64).tobytes(),
            "lengths": lengths.tobytes(),
            "vectors": matrix.tobytes(),
            "low": box.min(axis=0).tolist(),
            "high": box.max(axis=0).tolist(),
        }
        return pa.Table.from_pylist([row], _BLOCK)

    numbered = ordered.withColumn("block", F.floor(F.col("rank") / F.lit(size)).cast("long"))
    return numbered.groupBy("block").applyInArrow(pack, BLOCK_SCHEMA)


_BLOCK = pa.schema(
    [("block", pa.int64())]
    + [(name, pa.binary()) for name in ("keys", "nodes", "members", "lengths", "vectors")]
    + [(name, pa.list_(pa.float64())) for name in ("low", "high")]
)


def block_pairs(packed: DataFrame, grid: Grid, fanout: int = FANOUT) -> DataFrame:
    """(i, j), i <= j: the pairs of blocks whose boxes are near enough for a link.

    Intervals of ``fanout`` blocks, of as many of those, and so on up to the whole sequence have the
    boxes of their parts; pairs are opened from the top, and a pair too far apart never is.
    """
    corners = min(GRID_AXES, grid.dims) + 1
    sides = [f"{side}{k}" for side in ("low", "high") for k in range(corners)]
    boxes = packed.select(
        F.col("block").alias("no"),
        *[F.col(side)[k].alias(f"{side}{k}") for side in ("low", "high") for k in range(corners)],
    )
    levels = [written(boxes, "ego-boxes")]
    top = levels[0].agg(F.max("no")).first()[0]
    while top:
        top //= fanout
        own = F.floor(F.col("no") / F.lit(fanout)).cast("long").alias("no")
        extent = [(F.min if s.startswith("low") else F.max)(s).alias(s) for s in sides]
        levels.append(levels[-1].groupBy(own).agg(*extent))
    pairs = levels[-1].select(F.col("no").alias("i"), F.col("no").alias("j"))
    for level in reversed(levels[:-1]):
        parent = F.floor(F.col("no") / F.lit(fanout)).cast("long")
        a = level.select(parent.alias("i"), *[F.col(c).alias(f"a_{c}") for c in level.columns])
        b = level.select(parent.alias("j"), *[F.col(c).alias(f"b_{c}") for c in level.columns])
        apart = F.lit(0.0)
        for k in range(corners):
            gap = F.greatest(
                F.lit(0.0),
                F.col(f"a_low{k}") - F.col(f"b_high{k}"),
                F.col(f"b_low{k}") - F.col(f"a_high{k}"),
            )
            apart = apart + gap * gap
        near = (F.col("a_no") <= F.col("b_no")) & (apart <= grid.width**2 + SLACK)
        opened = pairs.join(a, "i").join(b, "j").filter(near)
        pairs = written(
            opened.select(F.col("a_no").alias("i"), F.col("b_no").alias("j")), "ego-pairs"
        )
    return pairs


class _Block:
    """A packed block opened for comparing."""

    def __init__(self, row: dict, grid: Grid):
        self.keys = np.frombuffer(row["keys"], "V16")
        self.nodes = np.frombuffer(row["nodes"], np.int64)
        self.members = np.frombuffer(row["members"], np.int64).astype(np.float64)
        self.lengths = np.frombuffer(row["lengths"], np.int32)
        self.units = grid.units(np.frombuffer(row["vectors"], grid.dtype).reshape(-1, grid.dims))
        leading = grid.leading(self.units)
        self.starts = np.arange(0, len(leading), TILE)
        self.low = np.minimum.reduceat(leading, self.starts)
        self.high = np.maximum.reduceat(leading, self.starts)
        self.leading = leading.astype(np.float32)

    def tile(self, k: int) -> slice:
        return slice(k * TILE, (k + 1) * TILE)


def _near_tiles(a: _Block, b: _Block, width: float) -> Iterator[tuple[int, int]]:
    """Pairs of tiles that may hold a link; for one block with itself each pair once."""
    todo = [(0, len(a.starts), 0, len(b.starts))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a is b and b1 <= a0:
            continue
        gap = np.maximum(
            a.low[a0:a1].min(axis=0) - b.high[b0:b1].max(axis=0),
            b.low[b0:b1].min(axis=0) - a.high[a0:a1].max(axis=0),
        )
        gap = np.maximum(gap, 0)
        if gap @ gap > width**2 + SLACK:
            continue
        if a1 - a0 == 1 and b1 - b0 == 1:
            yield a0, b0
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            todo += [(a0, middle, b0, b1), (middle, a1, b0, b1)]
        else:
            middle = (b0 + b1) // 2
            todo += [(a0, a1, b0, middle), (a0, a1, middle, b1)]


def _merge(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``group`` (each position's smallest known companion) after joining x with y pairwise."""
    while True:
        gx, gy = group[x], group[y]
        apart = gx != gy
        if not apart.any():
            return group
        x, y, gx, gy = x[apart], y[apart], gx[apart], gy[apart]
        np.minimum.at(group, np.maximum(gx, gy), np.minimum(gx, gy))
        while not np.array_equal(group, further := group[group]):
            group = further


def linked(a: _Block, b: _Block, grid: Grid, threshold: float) -> tuple[np.ndarray, ...]:
    """(keys, nodes, links, roots) of the vectors of two blocks (or of one, a is b) that have links there."""
    offset = 0 if a is b else len(a.nodes)
    counts = np.zeros(offset + len(b.nodes))
    group = np.arange(len(counts))
    for i, j in _near_tiles(a, b, grid.width):
        rows, columns = a.tile(i), b.tile(j)
        close = a.leading[rows] @ b.leading[columns].T >= threshold - SLACK
        if a is b and i == j:
            close = np.triu(close, 1)
        x, y = np.nonzero(close)
        if not len(x):
            continue
        if len(x) > TILE:
            cosine = (a.units[rows] @ b.units[columns].T)[x, y]
        else:
            cosine = np.einsum("ij,ij->i", a.units[rows][x], b.units[columns][y])
        x, y = x + rows.start, y + columns.start
        keep = (cosine >= threshold) & (a.lengths[x] == b.lengths[y])
        x, y = x[keep], y[keep]
        np.add.at(counts, x, b.members[y])
        np.add.at(counts, y + offset, a.members[x])
        group = _merge(group, x, y + offset)
    keys, nodes = a.keys, a.nodes
    if a is not b:
        keys, nodes = np.concatenate([keys, b.keys]), np.concatenate([nodes, b.nodes])
    found = np.flatnonzero(counts)
    return keys[found], nodes[found], counts[found].astype(np.int64), nodes[group[found]]


LINKS = "key binary, node long, links long, root long"


def links(packed: DataFrame, pairs: DataFrame, grid: Grid, threshold: float) -> DataFrame:
    """(key, node, links, root) per pair of blocks and class: its links there and one class of its group."""

    def compare(table: pa.Table) -> pa.Table:
        opened = [_Block(row, grid) for row in table.to_pylist()]
        keys, nodes, counts, roots = linked(opened[0], opened[-1], grid, threshold)
        names = pa.array([k.tobytes() for k in keys], pa.binary())
        return pa.table({"key": names, "node": nodes, "links": counts, "root": roots})

    one = pairs.select(F.col("i").alias("block"), "i", "j")
    other = pairs.filter("i < j").select(F.col("j").alias("block"), "i", "j")
    units = packed.drop("low", "high").join(one.union(other), "block")
    return units.groupBy("i", "j").applyInArrow(compare, LINKS)


def grouped(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.95,
    block_bytes: int = BLOCK_BYTES,
    fanout: int = FANOUT,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors of the same length are linked if their cosine, in double precision, is ``threshold`` or
    more. ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id
    reachable by links. Vectors that are NULL, empty, zero or hold a NULL or a number that is not
    finite link with nothing. Repeated rows are one vector and come out once each; rows that share an
    id but not the vector have links of their own and one component. Rows without an id link
    with nothing and are kept, with a NULL component. Other columns are ignored.
    """
    rows, dtype = keyed(vectors, vec_id, embedding)
    rows = written(rows, "ego-vectors")
    named = rows.filter(F.col("vec_id").isNotNull() & F.col("key").isNotNull())
    classes = written(
        named.groupBy("key").agg(
            F.min("vec_id").alias("node"),
            F.count_distinct("vec_id").alias("members"),
            F.first("vector").alias("vector"),
        ),
        "ego-classes",
    )
    grid = fitted(classes, dtype, threshold)
    if grid is None:
        found = rows.sparkSession.createDataFrame([], LINKS)
    else:
        packed = written(blocks(sequence(classes, grid), grid, block_bytes), "ego-blocks")
        pairs = block_pairs(packed, grid, fanout)
        found = written(links(packed, pairs, grid, threshold), "ego-links")
    # an id with several vectors joins their classes
    several = named.groupBy("vec_id").agg(F.count_distinct("key").alias("n")).filter("n > 1")
    same = named.join(several, "vec_id").join(classes.select("key", "node"), "key")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    edges = edges.union(same.select(F.col("vec_id").alias("a"), F.col("node").alias("b")))
    groups = components(edges)
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    facts = classes.select("key", "node", "members").join(counts, "key", "left")
    facts = facts.join(groups, "node", "left")

    out = join_facts(rows.drop("vector"), facts, "key", F.col("vec_id"))
    known = F.col("vec_id").isNotNull()
    n_links = F.col("members") - 1 + F.coalesce("links", F.lit(0))
    component = F.when(known, F.coalesce("component", "node", "vec_id"))
    return out.select(
        "vec_id",
        F.when(known, F.coalesce(n_links, F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def without_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """One vector of each group, all columns unchanged; repeated rows of it stay."""
    drop = grouped(vectors, vec_id, embedding, threshold).filter(~F.col("kept"))
    drop = drop.select(F.col("vec_id").alias("dropped_id")).distinct()
    return vectors.join(drop, vectors[vec_id].cast("long") == drop["dropped_id"], "left_anti")


# DuckDB SQL for the rows of grouped(), from all pairs: for small tables.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
     AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS reached FROM embeddings
      UNION SELECT r.id, p.b FROM r JOIN p ON r.reached = p.a),
c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = c.id LEFT JOIN n ON vec_id = n.a
"""
