"""MinHash near-duplicates by a multi-index Hamming join.

Texts become shingle sets, equal sets become one class, and each class has a b-bit
MinHash signature. Signatures are cut into chunks; every chunk is indexed with each
one of its symbols left out, so by pigeonhole all pairs within the signature
distance meet in a bucket. Buckets give clusters of signatures within that
distance, and inside the clusters links are confirmed on the full sets.

Neither step lists the pairs of a group. A group larger than a block is cut into blocks of bounded
size, each with the group's first member. Members that turn out connected are contracted to one, and the
rest goes through the same step while that halves it. Only groups that are still in several parts
are settled by pairs of blocks, and no pair lies inside the largest part. So a group of copies costs as
much as its members, and only members far from one another cost pairs. Each unit of work puts out a
spanning forest: at most one edge per member, whatever the number of links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm import sketches
from tallylake.llm.components import components
from tallylake.llm.tables import Batches, dropped, map_batches, written

BUCKET_BLOCK = 2_048  # signatures in a block
SET_BLOCK = 1 << 20  # shingles in a block


def sketched(docs: DataFrame, doc_id: str, text: str, shingle_words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature); set_key and signature are NULL for empty sets."""

    def sketch(batches: Batches) -> Batches:
        sketcher = sketches.Sketcher(shingle_words)
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for value in batch.column(1):
                values = sketcher.shingle_set(value.as_py())
                sizes.append(len(values))
                keys.append(sketches.set_key(values) if len(values) else None)
                signatures.append(sketches.signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary"))
    schema = "doc_id long, n_shingles long, set_key binary, signature binary"
    return map_batches(chosen, sketch, schema)


def bucket_keys(classes: DataFrame) -> DataFrame:
    """(key, node): every class under each of its chunk keys."""

    def keys(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = b"".join(batch.column(1).to_pylist())
            matrix = np.frombuffer(joined, np.uint16).reshape(batch.num_rows, sketches.SYMBOLS)
            nodes = np.repeat(batch.column(0).to_numpy(), sketches.SYMBOLS)
            found = sketches.chunk_keys(matrix).ravel().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(nodes)], names=["key", "node"]
            )

    return map_batches(classes.select("node", "signature"), keys, "key long, node long")


def in_blocks(members: DataFrame, block: int) -> DataFrame:
    """``members`` (grp, node, weight) with the number of blocks their group takes."""
    sizes = members.groupBy("grp").agg(F.sum("weight").alias("total"))
    return members.join(sizes.select("grp", _blocks(F.col("total"), block)), "grp")


def _blocks(total: Column, block: int) -> Column:
    return F.ceil(total / block).cast("long").alias("blocks")


def blocks_alone(members: DataFrame) -> DataFrame:
    """Units (grp, i, j) of one block each, with the lightest member of the group in all of them."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    first = members.filter("blocks > 1").groupBy("grp").agg(
        F.min(F.struct("weight", "node"))["node"].alias("node"), F.max("blocks").alias("blocks")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    first = first.withColumn("i", every).filter(F.col("i") != own)
    units = members.withColumn("i", own).select("grp", "i", "node").union(first.select("grp", "i", "node"))
    return units.withColumn("j", F.col("i"))


def blocks_across(members: DataFrame) -> DataFrame:
    """Units (grp, i, j) in which every two members with different labels meet.

    ``members`` has label and, of its group, the heaviest label (main) and the blocks that its members and
    all others take. Two blocks of the heaviest label never meet.
    """
    inside, main, rest = F.col("label") == F.col("main"), F.col("main_blocks"), F.col("rest_blocks")
    place = F.xxhash64("node")
    own = F.when(inside, F.pmod(place, main)).otherwise(main + F.pmod(place, rest))
    low = F.when(inside, main).otherwise(F.lit(0).cast("long"))
    units = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(low, main + rest - 1)))
    return units.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")


def forests(
    members: DataFrame, spread: Callable[[list[bytes]], Iterator[tuple[int, int]]]
) -> DataFrame:
    """Edges (a, b) that ``spread`` finds in each (grp, i, j) of ``members``, which have a payload.

    ``spread`` gets the payloads of one pair of blocks and yields pairs of positions. The rows
    of a pair of blocks come one after the other, so a task holds one such pair at a time.
    """

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        group: tuple | None = None

        def close() -> pa.RecordBatch | None:
            if not held or sum(b.num_rows for b in held) < 2:
                return None
            nodes = np.concatenate([b.column(3).to_numpy() for b in held])
            payloads = [p for b in held for p in b.column(4).to_pylist()]
            pairs = list(spread(payloads))
            if not pairs:
                return None
            ends = nodes[np.array(pairs)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(3)]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *changes.tolist(), batch.num_rows]
            for low, high in zip(bounds, bounds[1:]):
                this = tuple(int(c[low]) for c in columns)
                if this != group:
                    found = close()
                    if found is not None:
                        yield found
                    held, group = [], this
                held.append(batch.slice(low, high - low))
        found = close()
        if found is not None:
            yield found

    rows = members.select("grp", "i", "j", "node", "payload")
    rows = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "node")
    return map_batches(rows, run, "a long, b long")


def connecting(
    members: DataFrame,
    sizes: DataFrame,
    payloads: DataFrame,
    block: int,
    spread: Callable[[list[bytes]], Iterator[tuple[int, int]]],
) -> DataFrame:
    """Edges (a, b) with the same components as all links that ``spread`` would find inside each group.

    ``members``: (grp, node, weight, blocks, payload), ``sizes``: (grp, blocks), ``payloads``:
    (node, payload) of the members of groups with several blocks, at least.
    """
    some = F.lit(0).cast("long")
    small = members.filter("blocks = 1").withColumn("i", some).withColumn("j", some)
    found = [written(forests(small, spread).distinct(), "nd-edges")]
    if sizes.filter("blocks > 1").isEmpty():
        return found[0]
    large = written(members.filter("blocks > 1").select("grp", "node", "weight"), "nd-large")
    step, left = in_blocks(large, block), large.count()
    near: list[DataFrame] = []
    while True:
        units = blocks_alone(step).join(payloads, "node")
        near.append(written(forests(units, spread).distinct(), "nd-edges"))
        labels = components(reduce(DataFrame.union, near)).withColumnRenamed("component", "label")
        named = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        parts = named.groupBy("grp", "label").agg(
            F.sum("weight").alias("weight"), F.min(F.struct("weight", "node")).alias("first")
        )
        parts = written(parts, "nd-parts")
        open_ = parts.groupBy("grp").agg(
            F.sum("weight").alias("total"),
            F.max(F.struct("weight", "label")).alias("top"),
            F.count("*").alias("parts"),
        )
        open_ = written(open_.filter("parts > 1").drop("parts"), "nd-open")
        parts = parts.join(open_.select("grp"), "grp", "left_semi")
        before, left = left, parts.count()
        if not left:
            return reduce(DataFrame.union, found + near)
        if 2 * left > before:
            break
        step = in_blocks(parts.select("grp", "first.node", "first.weight"), block)
    of = open_.select(
        "grp",
        F.col("top.label").alias("main"),
        _blocks(F.col("top.weight"), block).alias("main_blocks"),
        _blocks(F.col("total") - F.col("top.weight"), block).alias("rest_blocks"),
    )
    units = blocks_across(named.join(of, "grp")).join(payloads, "node")
    last = written(forests(units, spread).distinct(), "nd-edges")
    return reduce(DataFrame.union, [*found, *near, last])


def _walk(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Spanning forest of ``n`` members; ``linked(x, others)`` picks those of ``others`` next to x."""
    open_ = np.arange(n)
    while len(open_) > 1:
        root, open_ = int(open_[0]), open_[1:]
        queue = [root]
        while queue and len(open_):
            near = linked(queue.pop(), open_)
            yield from ((root, int(y)) for y in open_[near])
            queue += open_[near].tolist()
            open_ = open_[~near]


def signature_forest(payloads: list[bytes]) -> Iterator[tuple[int, int]]:
    """Forest of the members that are within the signature distance of one another."""
    matrix = np.frombuffer(b"".join(payloads), np.uint16).reshape(len(payloads), -1)

    def linked(x: int, others: np.ndarray) -> np.ndarray:
        return (matrix[others] != matrix[x]).sum(axis=1) <= sketches.MAX_DISTANCE

    return _walk(len(payloads), linked)


def set_forest(percent: int) -> Callable[[list[bytes]], Iterator[tuple[int, int]]]:
    """Forest of the members whose sets overlap by ``percent`` of their union, exactly."""

    def forest(payloads: list[bytes]) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(p, np.uint64) for p in payloads]
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(ids.max() + 1, bool)

        def linked(x: int, others: np.ndarray) -> np.ndarray:
            small = np.minimum(sizes[others], sizes[x])
            fits = 100 * small >= percent * np.maximum(sizes[others], sizes[x])
            at = np.flatnonzero(fits)
            if not len(at):
                return fits
            own = ids[starts[x] : starts[x + 1]]
            marked[own] = True
            common = np.array([marked[ids[starts[y] : starts[y + 1]]].sum() for y in others[at]])
            marked[own] = False
            union = sizes[others[at]] + sizes[x] - common
            fits[at] = 100 * common >= percent * union
            return fits

        return _walk(len(payloads), linked)

    return forest


def full_sets(
    docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, shingle_words: int
) -> DataFrame:
    """(node, set_key, shingles) of the documents that stand for the wanted (node) classes."""

    def build(batches: Batches) -> Batches:
        sketcher = sketches.Sketcher(shingle_words)
        for batch in batches:
            sets = [sketcher.shingle_set(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([sketches.set_key(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["node", "set_key", "shingles"],
            )

    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).cast("binary"))
    texts = texts.join(wanted, "node", "left_semi")
    return map_batches(texts, build, "node long, set_key binary, shingles binary")


def grouped(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    percent: int = 85,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked if their shingle sets overlap by ``percent`` of their union or more. A group of
    linked documents is named by its smallest doc_id, which is the one kept. Texts without a
    word have an empty set and link with nothing. Rows that share a doc_id are one document: they are
    in one group, and repeated rows come out once each. Rows without a doc_id are linked with
    nothing and kept, with a NULL component. Other columns are ignored.
    """
    sketch = written(sketched(docs, doc_id, text, shingle_words), "nd-sketches")
    named = sketch.filter(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = written(
        named.groupBy("set_key").agg(
            F.min("doc_id").alias("node"),
            F.first("signature").alias("signature"),  # equal sets have equal signatures
            F.first("n_shingles").alias("n_shingles"),
        ),
        "nd-classes",
    )
    # buckets with several classes; the counts are pre-aggregated, the join splits hot keys
    keys = bucket_keys(classes)
    shared = keys.groupBy(F.col("key").alias("grp")).agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(shared.select("grp", _blocks(F.col("n"), BUCKET_BLOCK)), "nd-buckets")
    signatures = classes.select("node", F.col("signature").alias("payload"))
    buckets = keys.select(F.col("key").alias("grp"), "node", F.lit(1).cast("long").alias("weight"))
    buckets = buckets.join(shared, "grp").join(signatures, "node")
    clusters = components(connecting(buckets, shared, signatures, BUCKET_BLOCK, signature_forest))

    members = clusters.join(classes.select("node", F.col("n_shingles").alias("weight")), "node")
    members = members.withColumnRenamed("component", "grp")
    sizes = members.groupBy("grp").agg(F.sum("weight").alias("total"))
    sizes = written(sizes.select("grp", _blocks(F.col("total"), SET_BLOCK)), "nd-clusters")
    sets = full_sets(docs, clusters.select("node"), doc_id, text, shingle_words)
    sets = sets.join(classes.select("set_key"), "set_key", "left_semi")
    sets = members.join(sizes, "grp").join(sets.select("node", F.col("shingles").alias("payload")), "node")
    sets = written(sets, "nd-sets")
    links = connecting(sets, sizes, sets.select("node", "payload"), SET_BLOCK, set_forest(percent))
    # a document with several texts joins their classes
    same = named.select("doc_id", "set_key").distinct().join(classes, "set_key")
    same = same.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    repeated = named.groupBy("doc_id").agg(F.count_distinct("set_key").alias("n")).filter("n > 1")
    links = links.union(same.join(repeated, F.col("a") == F.col("doc_id")).select("a", "b"))
    groups = components(links)
    dropped(sets, sizes, shared)

    rows = sketch.join(classes.select("set_key", "node"), "set_key", "left").join(
        groups, "node", "left"
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")
    )
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each group, all columns unchanged; repeated rows of it stay."""
    drop = grouped(docs, doc_id, text, shingle_words, percent).filter(~F.col("kept"))
    drop = drop.select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(drop, docs[doc_id].cast("long") == drop["dropped_id"], "left_anti")
