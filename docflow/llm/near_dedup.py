"""MinHash near-deduplication by an LSH forest.

Documents with the same set of shingles are one class. Every class has one signature
and stands in several trees, each of which orders the signatures by other components.
Classes with a common prefix of ``DEPTH`` components are a region of a tree. Candidates
are neighbours in these orders, which have the longest common prefix with each other
that the region offers: where many signatures agree it is a deep one. What the links
among them connect needs no further comparison; only members of one region that are
still apart are compared with each other, in blocks. Every link is confirmed on the full
sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import minhash, mix, shingle_sets, slices, staged
from docflow.llm.components import connected_components

TREES, DEPTH, TAIL = 24, 3, 4
#: Members of a region that meet in one block.
BLOCK = 256
#: Pairs below this estimate are no candidates: 4.5 standard deviations below 0.75.
LEAST_ESTIMATE = 0.52
_FACTOR = np.random.default_rng(13).integers(1, 1 << 63, DEPTH + 1, np.uint64) | np.uint64(1)


def _binary(array: np.ndarray, width: int) -> pa.Array:
    """Rows of a contiguous array as binary values of ``width`` bytes."""
    return pa.Array.from_buffers(pa.binary(width), len(array), [None, pa.py_buffer(np.ascontiguousarray(array))]).cast(pa.binary())


def _node(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that stand for each set."""
    out = np.zeros((len(sets), 2), np.uint64)
    for i, s in enumerate(sets):
        out[i, 0] = s.sum(dtype=np.uint64)
        out[i, 1] = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return out


def shingled(docs: DataFrame, count: int = TREES * DEPTH) -> DataFrame:
    """``doc_id, key, n_shingles, node, signature``; node and signature null for an empty set.

    A signature has ``count`` minima of 32 bits; ``key`` is a hash of the text.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                empty = pa.array([not len(s) for s in sets], pa.bool_())
                null = pa.scalar(None, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.compute.if_else(empty, null, _binary(_node(sets), 16)),
                        pa.compute.if_else(empty, null, _binary(minhash(sets, count), 4 * count)),
                    ],
                    ["doc_id", "key", "n_shingles", "node", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text").mapInArrow(
        sign, "doc_id long, key long, n_shingles long, node binary, signature binary"
    )


def full_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, node`` and the whole sorted ``shingles`` (64-bit, little-endian) per document."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _binary(_node(sets), 16), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc_id", "node", "shingles"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(collect, "doc_id long, node binary, shingles binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree: the region at ``DEPTH`` and the components that follow."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _signatures(batch.column("signature")).astype(np.uint64)
            for t in range(TREES):
                at = (t * DEPTH + np.arange(DEPTH + TAIL)) % sig.shape[1]
                region = np.full(len(sig), t, np.uint64) * _FACTOR[DEPTH]
                for j in range(DEPTH):
                    region += (sig[:, at[j]] + np.uint64(1)) * _FACTOR[j]
                tail = np.zeros(len(sig), np.uint64)
                for j in at[DEPTH:]:
                    tail = tail << np.uint64(16) | sig[:, j] & np.uint64(0xFFFF)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sig), t, np.int32)), pa.array(mix(region).view(np.int64)), pa.array(tail.view(np.int64)), batch.column("node")],
                    ["tree", "region", "tail", "node"],
                )

    return classes.select("node", "signature").mapInArrow(plant, "tree int, region long, tail long, node binary")


def _regions(forest: DataFrame) -> DataFrame:
    """The rows of the regions with more than two classes."""
    large = forest.groupBy("region").agg(F.count("*").alias("size")).where("size > 2")
    return forest.join(large.select("region"), "region")


_PAIR, _FIRST, _LAST = 0, 1, 2


def neighbours(forest: DataFrame) -> DataFrame:
    """Pairs (``a, b``) of classes that follow each other in a region's order of signatures.

    The orders of all trees are one table in ranges, so that a region of any size is dealt
    out over the tasks; what meets at the ends of two ranges is one row each.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, names = TaskContext.get().partitionId(), ["kind", "shard", "region", "a", "b"]
        first = last = None

        def rows(kind: int, region: np.ndarray, a: pa.Array, b: pa.Array) -> pa.RecordBatch:
            marks = [pa.array(np.full(len(region), m, np.int32)) for m in (kind, shard)]
            return pa.RecordBatch.from_arrays([*marks, pa.array(region), a, b], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            region, node = batch.column("region").to_numpy(), batch.column("node")
            if last is not None:
                region, node = np.concatenate([last[0], region]), pa.concat_arrays([last[1], node])
            else:
                first = region[:1], node.slice(0, 1)
            at = np.flatnonzero(region[1:] == region[:-1])
            yield rows(_PAIR, region[at], node.take(pa.array(at)), node.take(pa.array(at + 1)))
            last = region[-1:], node.slice(len(node) - 1)
        if first is not None:
            yield rows(_FIRST, *first, first[1])
            yield rows(_LAST, *last, last[1])

    order = ["region", "tail", "node"]
    ordered = forest.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    found = staged(ordered.mapInArrow(scan, "kind int, shard int, region long, a binary, b binary"), "neighbours")
    firsts = found.where(F.col("kind") == _FIRST).select("shard", "region", "b")
    # One row per range.
    following = firsts.select("shard", F.lead("shard").over(W.orderBy("shard")).alias("next"))
    lasts = found.where(F.col("kind") == _LAST).select("shard", "region", "a").join(following, "shard")
    meeting = lasts.join(firsts.withColumnRenamed("shard", "next"), ["next", "region"]).select("a", "b")
    return found.where(F.col("kind") == _PAIR).select("a", "b").unionByName(meeting)


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (``a, b``) with 100 * intersection >= ``similarity`` * union of full sets."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                least, most = sorted((len(x), len(y)))
                shared = len(np.intersect1d(x, y, assume_unique=True)) if 100 * least >= similarity * most else 0
                similar.append(shared > 0 and 100 * shared >= similarity * (least + most - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(compare, "a binary, b binary")


def links_apart(
    members: DataFrame, classes: DataFrame, sets: DataFrame, similarity: int, depth: int = DEPTH, least_estimate: float = LEAST_ESTIMATE
) -> DataFrame:
    """Confirmed links (``a, b``) that join what is apart within the regions of ``members``.

    ``members`` has ``tree, region, node, component``; a tree's regions are those of its
    ``depth`` components of the signature. A region's members are dealt into
    blocks, and every two blocks meet in one group of bounded size. There, pairs of
    different components are compared: first by signature, then on their full sets, each
    pair in the first tree that brings it together. Pairs that a link of the same group
    has already connected need no comparison, so a group of n members gives n - 1 links
    at most. With a ``least_estimate`` of 0 no pair is left out for its signature.
    """
    mixed = members.groupBy("region").agg(
        F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (
        members.join(mixed.select("region", blocks.alias("blocks")), "region")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(classes.select("node", "signature"), "node")
        .join(sets, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .select("tree", "region", "i", "j", "block", "node", "component", "signature", "shingles")
    )

    def links(run: pa.Table) -> list[tuple[int, int]]:
        sig = _signatures(run.column("signature").combine_chunks())
        by_tree = sig.reshape(len(sig), -1, depth)
        shingles = [np.frombuffer(s.as_buffer(), np.uint64) for s in run.column("shingles")]
        sizes = np.array([len(s) for s in shingles])
        _, component = np.unique(np.array(run.column("component").to_pylist(), object), return_inverse=True)
        block, tree = run.column("block").to_numpy(), run.column("tree")[0].as_py()
        i, j = run.column("i")[0].as_py(), run.column("j")[0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        for x in left.tolist():
            apart = right[(component[right] != component[x]) & ((i != j) | (right > x))]
            apart = apart[100 * np.minimum(sizes[apart], sizes[x]) >= similarity * np.maximum(sizes[apart], sizes[x])]
            apart = apart[(sig[apart] == sig[x]).mean(1) >= least_estimate * similarity / 75]
            apart = apart[~(by_tree[apart, :tree] == by_tree[x, :tree]).all(2).any(1)]
            if not len(apart):
                continue
            theirs = np.concatenate([shingles[y] for y in apart])
            at = np.minimum(np.searchsorted(shingles[x], theirs), sizes[x] - 1)
            bounds = np.concatenate([[0], np.cumsum(sizes[apart])[:-1]])
            shared = np.add.reduceat((shingles[x][at] == theirs).astype(np.int64), bounds)
            for y in apart[100 * shared >= similarity * (sizes[apart] + sizes[x] - shared)].tolist():
                if component[y] != component[x]:
                    component[component == component[y]] = component[x]
                    found.append((x, y))
        return found

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["region", "i", "j"]):
            if found := links(run):
                node = run.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(end)) for end in zip(*found, strict=True)], ["a", "b"])

    return dealt.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j").mapInArrow(scan, "a binary, b binary")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, each as one table."""
    held, key = [], None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.ones(batch.num_rows, bool)
        change[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        bounds = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            this = tuple(c[a] for c in columns)
            if held and this != key:
                yield pa.Table.from_batches(held)
                held = []
            key = this
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def near_groups(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """One row per document: ``doc_id, key, n_shingles, component_id, first_key``.

    ``key`` is a hash of the text: an id may have several texts. ``component_id`` and
    ``first_key`` are the id and key of the first document of the group, in this order.
    """
    rows = staged(shingled(docs), "shingled")
    usable = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    place = F.struct("doc_id", "key")
    classes = usable.groupBy("node").agg(F.min(place).alias("at"), F.min_by("signature", place).alias("signature"))
    classes = staged(classes.select("node", "at.doc_id", "at.key", "signature"), "classes")
    forest = _forest(classes)
    large = staged(_regions(forest), "regions")
    pairs = neighbours(forest).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = staged(pairs.where("a <> b").distinct(), "pairs")
    # Whoever is in a region with others may have to be compared on its full set.
    members = pairs.select("a").union(pairs.select("b")).union(large.select("node")).distinct().toDF("node")
    wanted = classes.join(members, "node", "left_semi").select("doc_id", "key").distinct()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).join(wanted, ["doc_id", "key"], "left_semi")
    # Rows that repeat a document have the same set.
    sets = staged(full_sets(keyed).drop("doc_id").dropDuplicates(["node"]), "sets")
    links = staged(confirmed(pairs, sets, similarity), "confirmed")
    found = connected_components(links)
    parts = large.select("tree", "region", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = links_apart(parts, classes, sets, similarity)
    found = connected_components(links.unionByName(more))
    labels = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = labels.groupBy("component").agg(F.min(place).alias("first"))
    by_node = labels.join(first, "component").select("node", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key"))
    linked = usable.select("doc_id", "key", "n_shingles", "node").join(by_node, "node").drop("node")
    alone = rows.where("node IS NULL OR doc_id IS NULL")
    alone = alone.select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.col("key").alias("first_key"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Reads ``doc_id`` and ``text``; other columns, whatever their names, don't matter.
    Shingles are five words (one of all words, if there are fewer). Null, empty and
    blank texts have no shingles and link with nothing. ``component_id`` is the smallest
    id among the documents reachable by links; ``kept`` marks it. Repeated rows get the
    same result each. A row without id links with nothing, has no ``component_id`` and
    is kept. An empty table gives no rows.
    """
    groups = near_groups(docs, similarity).select("doc_id", "n_shingles", "component_id")
    return groups.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """The rows of ``docs`` that are the first document of their group of near duplicates.

    Documents are told apart by id and text, so an id with several texts is several
    documents; of rows that repeat both, one stays. Rows without id and texts without words
    link with nothing, and all rows without id stay. An empty table gives no rows; all columns
    of ``docs`` stay as they are.
    """
    groups = near_groups(docs, similarity).where("doc_id IS NOT NULL").groupBy("doc_id", "key").agg(
        F.first((F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("first_key"))).alias("kept"), F.count("*").alias("rows")
    )
    marks = groups.where("NOT kept OR rows > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "kept")
    same = (docs["doc_id"].cast("long") == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key"))
    marked = docs.join(staged(marks, "document-marks"), same, "left").where("coalesce(kept, true)")
    once = marked.where("_id IS NULL")
    repeated = marked.where("_id IS NOT NULL").dropDuplicates(["_id", "_key"])
    return once.unionByName(repeated).select(docs.columns)
