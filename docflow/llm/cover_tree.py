"""Exact links between embeddings by dual traversal of cover trees.

Equal vectors are one class. The classes are dealt into cells around sampled centers,
and cells into blocks of bounded size. Each block is a cover tree: nets whose radii
halve from level to level, every center of a level also one of the next. Two trees
are traversed together: a pair of nodes is dropped if the distance of their centers
exceeds the sum of their covering radii and the distance at the threshold, it is linked
as a whole if even its farthest points are near, and is taken apart otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged
from docflow.llm.components import connected_components
from docflow.llm.near_dedup import _runs as runs

#: Radii of the levels within a block. The first one is well below the distance of
#: unrelated vectors, about 1.4, less that at the threshold: larger nodes prune nothing.
RADII = (0.5, 0.25, 0.125)
#: Classes of a block, and the most cells (their centers are what the driver holds).
BLOCK, CELLS = 8192, 256
#: Pairs of points compared at once.
DENSE = 1 << 16
SLACK = 1e-5
#: What single precision may be off by in a cosine of unit vectors of up to 4,096 dimensions.
ROUNDING = 1e-4


def usable_vectors(column: pa.Array) -> tuple[list[int], list[bytes]]:
    """Rows of usable vectors, and for each its bytes as the data have it (double)."""
    rows, raw = [], []
    for i, value in enumerate(column):
        if value.is_valid:
            v = np.asarray(value.values.to_numpy(zero_copy_only=False), np.float64)
            if len(v) and np.isfinite(v).all() and v.any():
                rows.append(i)
                raw.append(v.tobytes())
    return rows, raw


def normalised(raw: list[bytes]) -> np.ndarray:
    """Vectors at unit length, in double precision; scaled first, so that no square overflows."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


def _net(x: np.ndarray, members: np.ndarray, radius: float) -> np.ndarray:
    """For each member its center: a greedy net of ``radius`` that starts at the first one."""
    near, center, left = 1 - radius * radius / 2, np.empty(len(members), np.int64), np.arange(len(members))
    while len(left):
        some = left[:64]
        cosine = x[members[some]] @ x[members[some]].T
        chosen: list[int] = []
        for i in range(len(some)):
            if not chosen or cosine[i, chosen].max() < near:
                chosen.append(i)
        best = x[members[left]] @ x[members[some[chosen]]].T
        at = best.argmax(1)
        covered = best[np.arange(len(left)), at] >= near
        covered[np.searchsorted(left, some[chosen])] = True
        at[np.searchsorted(left, some[chosen])] = np.arange(len(chosen))
        center[left[covered]] = members[some[chosen]][at[covered]]
        left = left[~covered]
    return center


def build(x: np.ndarray) -> np.ndarray:
    """The center of each point at each level (levels x points), nested."""
    levels = [_net(x, np.arange(len(x)), RADII[0])]
    for radius in RADII[1:]:
        above, level = levels[-1], np.arange(len(x))
        order = np.argsort(above, kind="stable")
        bounds = np.flatnonzero(np.diff(above[order], prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                head = above[order[a]]
                members = np.concatenate([[head], order[a:b][order[a:b] != head]])
                level[members] = _net(x, members, radius)
        levels.append(level)
    return np.array(levels)


class _Pairs:
    """Dual traversal over one or two blocks: link counts per point, and links that connect."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, parents: np.ndarray, threshold: float):
        self.x, self.weight, self.parents, self.threshold = x, weight, parents, threshold
        self.reach = _distance(np.float64(threshold))
        self.counts = np.zeros(len(x), np.int64)
        self.single = x.astype(np.float32)
        self.label = np.arange(len(x))
        self.links: list[tuple[int, int]] = []

    def _connect(self, a: int, others: np.ndarray) -> None:
        """Links ``a`` with one of ``others`` for each group of them that is still apart from it."""
        own, labels = self.label[a], self.label[others]
        apart = labels != own
        if apart.any():
            groups, first = np.unique(labels[apart], return_index=True)
            self.links += [(a, y) for y in others[apart][first].tolist()]
            renamed = np.arange(len(self.label))
            renamed[groups] = own
            self.label = renamed[self.label]

    def _linked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``a`` and ``b`` of points that link: in double precision where single can't tell."""
        exact = self.x.shape[1] > 4096
        points, room = (self.x, 0.0) if exact else (self.single, ROUNDING)
        cosine = points[a] @ points[b].T
        i, j = np.divmod(np.flatnonzero(cosine >= points.dtype.type(self.threshold - room)), len(b))
        if exact:
            return i, j
        linked = cosine[i, j] >= np.float32(self.threshold + room)
        unsure = np.flatnonzero(~linked)
        for at in range(0, len(unsure), DENSE):
            some = unsure[at : at + DENSE]
            linked[some] = np.einsum("ij,ij->i", self.x[a[i[some]]], self.x[b[j[some]]]) >= self.threshold
        return i[linked], j[linked]

    def _nodes(self, members: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Centers, covering radii and members of the nodes that hold ``members``."""
        center, which = np.unique(self.parents[level, members], return_inverse=True)
        away = _distance(np.einsum("ij,ij->i", self.x[members], self.x[center[which]]))
        radius = np.zeros(len(center))
        np.maximum.at(radius, which, away)
        order = np.argsort(which, kind="stable")
        return center, radius + 1e-7, np.split(members[order], np.cumsum(np.bincount(which))[:-1])

    def _all_linked(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        self.counts[a] += self.weight[b].sum() - (self.weight[a] if same else 0)
        if not same:
            self.counts[b] += self.weight[a].sum()
        self._connect(int(a[0]), np.concatenate([a, b]))

    def _compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        step = max(1, DENSE * 16 // len(b))
        for at in range(0, len(a), step):
            part = a[at : at + step]
            i, j = self._linked(part, b)
            if same:
                other = i + at != j
                i, j = i[other], j[other]
            np.add.at(self.counts, part[i], self.weight[b[j]])
            if not same:
                np.add.at(self.counts, b[j], self.weight[part[i]])
            apart = self.label[part[i]] != self.label[b[j]]
            i, j = i[apart], j[apart]
            for row, theirs in zip(i[np.flatnonzero(np.diff(i, prepend=-1))].tolist(), np.split(j, np.flatnonzero(np.diff(i)) + 1), strict=False):
                self._connect(int(part[row]), b[theirs])

    def visit(self, a: np.ndarray, b: np.ndarray, level: int, same: bool) -> None:
        """Compares the points ``a`` with ``b``, nodes of ``level`` first."""
        if level == len(RADII) or (level and len(a) * len(b) <= DENSE):
            self._compare(a, b, same)
            return
        ca, ra, in_a = self._nodes(a, level)
        cb, rb, in_b = (ca, ra, in_a) if same else self._nodes(b, level)
        xa, xb = self.x[ca].astype(np.float32), self.x[cb].astype(np.float32)
        for at in range(0, len(ca), 512):
            # Squares of distances: rounding matters less there.
            square = 2 - 2 * (xa[at : at + 512] @ xb.T)
            bound = ra[at : at + 512, None] + rb[None] + (self.reach + SLACK)
            for i, j in zip(*np.nonzero(square <= (bound * bound + SLACK).astype(np.float32)), strict=True):
                i += at
                if same and (j < i or (i == j and len(in_a[i]) == 1)):
                    continue
                farthest = _distance(self.x[ca[i]] @ self.x[cb[j]]) + ra[i] + rb[j]
                if farthest <= self.reach - SLACK:
                    self._all_linked(in_a[i], in_b[j], same and i == j)
                else:
                    self.visit(in_a[i], in_b[j], level + 1, same and i == j)


def _classes(vectors: DataFrame) -> DataFrame:
    """``vec_id, node, raw, dims`` of each row; node null if the vector links with nothing."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, raw = usable_vectors(batch.column("embedding"))
            node, values, dims = ([None] * batch.num_rows for _ in range(3))
            for i, v in zip(rows, raw, strict=True):
                node[i], values[i], dims[i] = hashlib.md5(v, usedforsecurity=False).digest(), v, len(v) // 8
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(node, pa.binary()), pa.array(values, pa.binary()), pa.array(dims, pa.int32())],
                ["vec_id", "node", "raw", "dims"],
            )

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(read, "vec_id long, node binary, raw binary, dims int")


def _pairs_of(classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, n`` for classes of one dimension: ``n`` links of ``a`` (b null), or a link."""
    reach = float(_distance(np.float64(threshold)))
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(min(CELLS, -(-total // BLOCK))).select("raw").toPandas()
    centers = normalised(list(sample["raw"]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = normalised(batch.column("raw").to_pylist()) @ centers.T
            cell = cosine.argmax(1)
            away = _distance(cosine[np.arange(len(cell)), cell])
            arrays = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "weight", "raw", "cell", "away"])

    placed = staged(classes.select("node", "weight", "raw").mapInArrow(assign, "node binary, weight long, raw binary, cell int, away double"), "cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("size"), F.max("away").alias("radius")).orderBy("cell").toPandas()
    subs = {int(c): -(-int(n) // BLOCK) for c, n in zip(cells["cell"], cells["size"], strict=True)}
    blocks = placed.join(F.broadcast(placed.sparkSession.createDataFrame(list(subs.items()), "cell int, subs int")), "cell")
    blocks = blocks.withColumn("sub", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int"))

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["cell", "sub"]):
            parents = build(normalised(run.column("raw").to_pylist()))
            for at in range(0, run.num_rows, 1024):
                part = run.slice(at, 1024).combine_chunks()
                own = parents[:, at : at + part.num_rows].T.astype(np.int32)
                extra = [pa.array(np.arange(at, at + part.num_rows, dtype=np.int32)), pa.array(own.tolist(), pa.list_(pa.int32()))]
                columns = [part.column(c).combine_chunks() for c in ("cell", "sub", "node", "weight", "raw")]
                yield pa.RecordBatch.from_arrays([*columns, *extra], ["cell", "sub", "node", "weight", "raw", "place", "parents"])

    schema = "cell int, sub int, node binary, weight long, raw binary, place int, parents array<int>"
    dealt = blocks.select("cell", "sub", "node", "weight", "raw").repartition("cell", "sub").sortWithinPartitions("cell", "sub", "node")
    trees = staged(dealt.mapInArrow(plant, schema), "trees")
    # Pairs of cells that can hold a link: a table whose size CELLS bounds.
    radius = cells["radius"].to_numpy()
    x = centers[cells["cell"].to_numpy()]
    i, j = np.nonzero(np.triu(_distance(x @ x.T) <= radius[:, None] + radius[None] + reach + SLACK))
    names = cells["cell"].tolist()
    both = [(names[a], names[b], subs[names[b]], 0) for a, b in zip(i, j, strict=True)]
    both += [(names[b], names[a], subs[names[a]], 1) for a, b in zip(i, j, strict=True) if a != b]
    near = F.broadcast(placed.sparkSession.createDataFrame(both, "cell int, other int, others int, turned int"))
    met = trees.join(near, "cell").withColumn("other_sub", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    turned = (F.col("turned") == 1) | ((F.col("cell") == F.col("other")) & (F.col("other_sub") < F.col("sub")))
    own, theirs = F.struct("cell", "sub"), F.struct(F.col("other").alias("cell"), F.col("other_sub").alias("sub"))
    met = met.withColumns({"l": F.when(turned, theirs).otherwise(own), "r": F.when(turned, own).otherwise(theirs)})
    keys = ["l_cell", "l_sub", "r_cell", "r_sub"]
    met = met.withColumns({k: F.col(k.replace("_", ".")) for k in keys}).select(*keys, "cell", "sub", "place", "node", "weight", "raw", "parents")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, keys):
            x = normalised(run.column("raw").to_pylist())
            first = (run.column("cell")[0].as_py(), run.column("sub")[0].as_py())
            left = (run.column("cell").to_numpy() == first[0]) & (run.column("sub").to_numpy() == first[1])
            a, b = np.flatnonzero(left), np.flatnonzero(~left)
            parents = np.array(run.column("parents").to_pylist(), np.int64).T
            # Places become positions in the run: rows are sorted by block and place.
            parents[:, b] += len(a)
            pairs = _Pairs(x, run.column("weight").to_numpy(), parents, threshold)
            whole = all(run.column(f"l_{c}")[0] == run.column(f"r_{c}")[0] for c in ("cell", "sub"))
            if whole or len(b):
                pairs.visit(a, a if whole else b, 0, whole)
            node = run.column("node").combine_chunks()
            some = np.flatnonzero(pairs.counts)
            yield pa.RecordBatch.from_arrays([node.take(pa.array(some)), pa.nulls(len(some), pa.binary()), pa.array(pairs.counts[some])], ["a", "b", "n"])
            if pairs.links:
                ends = [node.take(pa.array(e)) for e in zip(*pairs.links, strict=True)]
                yield pa.RecordBatch.from_arrays([*ends, pa.array(np.zeros(len(pairs.links), np.int64))], ["a", "b", "n"])

    grouped = met.repartition(*keys).sortWithinPartitions(*keys, "cell", "sub", "place")
    return grouped.mapInArrow(compare, "a binary, b binary, n long")


def linked_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Reads ``vec_id`` and ``embedding``. Vectors link if their cosine, in double
    precision, is at least ``threshold``, and only with vectors of the same length. A
    vector that is null, empty or zero, or holds a null or a value that is not finite,
    links with nothing, nor does a row without id. ``component_id`` is the smallest id
    reachable, ``kept`` marks it (and rows without id). Equal vectors are linked;
    repeated rows count as so many vectors. An empty table gives no rows.

    All links are found: blocks whose cells are far apart, and nodes within blocks, are
    left out by bounds that hold for every point. Data without near vectors among far
    ones, such as random directions, leave the bounds little to drop at the level of
    cells; the work then grows with the square of the number of distinct vectors.
    """
    rows = staged(_classes(vectors), "vectors")
    usable = rows.where("node IS NOT NULL AND vec_id IS NOT NULL")
    # Equal nodes have equal vectors: any of them will do.
    grouped = usable.groupBy("node", "raw", "dims").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = staged(grouped, "vector-classes")
    found = None
    for row in classes.select("dims").distinct().orderBy("dims").collect():
        part = _pairs_of(classes.where(F.col("dims") == row["dims"]), threshold)
        found = part if found is None else found.unionByName(part)
    alone = rows.where("node IS NULL OR vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone.withColumn("kept", F.lit(True))
    found = staged(found, "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    named = classes.select("node", "weight", "first").join(counts, "node", "left").join(labels, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    links = (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    by_node = named.join(smallest, "component").select("node", links, "component_id")
    result = usable.select("vec_id", "node").join(by_node, "node").drop("node").unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
