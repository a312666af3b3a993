"""MinHash fingerprints of documents and of edited documents.

A fingerprint is the minima of several universal hash functions over the shingles of
five words, 16 bits of each, as hexadecimal digits. The share of equal minima estimates
the Jaccard similarity. ``similar_documents`` joins bands of signatures to find similar
documents and confirms them on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import minhash, shingle_sets, slices, staged
from docflow.llm.components import connected_components
from docflow.llm.near_dedup import confirmed, full_sets, links_apart, shingled

PERMUTATIONS = 64
#: Rows of a band: 16 bands of 4 find similarities of 0.75 and more with 0.997.
BAND = 4
COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Rows are complete, but for the first and the last document of a part, which carry their text.
ROW, FIRST, LAST = 0, 1, 2


def signatures(texts: list[str]) -> np.ndarray:
    """``PERMUTATIONS`` minima per text, as big-endian 16-bit numbers."""
    out = []
    for part in slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text"):
        out.append((minhash(shingle_sets(part.column("text")), PERMUTATIONS) & 0xFFFF).astype(">u2"))
    return np.concatenate(out) if out else np.zeros((0, PERMUTATIONS), ">u2")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list[int | None], texts: list[str]) -> list[pa.Array]:
    """The columns for each text but the last one, which only follows."""
    changed = [edited(t, n) for t, n in zip(texts[:-1], texts[1:], strict=True)]
    own, other = signatures(texts), signatures(changed)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array([s.tobytes().hex() for s in own[:-1]], pa.string()),
        pa.array([s.tobytes().hex() for s in other], pa.string()),
        pa.array((own[:-1] == other).mean(1) if len(other) else np.zeros(0)),
        pa.array((own[:-1] == own[1:]).mean(1) if len(other) else np.zeros(0)),
    ]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document, with its edited text's fingerprint and how alike they are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The following document is the next by ``doc_id``, after the last the
    first; rows without id come first, equal ids in the order of their texts. Null texts
    are empty; all texts without words have the same fingerprint. A single document
    follows itself. Documents are dealt into ranges of ids; only the first and the last
    document of each range are looked at a second time.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held: tuple[list, list] = ([], [])

        def edge(kind: int) -> pa.RecordBatch:
            nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            columns = [pa.array([kind], pa.int32()), pa.array([shard], pa.int32()), pa.array(held[1]), pa.array(held[0], pa.int64()), *nulls]
            return pa.RecordBatch.from_arrays(columns, ["kind", "shard", "text", *names])

        for batch in batches:
            for part in slices(batch, "text"):
                ids = held[0] + part.column("doc_id").to_pylist()
                texts = held[1] + [t or "" for t in part.column("text").to_pylist()]
                if not held[0]:
                    held = (ids[:1], texts[:1])
                    yield edge(FIRST)
                n = len(ids) - 1
                marks = [pa.array(np.full(n, ROW, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*marks, *_compare(ids[:-1], texts)], ["kind", "shard", "text", *names])
                held = (ids[-1:], texts[-1:])
        if held[0]:
            yield edge(LAST)

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    found = staged(ordered.mapInArrow(scan, f"kind int, shard int, text string, {COLUMNS}"), "fingerprints")
    firsts = found.where(F.col("kind") == FIRST)
    # One row per range, without texts.
    in_turn = W.orderBy("shard")
    following = firsts.select("shard", F.coalesce(F.lead("shard").over(in_turn), F.min("shard").over(W.partitionBy())).alias("next"))
    lasts = found.where(F.col("kind") == LAST).select("shard", "doc_id", "text").join(following, "shard")
    pairs = lasts.join(firsts.select(F.col("shard").alias("next"), F.col("text").alias("following")), "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, after in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                yield pa.RecordBatch.from_arrays(_compare([doc_id], [text, after]), names)

    closed = pairs.select("doc_id", "text", "following").mapInArrow(close, COLUMNS)
    return found.where(F.col("kind") == ROW).select(*names).unionByName(closed)


def similar_documents(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """Links ``doc_id, near_id`` of similar documents that share a band of their signatures.

    In each band every document is compared with the smallest id of its bucket. Members
    of a bucket that these links leave apart are then compared with each other, in blocks
    of bounded size, so that documents whose smallest id is another one are found, too.
    Every link is confirmed on the full sets. Links connect all that is similar in a
    bucket; those between documents already connected may be left out. Documents with
    the same shingles are compared once, and each has a link of its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    signed = staged(shingled(rows, PERMUTATIONS).where("node IS NOT NULL"), "signed")
    by_node = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min_by("signature", "doc_id").alias("signature"))
    classes = staged(by_node, "signed-classes")
    bands = classes.select("doc_id", "node", "signature", F.explode(F.sequence(F.lit(0), F.lit(PERMUTATIONS // BAND - 1))).alias("tree"))
    key = F.xxhash64("tree", F.expr(f"substring(signature, tree * {4 * BAND} + 1, {4 * BAND})"))
    bands = staged(bands.select("doc_id", "node", "tree", key.alias("region")), "bands")
    buckets = bands.groupBy("region").agg(F.count("*").alias("size"), F.min(F.struct("doc_id", "node")).alias("first")).where("size > 1")
    buckets = buckets.select("region", "size", F.col("first.node").alias("a"))
    members = staged(bands.join(buckets, "region"), "band-members")
    pairs = staged(members.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "band-pairs")
    wanted = members.select("doc_id").distinct()
    sets = staged(full_sets(rows.join(wanted, "doc_id", "left_semi")).drop("doc_id"), "band-sets")
    links = staged(confirmed(pairs, sets, similarity), "band-links")
    found = connected_components(links)
    parts = members.where("size > 2").select("tree", "region", "node").join(found, "node", "left")
    parts = parts.withColumn("component", F.coalesce("component", "node"))
    links = links.unionByName(links_apart(parts, classes, sets, similarity, BAND, 0.0))
    ids = classes.select("node", F.col("doc_id").alias("id"))
    ends = links.join(ids.toDF("a", "id_a"), "a").join(ids.toDF("b", "id_b"), "b")
    linked = ends.select(F.when(F.col("id_a") <= F.col("id_b"), F.col("b")).otherwise(F.col("a")).alias("node"), F.least("id_a", "id_b").alias("near_id"))
    near = linked.unionByName(ids.withColumnRenamed("id", "near_id"))
    return signed.select("doc_id", "node").join(near, "node").where("doc_id <> near_id").select("doc_id", "near_id").distinct()
