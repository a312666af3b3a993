"""Dealing documents out to tasks by size."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.session import scratch_dir

#: What opening a file costs, in bytes read: files without bytes are work, too.
FILE_BYTES = 1 << 16
#: Documents of more than a task's share divided by this are dealt out one by one.
FINE = 4
_NUMBERS = ["_part", "_row", "_before"]


def largest_first(costs: list[int], tasks: int) -> tuple[list[int], list[int]]:
    """The task of each cost, largest first to the task with least so far, and the tasks' sums."""
    heap = [(0, t) for t in range(tasks)]
    place = [0] * len(costs)
    for i in sorted(range(len(costs)), key=lambda i: (-costs[i], i)):
        load, task = heapq.heappop(heap)
        place[i] = task
        heapq.heappush(heap, (load + costs[i], task))
    return place, [load for load, _ in sorted(heap, key=lambda entry: entry[1])]


def room_below_level(loads: list[int], amount: int) -> list[int]:
    """How much of ``amount`` each task takes if all are filled up to one level."""
    order = sorted(loads)
    filled = 0
    for i, load in enumerate(order):
        until = order[i + 1] if i + 1 < len(order) else None
        if until is None or filled + (until - load) * (i + 1) >= amount:
            level, spare = divmod(amount - filled, i + 1)
            level += load
            break
        filled += (until - load) * (i + 1)
    room = [max(0, level - load) for load in loads]
    room[min(range(len(loads)), key=lambda t: loads[t])] += spare
    return room


def _costs(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("file_size").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + FILE_BYTES


def _numbered(documents: DataFrame, least: int) -> DataFrame:
    """The rows as files, each with its ``_part`` and ``_row`` there, and the sum of small costs ``_before`` it.

    The numbers are written, too: however the files are split later, they stay.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            cost = _costs(batch)
            small = np.where(cost < least, cost, 0)
            sums = before + np.cumsum(small)
            numbers = [np.full(len(cost), part), at + np.arange(len(cost)), sums - small]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(n, pa.int64()) for n in numbers)], [*batch.schema.names, *_NUMBERS])
            at, before = at + len(cost), int(sums[-1]) if len(sums) else before

    schema = T.StructType([*documents.schema.fields, *(T.StructField(n, T.LongType()) for n in _NUMBERS)])
    path = scratch_dir(documents.sparkSession, "dealt")
    documents.mapInArrow(number, schema).write.parquet(path)
    return documents.sparkSession.read.schema(schema).parquet(path)


def deal_by_size(documents: DataFrame, num_partitions: int) -> DataFrame:
    """Rows in ``num_partitions`` partitions of about the same sum of ``file_size``.

    Documents of a quarter of a task's share or more are at most four per task; the driver
    gives them, largest first, to the task with least. The others fill the tasks up to one
    level, each by its place in the running sum of all. So a task gets at most a share and
    a quarter, or, where one document is more than that, that document. Unknown sizes
    count as none, and every document as ``FILE_BYTES`` more. Names are written once, so
    that a task that runs again deals as before; documents' bytes are not moved.
    """
    cost = F.coalesce(F.col("file_size"), F.lit(0)) + F.lit(FILE_BYTES)
    total = documents.agg(F.sum(cost)).first()[0] or 0
    least = max(FILE_BYTES + 1, total // (FINE * num_partitions))
    rows = _numbered(documents, least)
    # At most four rows per task, and one per part of the names.
    large = F.when(cost >= least, F.struct("_row", cost.alias("cost")))
    parts = rows.groupBy("_part").agg(F.sum(F.when(cost < least, cost).otherwise(0)).alias("small"), F.collect_list(large).alias("large"))
    parts = parts.orderBy("_part").collect()
    fine = [(p["_part"], r["_row"], r["cost"]) for p in parts for r in sorted(p["large"])]
    tasks, loads = largest_first([c for *_, c in fine], num_partitions)
    given = {(p, r): t for (p, r, _), t in zip(fine, tasks, strict=True)}
    small = [p["small"] for p in parts]
    before = dict(zip((p["_part"] for p in parts), np.cumsum([0, *small])[:-1].tolist(), strict=True))
    ends = np.cumsum(room_below_level(loads, sum(small)))
    plan = rows.sparkSession.sparkContext.broadcast((given, before, ends))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, before, ends = plan.value
        for batch in batches:
            part, row, reached = (batch.column(n).to_numpy() for n in _NUMBERS)
            reached = reached + np.array([before[p] for p in part.tolist()], np.int64)
            task = np.minimum(np.searchsorted(ends, reached, "right"), num_partitions - 1)
            for i in np.flatnonzero(_costs(batch) >= least).tolist():
                task[i] = given[part[i], row[i]]
            names = batch.schema.names[: -len(_NUMBERS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(task.astype(np.int32))], [*names, "_task"])

    dealt = rows.mapInArrow(deal, T.StructType([*documents.schema.fields, T.StructField("_task", T.IntegerType())]))
    return dealt.repartitionById(num_partitions, "_task").drop("_task")
