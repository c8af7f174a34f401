"""Comparing the members of buckets by array arithmetic, large buckets cut into blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(rows: DataFrame, sizes: DataFrame, columns: list[str], member: str = "id", parts: int | None = None) -> DataFrame:
    """Rows (bucket, member, columns) dealt to the pairs of their bucket's blocks, and sorted by them.

    sizes (sbucket, blocks) says how many blocks a bucket is cut into; a row goes
    to its own block's pairs with every block, so every two rows of a bucket meet
    in one pair, and no task holds more than two blocks at a time.  parts: the
    number of tasks, which Spark then doesn't lower because the rows are few.
    """
    joined = rows.join(sizes, rows.bucket == sizes.sbucket)
    blk = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    rows = joined.withColumn("blk", blk).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("blk", "j").cast("int").alias("gi"), F.greatest("blk", "j").cast("int").alias("gj"), "blk", member, *columns)
    by = ("bucket", "gi", "gj")
    return (rows.repartition(parts, *by) if parts else rows.repartition(*by)).sortWithinPartitions(*by)


def groups(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], pa.Table]]:
    """Runs of rows of one (bucket, gi, gj), the first three columns, from rows sorted by them."""
    held: list[pa.Table] = []
    last = None
    for b in it:
        if not b.num_rows:
            continue
        g = [b.column(k).to_numpy() for k in range(3)]
        change = np.flatnonzero((g[0][1:] != g[0][:-1]) | (g[1][1:] != g[1][:-1]) | (g[2][1:] != g[2][:-1])) + 1
        starts = np.concatenate([[0], change, [b.num_rows]])
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            key = (int(g[0][lo]), int(g[1][lo]), int(g[2][lo]))
            if key != last and held:
                yield last, pa.concat_tables(held)
                held = []
            last = key
            held.append(pa.Table.from_batches([b.slice(lo, hi - lo)]))
    if held:
        yield last, pa.concat_tables(held)


def runs(it: Iterator[pa.RecordBatch], rows: int = 65_536) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of one (bucket, gi, gj), the first three columns, from rows sorted by them, and the runs' bounds.

    Runs are gathered until a table has about the rows; none is cut.
    """
    held: list[pa.RecordBatch] = []
    waiting = 0

    def out(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        g = [t.column(k).to_numpy() for k in range(3)]
        change = np.flatnonzero((g[0][1:] != g[0][:-1]) | (g[1][1:] != g[1][:-1]) | (g[2][1:] != g[2][:-1])) + 1
        return t, np.concatenate([[0], change, [len(t)]])

    for b in it:
        if not b.num_rows:
            continue
        held.append(b)
        waiting += b.num_rows
        if waiting >= rows:
            t, bounds = out(pa.Table.from_batches(held).combine_chunks())
            cut = int(bounds[-2])  # the last run may go on
            if cut:
                yield t.slice(0, cut).combine_chunks(), bounds[:-1]
            held, waiting = t.slice(cut).combine_chunks().to_batches(), 0
    if held:
        yield out(pa.Table.from_batches(held).combine_chunks())


def forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows -> (id, smallest id of its component here) for the rows that aren't the smallest."""
    label = ids.copy()
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        if (old == label).all():
            rows = np.union1d(a, b)
            rows = rows[ids[rows] != label[rows]]
            return ids[rows], label[rows]


def intersections(sets: list[np.ndarray], chunk: int = 2048) -> np.ndarray:
    """Sizes of the intersections of every two sets, from the incidence of the elements that two sets hold at least."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    owner, column = owner[keep], column[at[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    n = int(shared.sum())
    ends = np.searchsorted(column, np.arange(0, n + chunk, chunk))
    for k, lo in enumerate(range(0, n, chunk)):
        part = slice(ends[k], ends[k + 1])
        x = np.zeros((len(sets), min(chunk, n - lo)), dtype=np.float32)
        x[owner[part], column[part] - lo] = 1
        total += x @ x.T
    return total
