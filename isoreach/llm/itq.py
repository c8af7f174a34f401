"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, reranking.

Rotations of the principal axes are learnt on a bounded sample so that the signs
of the rotated vectors lose the least (iterative quantisation); several rotations
from different starts give a vector's code.  The code is cut into parts, one for
each table, and two vectors are candidates if some part is equal: c parts find
all pairs within c - 1 bits for certain, and pairs further apart with odds that
are measured on the sample.  The width of a part grows with the logarithm of the
number of vectors that it has to tell apart, those of one label and length, so
the vectors that meet by chance stay a few; the number of tables follows from
the width and the recall that is asked for.

Equal vectors are one node.  A bucket is compared in blocks by array arithmetic:
first by a sketch of the code, which rules out most chance meetings, then the
vectors of those that are left, in double precision.  A pair counts only in the
first table that brings it together, so counts add up; of the links themselves
only a spanning forest of each block leaves it.  Buckets beyond the block size
are cut, and every two blocks compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.blocks import dealt, forest, runs
from isoreach.llm.components import components
from isoreach.llm.runtime import release, ship, smallest_hashes, stash
from isoreach.llm.textcore import U64, batches, mix, signed

SIMILAR = 0.93
#: Share of the pairs of just that cosine that the tables must bring together, as measured on the sample.
RECALL = 0.97
#: Bits of the whole code, and of its start, by which candidates are ruled out.
BITS, SKETCH = 512, 128
#: Sketches that differ in more bits are ruled out.  At the cosine asked for 16 bits differ on average, of unrelated vectors 64.
FAR = 48
#: Rows and bytes of the sample that rotations are learnt on, those of the smallest hashes, and the rounds of learning.
SAMPLE, SAMPLE_BYTES, ITERATIONS = 10_000, 64 << 20, 30
#: Members of a bucket that are compared at once; larger buckets are cut into blocks.
BLOCK = 512
#: Narrowest and widest part; a bucket then holds about eight vectors by chance.
LEAST, MOST, SPARE = 8, 32, 3
#: Vectors of one label and length that are simply all compared: they share one bucket.
FEW = 256
#: A centre further out than this isn't taken off: differences from it would no longer follow the angles.
CENTRE = 0.5


def learn(x: np.ndarray, bits: int = BITS, iterations: int = ITERATIONS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) whose signs are the code, for unit vectors x; one rotation for each d bits of d-dimensional vectors."""
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    if np.linalg.norm(mean) > CENTRE:
        mean = np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    c = x - mean
    _, axes = np.linalg.eigh(c.T @ c + 1e-9 * np.eye(d))
    axes = axes[:, ::-1][:, : min(bits, d)]
    v = c @ axes
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
        for _ in range(iterations if len(x) else 0):
            z = v @ r
            u, _, w = np.linalg.svd(np.where(z >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        parts.append(axes @ r)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


@dataclass(frozen=True)
class Model:
    """The code of vectors of one length."""

    mean: np.ndarray
    projection: np.ndarray

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return (unit - self.mean) @ self.projection >= 0

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        """Signs without the centre: of two vectors the share of bits that differ is their angle's share of a half turn."""
        return np.packbits(unit @ self.projection[:, :SKETCH] >= 0, axis=1, bitorder="little").view(U64)

    def places(self, width: int, tables: int) -> np.ndarray:
        """The bits of each table's part; no bit comes again before all have been used."""
        rng = np.random.default_rng(width)
        rounds = math.ceil(width * tables / BITS) + 1
        return np.concatenate([rng.permutation(BITS) for _ in range(rounds)])[: width * tables].reshape(tables, width)

    def parts(self, signs: np.ndarray, places: np.ndarray) -> np.ndarray:
        return signs[:, places] @ (1 << np.arange(places.shape[1], dtype=np.int64))

    def tables(self, unit: np.ndarray, width: int) -> int:
        """The least number of tables of this width that bring together the share RECALL of sampled pairs of cosine SIMILAR."""
        if len(unit) < 2 or not width:
            return 1
        rng = np.random.default_rng(width)
        x = unit[:1000]
        y = unit[rng.permutation(len(unit))[: len(x)]] + 1e-3 * rng.standard_normal(x.shape)
        y = y - (x * y).sum(axis=1, keepdims=True) * x
        y = SIMILAR * x + math.sqrt(1 - SIMILAR**2) * unit_vectors(y)
        most = 4 * math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - math.acos(SIMILAR) / math.pi) ** width))
        places = self.places(width, most)
        met = np.zeros(len(x), dtype=bool)
        a, b = self.signs(x), self.signs(y)
        for k in range(most):
            met |= (a[:, places[k]] == b[:, places[k]]).all(axis=1)
            if met.mean() >= RECALL:
                return k + 1
        return most


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows of length one; they are scaled by their largest number first, so that no square overflows."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) of a column of lists."""
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, _matrix(column.take(pa.array(rows)), dim)


def _index(models: dict[int, Model], tables: dict[tuple[int, int], int]):
    """Rows of the tables: bucket, uid, grp, at (the table), and the sketch."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 4096):
            uid, grp, wide = (b.column(k).to_numpy() for k in range(3))
            for dim, rows, vectors in _by_length(b.column(3)):
                unit = unit_vectors(vectors)
                signs, sketch = models[dim].signs(unit), signed(models[dim].sketches(unit))
                for width in np.unique(wide[rows]).tolist():
                    n, some = tables[dim, width], np.flatnonzero(wide[rows] == width)
                    part = models[dim].parts(signs[some], models[dim].places(width, n)).astype(U64)
                    group = grp[rows[some]].view(U64)
                    bucket = mix(mix(group[:, None] ^ (np.arange(n, dtype=U64) * U64(0x9E3779B97F4A7C15))) ^ part)
                    cols = [signed(bucket.reshape(-1)), np.repeat(uid[rows[some]], n), np.repeat(grp[rows[some]], n), np.tile(np.arange(n, dtype=np.int32), len(some)), np.repeat(sketch[some, 0], n), np.repeat(sketch[some, 1], n)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["bucket", "uid", "grp", "at", "s0", "s1"])

    return run


#: Runs of rows up to this length are compared by shifting whole columns, longer ones each by itself.
SHORT = 24


def _met(t: pa.Table, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs within each run of one bucket's blocks that are in one group and table, and not far apart by their sketches."""
    uid, grp, at, blk = (t[c].to_numpy() for c in ("uid", "grp", "at", "blk"))
    sketch = np.stack([t["s0"].to_numpy(), t["s1"].to_numpy()]).view(U64)
    single = t["gi"].to_numpy() == t["gj"].to_numpy()

    def near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = (uid[a] != uid[b]) & (grp[a] == grp[b]) & (at[a] == at[b]) & (single[a] | (blk[a] != blk[b]))
        a, b = a[keep], b[keep]
        keep = np.bitwise_count(sketch[:, a] ^ sketch[:, b]).sum(axis=0) <= FAR
        return a[keep], b[keep]

    sizes = np.diff(bounds)
    run = np.repeat(np.arange(len(sizes)), sizes)
    short = np.repeat(sizes <= SHORT, sizes)
    rows = np.arange(len(uid))
    for lag in range(1, min(SHORT, int(sizes.max()))):
        i = rows[lag:][short[lag:] & (run[lag:] == run[:-lag])]
        if not len(i):
            break
        yield near(i, i - lag)
    for k in np.flatnonzero(sizes > SHORT).tolist():
        lo, hi = int(bounds[k]), int(bounds[k + 1])
        for part in range(lo, hi, 256):
            i, j = np.meshgrid(np.arange(part, min(part + 256, hi)), np.arange(lo, hi), indexing="ij")
            keep = i > j
            yield near(i[keep], j[keep])


def _near(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of buckets that have a pair near enough by their sketches."""
    for t, bounds in runs(it):
        some = np.zeros(len(t), dtype=bool)
        for a, b in _met(t, bounds):
            some[a] = some[b] = True
        if some.any():
            yield from t.filter(pa.array(some)).combine_chunks().to_batches()


def _link(models: dict[int, Model], tables: dict[tuple[int, int], int]):
    """Links between the members of buckets: how many each has, by copies, and a spanning forest of them."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in runs(it):
            uid, copies, at, wide = (t[c].to_numpy() for c in ("uid", "copies", "at", "wide"))
            n = np.zeros(len(uid), dtype=np.int64)
            left, right = [], []
            units: dict[int, np.ndarray] = {}
            parts: dict[tuple[int, int], np.ndarray] = {}
            place = np.zeros(len(uid), dtype=np.int64)  # a row's place among those of its length, and of its width there
            dims = np.zeros(len(uid), dtype=np.int64)
            for dim, rows, vectors in _by_length(t["vector"].combine_chunks()):
                units[dim], place[rows], dims[rows] = unit_vectors(vectors), np.arange(len(rows)), dim
                signs = models[dim].signs(units[dim])
                for width in np.unique(wide[rows]).tolist():
                    parts[dim, width] = models[dim].parts(signs, models[dim].places(width, tables[dim, width]))
            for a, b in _met(t, bounds):
                for dim, width in parts:
                    own = (dims[a] == dim) & (wide[a] == width) & (dims[b] == dim)
                    i, j = a[own], b[own]
                    first = np.ones(len(i), dtype=bool)
                    code, k = parts[dim, width], at[i]
                    for before in range(int(k.max()) if len(k) else 0):  # a pair counts in the first table that it meets in
                        first &= (before >= k) | (code[place[i], before] != code[place[j], before])
                    i, j = i[first], j[first]
                    cosine = np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", units[dim][place[i[lo : lo + 65_536]]], units[dim][place[j[lo : lo + 65_536]]]) for lo in range(0, len(i), 65_536))])
                    i, j = i[cosine >= SIMILAR], j[cosine >= SIMILAR]
                    n += np.bincount(i, weights=copies[j], minlength=len(uid)).astype(np.int64) + np.bincount(j, weights=copies[i], minlength=len(uid)).astype(np.int64)
                    left.append(i)
                    right.append(j)
            if not left or not sum(map(len, left)):
                continue
            node, root = forest(np.concatenate(left), np.concatenate(right), uid)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([uid[some], node])), pa.array(np.concatenate([n[some], np.zeros(len(node), dtype=np.int64)])), pa.array(np.concatenate([uid[some], root]))],
                names=["uid", "n", "other"],
            )

    return run


def _sizes(rows: DataFrame) -> DataFrame:
    """Buckets of several rows, and the blocks each is cut into."""
    count = rows.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    return count.select(F.col("bucket").alias("sbucket"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))


def _models(nodes: DataFrame) -> tuple[dict[int, Model], dict[tuple[int, int], int]]:
    """A model for each length of vectors, and the number of tables for each width of a part that is in use."""
    models, tables = {}, {}
    widths: dict[int, list[int]] = {}
    for r in nodes.select("dim", "wide").distinct().collect():  # a few widths for each length
        widths.setdefault(r.dim, []).append(r.wide)
    for dim, used in widths.items():
        rows = min(SAMPLE, max(2, SAMPLE_BYTES // (8 * dim)))
        sample = smallest_hashes(nodes.where(F.col("dim") == dim).select("uid", "vector"), "uid", rows).toPandas()["vector"]
        x = unit_vectors(np.array(sample.tolist(), dtype=np.float64).reshape(-1, dim))
        models[dim] = Model(*learn(x))
        for width in used:
            tables[dim, width] = models[dim].tables(x, width)
    return models, tables


def similar_vectors(spark: SparkSession, embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Links of cosine >= 0.93 among vectors of one label, and their components.

    Returns one row per input row: vec_id, n_links (other vectors linked
    directly), component_id (smallest id reachable), kept.  Labels may be of any
    type; vectors of different lengths are never linked.  Null, empty, zero or
    non-finite vectors, null labels and null ids link with nothing.  Repeated rows,
    and rows that repeat an id, count as vectors of their own; an empty table gives
    an empty result.
    """
    ship(spark)
    base = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    base = stash(spark, base.select("vec_id", F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("vector")).alias("vector")), "vectors")
    # equal vectors of a label are one node with a number of copies
    nodes = base.where("vector is not null").groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("uid"), F.size("vector").alias("dim"), "label", "vector", "id", "copies")
    nodes = stash(spark, nodes.withColumn("grp", F.xxhash64("label", "dim")), "nodes")
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("rows")).where("rows > 1")
    wide = F.when(F.col("rows") <= FEW, 0).otherwise(F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.ceil(F.log2("rows")) - SPARE))).cast("int")
    sizes = sizes.select(F.col("grp").alias("sgrp"), wide.alias("wide"))
    grouped = stash(spark, nodes.join(sizes, nodes.grp == sizes.sgrp).select("uid", "grp", "wide", "dim", "vector", "copies"), "grouped")
    models, tables = _models(grouped)

    sketch = ["grp", "at", "s0", "s1"]
    rows = stash(spark, grouped.select("uid", "grp", "wide", "vector").mapInArrow(_index(models, tables), "bucket long, uid long, grp long, at int, s0 long, s1 long"), "tables")
    near = dealt(rows, _sizes(rows), sketch, "uid").mapInArrow(_near, "bucket long, gi int, gj int, blk int, uid long, grp long, at int, s0 long, s1 long")
    near = stash(spark, near.select("bucket", "uid", *sketch).distinct(), "near")
    release(spark, rows)
    payload = grouped.select(F.col("uid").alias("nid"), "vector", "copies", "wide")
    held = near.join(payload, near.uid == payload.nid).select("bucket", "uid", *sketch, "vector", "copies", "wide")
    found = dealt(held, _sizes(near), [*sketch, "vector", "copies", "wide"], "uid").mapInArrow(_link(models, tables), "uid long, n long, other long")
    found = stash(spark, found, "vector-links")
    release(spark, near, grouped)
    labels = components(spark, found.select(F.col("uid").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("uid").agg(F.sum("n").alias("others")).select(F.col("uid").alias("cid"), "others")
    each = nodes.join(counts, nodes.uid == counts.cid, "left").join(labels, nodes.uid == labels.node, "left")
    each = each.select("label", "vector", "id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "uid").alias("root"))
    each = stash(spark, each, "each")
    smallest = each.groupBy("root").agg(F.min("id").alias("component")).select(F.col("root").alias("sroot"), "component")
    result = each.join(smallest, each.root == smallest.sroot).select(F.col("label").alias("nlabel"), F.col("vector").alias("nvector"), "n_links", "component")
    out = base.join(result, (F.col("label") == F.col("nlabel")) & (F.col("vector") == F.col("nvector")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
