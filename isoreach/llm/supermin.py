"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find.

SuperMinHash gives every element its own pseudo-random permutation of the
registers: at level j the element offers the value j + u_j to register p_j.  A
register keeps its minimum, so once all registers hold values below j + 1 no
later level can change them, and the walk stops there.  The registers of one
set are then filled without repetition, which lowers the estimate's variance.

Candidates are the documents that share a band.  Documents with equal sets are
one node from the start.  Within a band's bucket, links are sought against a hub
first, because components are all that the result needs; buckets whose members
already are in one component hold no further news.  For the rest, the shingles
that only one of them has are counted: they bound every intersection, so most
pairs are ruled out exactly, and the members with the fewest such shingles, to
which edited copies of one text are closest, become the next hubs.  What then
still is in several components of one bucket is compared in full, in blocks of
a bounded size, of which only a spanning forest of the links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.blocks import dealt, forest, groups, intersections
from isoreach.llm.components import components
from isoreach.llm.runtime import release, ship, stash
from isoreach.llm.textcore import U64, batches, lower_words, mix, raw, shingles, signed

#: Registers, and registers in a band.  At similarity 0.75 a pair shares none of 24 bands with odds of 2 in a million.
REGISTERS, BAND = 72, 3
#: Members of a bucket that are compared at once in the last step; larger buckets are cut into blocks.
BLOCK = 384
SIMILAR = 75


def _levels(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(hashes + U64((2 * level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return x >> U64(32), x & U64(0xFFFFFFFF)


def signatures(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signatures (one row a set) as integers level * 2**32 + fraction; an empty set has all ones."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full((len(sets), m), np.iinfo(np.int64).max, dtype=np.int64)
    if not sizes.sum():
        return out
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    perm: np.ndarray | None = None
    for level in range(m):
        if level:
            open_sets = (out >= (level << 32)).any(axis=1)  # early stopping: a full set is left alone
            keep = open_sets[owner]
            if not keep.any():
                break
            elements, owner = elements[keep], owner[keep]
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(elements), 1))
                _swap(perm, 0, (_levels(elements, 0)[0] * U64(m) >> U64(32)).astype(np.int64))
            else:
                perm = perm[keep]
        pick, fraction = _levels(elements, level)
        k = level + (pick * U64(m - level) >> U64(32)).astype(np.int64)
        if level:
            _swap(perm, level, k)
            k = perm[:, level].astype(np.int64)
        np.minimum.at(out.reshape(-1), owner * m + k, (level << 32) + fraction.astype(np.int64))
    return out


def _swap(perm: np.ndarray, level: int, k: np.ndarray) -> None:
    rows = np.arange(len(perm))
    a, b = perm[:, level].copy(), perm[rows, k]
    perm[rows, k] = a
    perm[:, level] = b


def band_keys(sig: np.ndarray, band: int = BAND) -> np.ndarray:
    n, m = sig.shape
    parts = sig.astype(U64).reshape(n, m // band, band)
    key = np.broadcast_to(mix(np.arange(m // band, dtype=U64) + U64(17)), (n, m // band)).copy()
    for k in range(band):
        key = mix(key ^ parts[:, :, k]) * U64(0x9E3779B97F4A7C15)
    return key


def _sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it, 256):
        sets = [np.unique(shingles(lower_words(t))) for t in raw(b.column(1))]
        full = [k for k, s in enumerate(sets) if len(s)]
        bands: list[np.ndarray | None] = [None] * len(sets)
        keys = band_keys(signatures([sets[k] for k in full]))
        for row, k in enumerate(full):
            bands[k] = signed(keys[row])
        prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "fp", "bands"],
        )


def _set(text: bytes) -> np.ndarray:
    return np.unique(shingles(lower_words(text)))


def _stored(elements: bytes) -> np.ndarray:
    return np.frombuffer(elements, dtype=U64)


def _verify(make):
    """Keep the pairs (a, b, x, y) whose sets, made of x and y, are similar; a set that comes again is kept for the next row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple[bytes | None, np.ndarray]] = [(None, np.empty(0, dtype=U64))] * 2
        for b in batches(it):
            ok = []
            for pair in zip(_bytes(b.column(2)), _bytes(b.column(3)), strict=True):
                for k, x in enumerate(pair):
                    if x != last[k][0]:
                        last[k] = (x, make(x))
                s, t = last[0][1], last[1][1]
                both = np.concatenate([s, t])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                ok.append(100 * same >= SIMILAR * (len(s) + len(t) - same))
            kept = pc.filter(pa.Table.from_batches([b.select([0, 1])]), pa.array(ok, pa.bool_()))
            yield from kept.to_batches()

    return run


def _bytes(column: pa.Array) -> list[bytes]:
    return column.to_pylist() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else raw(column)


def verified(pairs: DataFrame, table: DataFrame, key: str, value: str, make) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    The contents are joined by sorting at every size, never broadcast, and a hub's
    rows may be split.
    """
    a, b = (table.select(F.col(key).alias(f"i{s}"), F.col(value).alias(f"t{s}")).hint("merge") for s in "ab")
    rows = pairs.join(a, pairs.a == a.ia).select("a", "b", "ta")
    rows = rows.join(b, rows.b == b.ib).select("a", "b", "ta", "tb")
    return rows.mapInArrow(_verify(make), "a long, b long")


#: Whether two sets can be similar enough, from their sizes and from how many of each one's shingles no other live set has.
_POSSIBLE = f"100 * least(na - ea, nb - eb) >= {SIMILAR} * (na + nb - least(na - ea, nb - eb))"


def _hub_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of each member of a bucket with its hub; at first the smallest id, then the member with the fewest shingles of its own."""
    order = F.struct("rep", "n", "e", "label") if turn == 0 else F.struct(F.col("e").alias("o"), "rep", "n", "e", "label")
    hub = rows.groupBy("key").agg(F.min(order).alias("h"))
    hub = hub.select(F.col("key").alias("hkey"), F.col("h.rep").alias("b"), F.col("h.n").alias("nb"), F.col("h.e").alias("eb"), F.col("h.label").alias("lb"))
    members = rows.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("e").alias("ea"), F.col("label").alias("la"))
    return members.join(hub, (F.col("key") == F.col("hkey")) & F.expr("a <> b and la <> lb") & F.expr(_POSSIBLE)).select("a", "b")


def _binary(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it, 256):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.unique(shingles(lower_words(t))).tobytes() for t in raw(b.column(1))], pa.binary())], names=["rep", "elements"])


def _compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components within each pair of blocks, as a spanning forest."""
    for _, t in groups(it):
        if len(t) < 2:
            continue
        ids, label = t["rep"].to_numpy(), t["label"].to_numpy()
        sets = [np.frombuffer(x, dtype=U64) for x in t["elements"].to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        most = sizes - t["e"].to_numpy().astype(np.int32)
        least = np.minimum(most[:, None], most[None, :])
        possible = (label[:, None] != label[None, :]) & (100 * least >= SIMILAR * (sizes[:, None] + sizes[None, :] - least))
        rows = np.flatnonzero(possible.any(axis=1))  # the others can't be linked
        if not len(rows):
            continue
        same = intersections([sets[k] for k in rows], 1024).astype(np.int32)
        union = sizes[rows][:, None] + sizes[rows][None, :] - same
        a, b = np.nonzero(possible[np.ix_(rows, rows)] & (100 * same >= SIMILAR * union))
        node, root = forest(rows[a], rows[b], ids)
        yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], names=["a", "b"])


def compared(live: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the components that are left in a bucket, by full sets, block by block."""
    held = sets.select(F.col("rep").alias("srep"), "elements").hint("merge")
    rows = live.join(held, live.rep == held.srep).select(F.col("key").alias("bucket"), "rep", "e", "label", "elements")
    sizes = live.groupBy(F.col("key").alias("sbucket")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return dealt(rows, sizes, ["e", "label", "elements"], "rep").mapInArrow(_compare, "a long, b long")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of the buckets whose members are in more than one component."""
    mixed = rows.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1").select(F.col("key").alias("mkey"))
    return rows.join(mixed, rows.key == mixed.mkey).select("rep", "n", "key", "e", "label")


def _own(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it, 256):
        sets = [_stored(x) for x in b.column(1).to_pylist()]
        ids = np.repeat(b.column(0).to_numpy(), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(signed(np.concatenate(sets)))], names=["rep", "shingle"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """sets (rep, elements) -> orep, own: how many of a node's shingles no other node has.  At most that many can't be in an intersection."""
    owners = sets.mapInArrow(_own, "rep long, shingle long").groupBy("shingle").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    return owners.where("first = last").groupBy(F.col("first").alias("orep")).agg(F.count("*").alias("own"))


def sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """rep, elements: the shingle sets of some nodes."""
    texts = nodes.join(docs.hint("merge"), F.col("rep") == F.col("doc_id")).select("rep", "text")
    return texts.mapInArrow(_binary, "rep long, elements binary")


def near_duplicates(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents by links of Jaccard similarity >= 0.75 on sets of five-word shingles.

    Returns doc_id, n_shingles, component_id (the smallest id reachable), kept
    (doc_id = component_id), one row per input row.  A null or wordless text has
    an empty set and no links.  A row without an id links with nothing, has a
    null component_id and is kept.  Rows that repeat an id are one node.  Other
    columns of the input are ignored; an empty table gives an empty result.
    """
    ship(spark)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed_docs = stash(spark, docs.mapInArrow(_sign, "doc_id long, n_shingles long, fp binary, bands array<bigint>"), "signatures")
    usable = signed_docs.where("n_shingles > 0 and doc_id is not null")
    same = usable.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    same = stash(spark, same, "sets")
    rows = stash(spark, same.select("rep", "n", F.explode("bands").alias("key")), "bands")
    # a bucket of one member offers nothing
    shared = rows.groupBy("key").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 < r1").select(F.col("key").alias("skey"))
    live = stash(spark, rows.join(shared, rows.key == shared.skey).select("rep", "n", "key", F.lit(0).cast("long").alias("e"), F.col("rep").alias("label")), "live")
    release(spark, rows)

    links, labels = None, None
    for turn in range(2):
        pairs = _hub_pairs(live, turn).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stash(spark, pairs, "pairs")
        found = verified(pairs, docs, "doc_id", "text", _set) if turn == 0 else verified(pairs, sets, "rep", "elements", _stored)
        found = stash(spark, found, "links")
        links = found if links is None else links.unionByName(found)
        labels = stash(spark, components(spark, links), "labels")
        # only buckets whose members still are in more than one component go on
        new = live.drop("label").join(labels, live.rep == labels.node, "left").drop("node").withColumn("label", F.coalesce("component", "rep")).drop("component")
        if turn == 0:
            new = stash(spark, _mixed(new), "mixed")
            sets = stash(spark, sets_of(new.select("rep").distinct(), docs), "sets")
            own = own_shingles(sets)
            new = new.drop("e").join(own, new.rep == own.orep, "left").select("rep", "n", "key", F.coalesce("own", F.lit(0)).alias("e"), "label")
            new = new.where(F.lit(100) * (F.col("n") - F.col("e")) >= F.lit(SIMILAR) * F.col("n"))  # no link can exist beyond that
        live = stash(spark, _mixed(stash(spark, new, "labelled")), "live")
        if live.isEmpty():
            break
    else:
        rest = stash(spark, compared(live, sets), "rest")
        if not rest.isEmpty():
            labels = stash(spark, components(spark, links.unionByName(rest)), "labels")
    to_rep = same.select(F.col("fp").alias("sfp"), "rep")
    to_rep = stash(spark, to_rep.join(labels, F.col("rep") == F.col("node"), "left").select("sfp", F.coalesce("component", "rep").alias("rep")), "classes")
    base = signed_docs.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("fp")).alias("fp"))
    out = base.join(to_rep, base.fp == to_rep.sfp, "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
