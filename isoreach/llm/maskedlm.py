"""LM scoring by masked pseudo-likelihood.

A small network predicts a masked token from the tokens on both of its sides:
embeddings of the nearest neighbours, one table for each offset, and of those
further off, one table for all, are summed into a hidden layer; a two-level
softmax then gives a cluster and a token of the cluster.  A document's score is
the sum over all its tokens of the log-probability of the token given both sides.

The vocabulary and its frequencies are counted over the whole corpus.  The rest
of the tokens share slots by their endings.  Documents are dealt to shards by a
hash, and lie in a shard in the order of the hash, so what a shard's training
sees doesn't depend on how the input is partitioned.  Training visits every
position once: in each round every shard walks its documents with minibatch
gradient steps, from the round's model on, with the positions whose turn it is;
the shards' models are averaged, weighted with the positions seen, in two
levels of sums over binary slices of the parameters.  What is gathered thus
grows with the corpus, while the driver only ever holds one model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import release, ship, stash
from isoreach.llm.textcore import CACHE_WORDS, U64, batches, lower_words, mix, raw, signed

#: Clusters and tokens in each; SHARED slots are for the tokens outside the most frequent ones.
CLUSTERS, WIDTH, SHARED = 64, 128, 512
VOCAB = CLUSTERS * WIDTH
#: Places of the context, and the table of each.
OFFSETS = (-2, -1, 1, 2, -6, -5, -4, -3, 3, 4, 5, 6)
TABLE = (0, 1, 2, 3, 4, 4, 4, 4, 4, 4, 4, 4)
REACH = max(OFFSETS)
HIDDEN = 12
#: Every position is a target in one of the rounds; minibatches grow from LEAST to MOST as a shard has seen more.
ROUNDS, LEAST, MOST, RATE = 2, 128, 6144, 0.08
SEED = 41
#: Rows of the hidden layer, and clusters, that are worked on at once: their arrays stay in the cache.
PART, TOGETHER = 4096, 8
#: Tokens of a shard, about.  Its file is one Parquet row group, so one task reads it as a whole.
SHARD = 1_000_000
#: Parameters in a slice, and the sums of the first level.
SLICE, SUMS = 1 << 14, 8
#: Largest weights: a sum of 12 weights and a bias stays below 85, which exp() can take.
BOUND, BIAS_BOUND = 4.0, 20.0

#: cw and tw have a last row for the bias, which the last hidden unit, always one, brings in.
_SHAPES = {"emb": (max(TABLE) + 1, VOCAB + 1, HIDDEN), "bias": (HIDDEN,), "cw": (HIDDEN + 1, CLUSTERS), "tw": (CLUSTERS, HIDDEN + 1, WIDTH)}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


class Vocabulary(dict):
    """Tokens -> ids; ids below VOCAB - SHARED are the most frequent tokens, the others are shared by their last three bytes.  Tokens seen are kept."""

    def __init__(self, hashes: np.ndarray) -> None:
        super().__init__()
        self.rank = {int(h): k for k, h in enumerate(hashes)}

    def __reduce__(self):  # the tokens seen stay behind
        return Vocabulary, (np.array(list(self.rank), dtype=U64),)

    def __missing__(self, token: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(token)
        k = self.rank.get(h)
        self[token] = k = VOCAB - SHARED + xxhash.xxh3_64_intdigest(token[-3:]) % SHARED if k is None else k
        return k


def encode(texts: list[bytes | None], vocabulary: Vocabulary) -> list[np.ndarray]:
    return [np.fromiter(map(vocabulary.__getitem__, words := lower_words(t)), dtype=np.int16, count=len(words)) for t in texts]


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids with REACH pads around each text, places of the tokens in it, tokens of each text)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.concatenate(texts) if texts else np.empty(0, dtype=np.int16)
    place = np.arange(len(ids)) + REACH * np.repeat(np.arange(1, len(texts) + 1), sizes)
    padded = np.full(len(ids) + REACH * (len(texts) + 1), VOCAB, dtype=np.int32)
    padded[place] = ids
    return padded, place, sizes


def _encode(vocabulary: Vocabulary, shards: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 256):
            ids = [x.tobytes() for x in encode(raw(b.column(1)), vocabulary)]
            dealt = [xxhash.xxh3_64_intdigest(x, seed=(-1 if doc is None else doc) & 0xFFFFFFFFFFFFFFFF) for doc, x in zip(b.column(0).to_pylist(), ids, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([h % shards for h in dealt], pa.int32()), pa.array([h >> 1 for h in dealt], pa.int64())], names=["doc_id", "ids", "shard", "dealt"])

    return run


def encoded(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, tokens: int) -> DataFrame:
    """Stored doc_id, ids, shard, with the rows of a shard together and in an order of their own; split once for all later passes."""
    shards = max(1, -(-tokens // SHARD))
    rows = docs.mapInArrow(_encode(vocabulary, shards), "doc_id long, ids binary, shard int, dealt long")
    return stash(spark, rows.repartition(shards, "shard").sortWithinPartitions("shard", "dealt").select("doc_id", "ids", "shard"), "token-ids")


def _stored(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.int16) for x in column.to_pylist()]


def _softmax(z: np.ndarray) -> np.ndarray:
    """In place; sums beyond what exp() can take are cut off, which bounded weights never reach."""
    np.minimum(z, 80.0, out=z)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def hidden(m: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    """The hidden layer, with a last unit that is always one."""
    n = context.shape[1]
    out = np.ones((n, HIDDEN + 1), dtype=np.float32)
    part = np.empty((min(n, PART), HIDDEN), dtype=np.float32)
    for lo in range(0, n, PART):
        hi = min(n, lo + PART)
        x, more = m["emb"][TABLE[0]].take(context[0, lo:hi], axis=0), part[: hi - lo]
        for k in range(1, len(OFFSETS)):
            x += m["emb"][TABLE[k]].take(context[k, lo:hi], axis=0, out=more, mode="clip")  # ids are in range; other modes buffer
        x += m["bias"]
        np.tanh(x, out=out[lo:hi, :HIDDEN])
    return out


def log_probs(m: dict[str, np.ndarray], padded: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log P(token | both sides) at each place.

    The weights are bounded (see fit), so the sums of exponentials can't overflow.
    """
    out = np.empty(len(place), dtype=np.float64)
    for lo in range(0, len(place), 32_768):
        p = place[lo : lo + 32_768]
        t = padded[p]
        cluster = (t % CLUSTERS).astype(np.uint8)
        order = np.argsort(cluster, kind="stable")  # tokens by cluster: each cluster's rows lie together
        p, t, cluster = p[order], t[order], cluster[order]
        h = hidden(m, np.stack([padded[p + o] for o in OFFSETS]))
        z = h @ m["cw"]
        rows = np.arange(len(p))
        got = z[rows, cluster]
        got -= np.log(np.exp(z, out=z).sum(axis=1))
        w = t // CLUSTERS
        ends = np.searchsorted(cluster, np.arange(CLUSTERS + 1))
        for k in range(CLUSTERS):
            a, b = ends[k], ends[k + 1]
            if a < b:
                y = h[a:b] @ m["tw"][k]
                got[a:b] += y[rows[: b - a], w[a:b]]
                got[a:b] -= np.log(np.exp(y, out=y).sum(axis=1))
        out[lo + order] = got
    return out


def _descend(w: np.ndarray, g2: np.ndarray, g: np.ndarray, at=slice(None)) -> None:
    """An AdaGrad step on the rows at of w."""
    total = g * g
    if isinstance(at, slice):
        g2 += total
        np.sqrt(g2, out=total)
    else:
        total += g2[at]
        g2[at] = total
        np.sqrt(total, out=total)
    total += 1e-6
    change = RATE * g
    change /= total
    w[at] -= change


def _scatter(w: np.ndarray, g2: np.ndarray, ids: np.ndarray, g: np.ndarray) -> None:
    """A step on the rows of w that ids name, by the sums of their gradients."""
    by = np.argsort(ids, kind="stable")
    ids = ids[by]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    _descend(w, g2, np.add.reduceat(g[by], starts, axis=0), ids[starts])


def step(m: dict[str, np.ndarray], g2: dict[str, np.ndarray], padded: np.ndarray, place: np.ndarray) -> None:
    """One step on a minibatch, the tokens at rising places; of the embeddings only the rows that it touches are changed."""
    n, rows = np.float32(len(place)), np.arange(len(place))
    target = padded[place]
    c = (target % CLUSTERS).astype(np.uint8)
    order = np.argsort(c, kind="stable")  # as in log_probs
    c, w, at = c[order], target[order] // CLUSTERS, place[order]
    ends = np.searchsorted(c, np.arange(CLUSTERS + 1)).tolist()
    h = hidden(m, np.stack([padded[at + o] for o in OFFSETS]))
    d = _softmax(h @ m["cw"])
    d[rows, c] -= 1
    dh = d @ m["cw"].T
    _descend(m["cw"], g2["cw"], h.T @ d / n)
    g = np.zeros(_SHAPES["tw"], dtype=np.float32)
    for first in range(0, CLUSTERS, TOGETHER):  # some clusters at a time, so that their rows stay in the cache
        some = [(k, ends[k], ends[k + 1]) for k in range(first, first + TOGETHER) if ends[k] < ends[k + 1]]
        begin, end = ends[first], ends[first + TOGETHER]
        d = np.empty((end - begin, WIDTH), dtype=np.float32)
        for k, lo, hi in some:
            np.matmul(h[lo:hi], m["tw"][k], out=d[lo - begin : hi - begin])
        _softmax(d)
        d[rows[: end - begin], w[begin:end]] -= 1
        for k, lo, hi in some:
            np.matmul(h[lo:hi].T, d[lo - begin : hi - begin], out=g[k])
            dh[lo:hi] += d[lo - begin : hi - begin] @ m["tw"][k].T
    g /= n
    _descend(m["tw"], g2["tw"], g)
    dx = dh[:, :HIDDEN] * (1 - h[:, :HIDDEN] * h[:, :HIDDEN])
    dx /= n
    _descend(m["bias"], g2["bias"], dx.sum(axis=0))
    first = int(place[0]) - REACH
    span = int(place[-1]) + REACH + 1 - first
    ids = padded[first : first + span].astype(np.int16)
    # the places that share a table add up to windows, which differences of running sums give for all places at once
    running = np.zeros((span + 2 * REACH + 1, HIDDEN), dtype=np.float32)
    running[at - first + REACH + 1] = dx
    np.cumsum(running, axis=0, out=running)
    for table in range(max(TABLE) + 1):
        own = [o for k, o in enumerate(OFFSETS) if TABLE[k] == table]
        if len(own) == 1:
            _scatter(m["emb"][table], g2["emb"][table], ids[at + own[0] - first], dx)
            continue
        total = np.zeros((span, HIDDEN), dtype=np.float32)
        for lo, hi in _runs(own):  # a token at q is in the context, at offset o, of the place q - o
            total += running[REACH + 1 - lo : REACH + 1 - lo + span] - running[REACH - hi : REACH - hi + span]
        _scatter(m["emb"][table], g2["emb"][table], ids, total)


def _runs(offsets: list[int]) -> list[tuple[int, int]]:
    """(first, last) of the runs of neighbouring offsets."""
    out: list[tuple[int, int]] = []
    for o in sorted(offsets):
        if out and out[-1][1] == o - 1:
            out[-1] = (out[-1][0], o)
        else:
            out.append((o, o))
    return out


def _batch(seen: int) -> int:
    return min(MOST, max(LEAST, seen // 16))


class Trainer:
    """A shard's walk from the round's model on."""

    def __init__(self, flat: np.ndarray, turn: int) -> None:
        self.model, self.turn, self.seen = flat.copy(), turn, 0
        self.m, self.g2 = views(self.model), {k: np.full(s, 1e-4, dtype=np.float32) for k, s in _SHAPES.items()}

    def feed(self, texts: list[np.ndarray]) -> None:
        padded, place, sizes = laid_out(texts)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        turns = mix(padded[place].astype(U64) * U64(0x9E3779B97F4A7C15) + within.astype(U64) * U64(7919)) % U64(ROUNDS)
        masked, lo = place[turns == U64(self.turn % ROUNDS)], 0
        while lo < len(masked):
            size = _batch(self.seen)
            part = masked[lo : lo + size if len(masked) - lo >= 1.5 * size else len(masked)]  # what is left over joins the last batch
            step(self.m, self.g2, padded, part)
            self.seen += len(part)
            lo += len(part)


def _train(flat: np.ndarray, turn: int):
    """Rows of (shard, ids) that lie shard by shard -> the weighted sum of their models, in slices."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, now, held = np.zeros(SIZE), 0, None, []
        trainer = Trainer(flat, turn)

        def close() -> None:
            nonlocal seen, trainer
            trainer.feed(held)
            total[:] += trainer.model * float(trainer.seen)
            seen += trainer.seen
            trainer = Trainer(flat, turn)
            held.clear()

        waiting = 0
        for b in batches(it, 256):
            for shard, ids in zip(b.column(0).to_pylist(), _stored(b.column(1)), strict=True):
                if now is not None and shard != now:
                    close()
                    waiting = 0
                now = shard
                held.append(ids)
                waiting += len(ids)
                if waiting >= 65_536:
                    trainer.feed(held)
                    held.clear()
                    waiting = 0
        if now is not None:
            close()
        if seen:
            slices = [(total[lo : lo + SLICE] / seen).astype(np.float32).tobytes() for lo in range(0, SIZE, SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slices), dtype=np.int32)), pa.array([now % SUMS] * len(slices), pa.int32()), pa.array(slices, pa.binary()), pa.array([seen] * len(slices), pa.int64())], names=["slice", "part", "mean", "seen"])

    return run


def _averaged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of the slices that meet here, one for each slice; a slice at a time is added up."""
    sums: dict[int, tuple[np.ndarray, int]] = {}
    for b in it:
        for k, mean, seen in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            x, n = sums.get(k, (0.0, 0))
            sums[k] = (x + np.frombuffer(mean, dtype=np.float32).astype(np.float64) * seen, n + seen)
    if sums:
        keys = sorted(sums)
        means = [(sums[k][0] / sums[k][1]).astype(np.float32).tobytes() for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([0] * len(keys), pa.int32()), pa.array(means, pa.binary()), pa.array([sums[k][1] for k in keys], pa.int64())], names=["slice", "part", "mean", "seen"])


def _tally(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token hashes and their counts; a task's sums go out whenever they hold a million tokens, and the shuffle adds them up."""
    def out(counts: Counter) -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), dtype=U64, count=len(counts))
        return pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])

    counts: Counter = Counter()
    for b in batches(it):
        for t in raw(b.column(0)):
            counts.update(lower_words(t))
        if len(counts) > 1_000_000:
            yield out(counts)
            counts = Counter()
    if counts:
        yield out(counts)


def learn_vocabulary(texts: DataFrame) -> tuple[Vocabulary, np.ndarray, int]:
    """The vocabulary of a frame of one text column, the most frequent tokens' counts, and the number of all tokens."""
    tally = texts.mapInArrow(_tally, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    tally = stash(texts.sparkSession, tally, "tally")
    top = tally.orderBy(F.desc("n"), "token").limit(VOCAB - SHARED).collect()
    total = tally.agg(F.sum("n")).first()[0] or 0
    release(texts.sparkSession, tally)
    return Vocabulary(np.array([r.token for r in top], dtype=np.int64).view(U64)), np.array([r.n for r in top], dtype=float), total


def initial(counts: np.ndarray, total: int) -> np.ndarray:
    """Parameters whose output is the tokens' frequencies; what the shared slots have of the corpus is dealt among them."""
    rng = np.random.default_rng(SEED)
    flat = (rng.standard_normal(SIZE) * 0.05).astype(np.float32)
    m = views(flat)
    freq = np.full(VOCAB, 1.0)
    freq[: len(counts)] = counts
    freq[VOCAB - SHARED :] = max(1.0, (total - counts.sum()) / SHARED)
    grid = freq.reshape(WIDTH, CLUSTERS).T
    m["cw"][-1] = np.log(grid.sum(axis=1) / freq.sum())
    m["tw"][:, -1] = np.log(grid / grid.sum(axis=1, keepdims=True))
    return flat


def fit(stored: DataFrame, counts: np.ndarray, total: int) -> np.ndarray:
    """Parameters from a frame of (shard, ids) that lies shard by shard."""
    flat, kind = initial(counts, total), "slice int, part int, mean binary, seen long"
    for turn in range(ROUNDS):
        found = stored.mapInArrow(_train(flat, turn), kind).repartition("slice", "part").mapInArrow(_averaged, kind).repartition("slice").mapInArrow(_averaged, kind)
        rows = {r.slice: r.mean for r in found.select("slice", "mean").collect()}  # one model
        if not rows:
            break
        flat = np.round(np.concatenate([np.frombuffer(rows[k], dtype=np.float32) for k in sorted(rows)]), 5)
        m = views(flat)
        for part, bound in ((m["emb"], BIAS_BOUND), (m["bias"], BIAS_BOUND), (m["cw"][:-1], BOUND), (m["cw"][-1:], BIAS_BOUND), (m["tw"][:, :-1], BOUND), (m["tw"][:, -1:], BIAS_BOUND)):
            np.clip(part, -bound, bound, out=part)
    return flat


def _score(flat: np.ndarray):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = views(flat)
        for b in batches(it, 256):
            padded, place, sizes = laid_out(_stored(b.column(1)))
            got = log_probs(m, padded, place)
            sums = np.zeros(len(sizes))
            some = sizes > 0
            if some.any():
                sums[some] = np.add.reduceat(got, (np.cumsum(sizes) - sizes)[some])
            mean = [float(s) / int(n) if n else None for s, n in zip(sums, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(np.round(sums, 4)), pa.array(mean, pa.float64())], names=["doc_id", "n_tokens", "log_likelihood", "mean_log_prob"])

    return run


def pseudo_likelihood(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on all documents and score each.

    Returns a row per input row: doc_id, n_tokens, log_likelihood (summed over
    all tokens), mean_log_prob (null without tokens).  Tokens are runs without
    white space, A-Z lower-cased.  A null or empty text has no tokens and a sum
    of 0; repeated rows are scored alike; an empty table gives an empty result.
    The partitions of the input change the sums by rounding only.
    """
    ship(spark)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary, counts, total = learn_vocabulary(docs.select("text"))
    stored = encoded(spark, docs, vocabulary, total)
    flat = fit(stored.select("shard", "ids"), counts, total)
    return stored.select("doc_id", "ids").mapInArrow(_score(flat), "doc_id long, n_tokens long, log_likelihood double, mean_log_prob double")
