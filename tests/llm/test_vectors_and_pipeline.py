"""Embedding near-dedup against brute force, and the pipeline against plain stages."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isoreach.llm import itq, mixing, packing, queries
from tests.llm.test_text_operators import brute_components, plain_resampling

SF = "/root/testdata/sf0.001"


def brute(rows):
    ok = {}
    for i, v, label in rows:
        if i is None or v is None or label is None:
            continue
        x = np.array([np.nan if e is None else e for e in v], dtype=float)
        if np.isfinite(x).all() and x.any():
            ok[i] = (x, label)
    links = {i: {j for j in ok if j != i and ok[i][1] == ok[j][1] and len(ok[i][0]) == len(ok[j][0]) and ok[i][0] @ ok[j][0] / (np.linalg.norm(ok[i][0]) * np.linalg.norm(ok[j][0])) >= 0.93} for i in ok}
    comp = {r[0]: r[0] for r in rows}
    for _ in range(len(ok)):
        old = dict(comp)
        for i, near in links.items():
            comp[i] = min([comp[i], *(comp[j] for j in near)])
        if comp == old:
            break
    return {r[0]: (len(links.get(r[0], ())), comp[r[0]]) for r in rows}


def test_similar_vectors_reach_the_recall(spark):
    r = np.random.default_rng(8)
    rows, k = [], 0
    for label in range(3):
        for _ in range(60):
            centre = r.standard_normal(64)
            for _ in range(int(r.integers(1, 5))):
                noise = r.standard_normal(64) * r.choice([0.05, 0.15, 0.25])
                rows.append((k, [float(x) for x in centre + noise], label))
                k += 1
    rows += [(k, rows[0][1], 0), (k + 1, [2 * x for x in rows[0][1]], 0), (k + 2, rows[0][1], 1), (k + 3, None, 0), (k + 4, [0.0] * 64, 0), (k + 5, [float("nan")] * 64, 0), (k + 6, rows[1][1], None), (k + 7, [None] * 64, 0), (k + 8, [1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: x for x in itq.similar_vectors(spark, table).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    assert all(got[i].n_links <= want[i][0] for i in got)
    assert sum(x.n_links for x in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    for i in range(k + 2, k + 9):
        assert (got[i].n_links, got[i].component_id) == want[i]
    assert got[k].component_id == got[k + 1].component_id == got[0].component_id
    assert itq.similar_vectors(spark, table.limit(0)).collect() == []


def planted(r, n, cosine, dim=64):
    """n pairs of vectors at just that cosine."""
    x = r.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = r.standard_normal((n, dim))
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * u


def test_recall_at_the_threshold_and_near_linear_buckets(spark):
    r = np.random.default_rng(3)
    x, y = planted(r, 1500, 0.9301)
    rows = [(k, v.tolist(), "one") for k, v in enumerate(np.concatenate([x, y]))]
    got = itq.similar_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert sum(g.n_links for g in got) >= 0.9 * len(rows)
    assert all(g.component_id == min(g.vec_id, (g.vec_id + 1500) % 3000) for g in got if g.n_links)


def test_labels_of_any_type_and_lengths_are_kept_apart(spark):
    v, short = [1.0] * 64, [1.0] * 32
    near = [1.0] * 63 + [1.1]
    rows = [(1, v, 7), (2, near, 7 + 2**46), (3, near, 7), (4, short, 7), (5, short, 7), (6, [0.9] * 31 + [1.0], 7), (7, v, None), (8, v, 8), (9, [1e150] * 64, 8), (10, [], 7)]
    want = brute(rows)
    got = {x.vec_id: (x.n_links, x.component_id) for x in itq.similar_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).collect()}
    assert got == want and got[4] == (2, 4) and got[2] == (0, 2)
    words = spark.createDataFrame([(i, e, None if k is None else f"label {k}") for i, e, k in rows], "vec_id long, embedding array<double>, label string")
    assert {x.vec_id: (x.n_links, x.component_id) for x in itq.similar_vectors(spark, words).collect()} == want


def test_repeated_ids_and_clashing_names(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (2, [1.0, 0.01], "a"), (2, [1.0, 0.01], "a"), (None, [1.0, 0.0], "a")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for c in ("uid", "grp", "vector", "bucket", "n_links", "wide", "node", "copies"):
        table = table.withColumn(c, F.lit("x"))
    got = sorted((x.vec_id or 0, x.n_links, x.component_id or 0) for x in itq.similar_vectors(spark, table).collect())
    assert got == [(0, 0, 0), (1, 0, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1)]


def test_blocks_beyond_the_size_give_the_same_links(spark, monkeypatch):
    r = np.random.default_rng(1)
    centre = r.standard_normal(64)
    rows = [(k, [float(x) for x in centre + r.standard_normal(64) * 0.1], 1) for k in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = sorted(itq.similar_vectors(spark, table).collect())
    monkeypatch.setattr(itq, "BLOCK", 9)
    assert sorted(itq.similar_vectors(spark, table).collect()) == whole


def test_rotation_balances_the_bits():
    x = np.random.default_rng(2).standard_normal((3000, 16)) @ np.diag(np.linspace(1, 4, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, p = itq.learn(x, bits=16)
    signs = (x - mean) @ p >= 0
    assert np.abs(signs.mean(axis=0) - 0.5).max() < 0.1


def test_pipeline_equals_its_stages_in_plain_python(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    good = stage[names[0]](spark, docs, SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert {r.doc_id for r in good.collect()} == plain_resampling(spark, texts, labels)[1]
    clean = stage[names[1]](spark, good, SF)
    assert clean.columns == docs.columns and clean.count() == good.count()
    pages = {}
    for r in good.collect():
        pages.setdefault(r.source, []).append(r)
    want = {}
    for host in pages.values():
        seen = {}
        for r in host:
            for line in {x for x in r.text.split("\n") if x.strip()}:
                seen[line] = seen.get(line, 0) + 1
        gone = {line for line, n in seen.items() if n >= 5 and n > 0.1 * len(host)}
        for r in host:
            want[r.doc_id] = "\n".join(x for x in r.text.split("\n") if x not in gone)
    assert {r.doc_id: r.text for r in clean.collect()} == want
    single = stage[names[2]](spark, clean, SF)
    comp = brute_components(list(want.items()))
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in comp.items() if c == i}
    mixed = stage[names[3]](spark, single, SF)
    assert mixed.columns == docs.columns
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in single.collect()]))
    drawn = sorted(r[0] for r in con.sql(f"select doc_id from ({mixing.sql()})").fetchall())
    assert drawn and sorted(r.doc_id for r in mixed.collect()) == drawn
    pieces = stage[names[4]](spark, mixed, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole, at = {}, {}
    for p in pieces:
        whole.setdefault(p.doc_id, Counter())[p.start, p.length, p.ids_crc32] += 1
        at.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, own in whole.items():
        ids = np.array(tokenizer.encode(want[i] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        times = drawn.count(i)
        assert all(n % times == 0 or times > 1 for n in own.values()) and sum(n * length for (_, length, _), n in own.items()) == times * len(ids)
        assert all(crc == zlib.crc32(ids[start : start + length].tobytes()) for start, length, crc in own)
    assert set(whole) == set(drawn) and all(sum(n for _, n in own) <= packing.WINDOW for own in at.values())
    for own in at.values():  # gapless from 0
        assert sorted(own) == [(sum(n for _, n in sorted(own)[:k]), n) for k, (_, n) in enumerate(sorted(own))]
    run = corpus_pipeline.run(spark, SF).collect()
    assert sorted((p.doc_id, p.start, p.ids_crc32) for p in run) == sorted((p.doc_id, p.start, p.ids_crc32) for p in pieces)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_runs(spark, name):
    df = queries.queries()[name](spark, SF)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    df.limit(3).collect()


def test_window_size_is_the_contracts():
    assert packing.WINDOW == 2048
