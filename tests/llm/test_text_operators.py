"""The text operators on small tables with every odd case, against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoreach.llm import cascade, licenses, maskedlm, mixing, packing, passages, resampling, sitelines, supermin
from isoreach.llm.components import components
from isoreach.llm.textcore import lower_words, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    base = words(1, 300)
    edited = base[:]
    for k in range(20, 300, 60):
        edited[k] = "changed"
    passage = words(2, 70)
    rows = [
        (1, " ".join(base), "en", "src0", 1),
        (2, " ".join(base), "en", "src1", 1),
        (3, " ".join(edited), "en", "src0", 1),
        (4, " ".join(words(3, 120) + passage + words(4, 100)), "en", "src1", 1),
        (5, " ".join(words(5, 90) + passage + words(6, 200)), "en", "src2", 1),
        (6, " ".join(words(7, 400)), "de", "src0", 1),
        (7, None, None, None, None),
        (8, "", "en", "src0", 0),
        (9, " \n\t ", "en", "src0", 4),
        (10, "Two words", "en", "src0", 9),
        (11, "two WORDS", "fr", None, 9),
        (None, "no id here", "en", "src0", 1),
        (12, "x" * 30000 + " " + " ".join(words(8, 20000)), "en", "src3", 1),
        (6, " ".join(words(7, 400)), "de", "src0", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("rep", F.lit(1)).withColumn("label", F.lit("clash")).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(rows):
    sets = {i: set(shingles(lower_words(t.encode() if t else None)).tolist()) for i, t in rows}
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    m = min(comp[a], comp[b])
                    if comp[a] != m or comp[b] != m:
                        comp[a] = comp[b] = m
                        changed = True
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_duplicates_equal_brute_force(spark, docs):
    got = supermin.near_duplicates(spark, docs).collect()
    assert len(got) == 14
    want = brute_components({(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None})
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert want[3][1] == 1 and want[11][1] == 10


def test_near_duplicates_of_a_large_group_of_edits(spark):
    r = random.Random(5)
    base, rows = words(11, 200), []
    for k in range(60):  # light and heavy edits of one text, some of them beyond the threshold
        text = base[:]
        for _ in range(r.randrange(1, 9)):
            text[r.randrange(200)] = f"e{k}_{r.randrange(10**6)}"
        rows.append((k, " ".join(text), "en", "src0", 1))
    got = {x.doc_id: x.component_id for x in supermin.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute_components([(x[0], x[1]) for x in rows])
    assert got == {i: c for i, (_, c) in want.items()}


def test_supermin_estimates_similarity_with_low_variance():
    r = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        both = r.integers(0, 2**63, 150).astype(np.uint64)
        a, b = np.concatenate([both, r.integers(0, 2**63, 50).astype(np.uint64)]), np.concatenate([both, r.integers(0, 2**63, 50).astype(np.uint64)])
        s = supermin.signatures([a, b])
        errors.append((s[0] == s[1]).mean() - 150 / 250)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.09
    one = supermin.signatures([np.array([7], dtype=np.uint64)])[0] >> 32
    assert sorted(one.tolist()) == list(range(72))  # one element reaches every register at a level of its own


def test_near_duplicates_empty(spark, empty):
    assert supermin.near_duplicates(spark, empty).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, 301)) and all(got[k] == 1000 for k in range(1001, 1100))
    assert 0 not in got and 1000 not in got


def brute_windows(values, t, shift=0):
    out = set()

    def part(lo, hi):
        if hi - lo + 1 < t:
            return
        c = min(range(lo, hi + 1), key=lambda k: (values[k], k))
        out.add((lo + shift, c + shift, hi + shift))
        part(lo, c - 1)
        part(c + 1, hi)

    part(0, len(values) - 1)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_compact_windows_are_the_cartesian_tree(seed):
    r = np.random.default_rng(seed)
    n, t = int(r.integers(1, 200)), int(r.integers(1, 20))
    values = r.integers(0, 1 << 62, n).astype(np.uint64)
    left, c, right = passages.compact_windows(values, t)
    assert set(zip(left.tolist(), c.tolist(), right.tolist(), strict=True)) == brute_windows(values.tolist(), t)
    ends, want, begin = np.unique(np.append(r.integers(1, n + 1, 4), n)), set(), 0
    for end in ends.tolist():  # several texts laid end to end
        want |= brute_windows(values[begin:end].tolist(), t, begin)
        begin = end
    left, c, right = passages.compact_windows(values, t, ends)
    assert set(zip(left.tolist(), c.tolist(), right.tolist(), strict=True)) == want


def test_joint_windows_hold_the_minima_of_every_subsequence():
    r, t = np.random.default_rng(4), 10
    values = [r.integers(0, 1 << 62, 150).astype(np.uint64) for _ in range(2)]
    windows = [passages.compact_windows(v, t) for v in values]
    starts, chosen = passages.joint_windows(windows, t)
    for i in range(150 - t + 1):
        k = int(np.searchsorted(starts, i, side="right")) - 1
        for v, (_, c, _), pick in zip(values, windows, chosen, strict=True):
            assert c[pick[k]] == i + int(np.argmin(v[i : i + t]))


def test_repeated_passages_are_found_and_others_left_alone(spark, docs):
    got = {r.doc_id: r for r in passages.repeated_passages(spark, docs).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[4].component_id == got[5].component_id == 4
    (a,), (b,) = got[4].spans, got[5].spans
    assert abs(a.start - 120) <= 4 and abs(a.stop - 190) <= 4 and abs(b.start - 90) <= 4 and abs(b.stop - 160) <= 4
    assert got[2].component_id == 1 and got[1].spans[0].stop == 300


def test_repeated_passages_empty(spark, empty):
    assert passages.repeated_passages(spark, empty).collect() == []


def brute_rules(text):
    t = text or ""
    w = [x for x in __import__("re").split("[ \t-\r]+", t) if x]
    grams = {}
    for k in range(len(w) - 2):
        grams.setdefault(tuple(w[k : k + 3]), []).append(k)
    hit = {k + j for v in grams.values() if len(v) > 1 for k in v for j in range(3)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_cascade_counts_equal_brute_force(spark, docs):
    extra = spark.createDataFrame([(20, "a b c a b c a b", "en", "s", 1), (21, "é ü\n\né ü\nx*#", "en", "s", 1), (22, "wow!! " * 80, "en", "s", 1)], SCHEMA)
    both = docs.select("doc_id", "text").unionByName(extra.select("doc_id", "text"))
    got = cascade.judge(spark, both).collect()
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_rules(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and (r.kept or r.rejected_by)
    kept = {r.doc_id for r in got if r.kept}
    assert {1, 2, 3, 4, 5, 6} <= kept and not {7, 8, 9, 10, 22} & kept
    assert cascade.judge(spark, both.limit(0)).collect() == []


def test_the_order_of_rules_doesnt_change_the_verdict():
    texts = [b"word " * 100, b"a " * 10, b"!! x " * 60, " ".join(words(9, 100)).encode(), None]
    for order in (cascade.RULES, cascade.RULES[::-1]):
        assert [cascade.cascade(cascade.Text(t), list(order)) is None for t in texts] == [False, False, False, True, False]
    assert cascade.ordered([("slow", 1.0, 0.5), ("fast", 0.1, 0.1), ("best", 0.1, 0.5)]) == ["best", "fast", "slow"]


def test_license_scan(spark):
    rows = [
        (1, "Released under the MIT\nlicense. Apache License, Version 2.0 and CC-BY-NC, cc by nc"),
        (2, "Licensed under the GNU General Public License version 3.0 or later"),
        (3, "SPDX-License-Identifier: BSD 3-Clause"),
        (4, "nichts mit Lizenz, mit allem"),
        (5, None),
        (6, ""),
        (7, "creative commons attribution 4.0 international license"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (4, 1, 14, "apache-2,cc-by-nc,mit")
    assert got[2].labels == "gpl-3-or-later" and got[2].score == 0.88
    assert got[3].labels == "bsd-3-clause"
    assert got[7].labels == "cc-by"
    for k in (4, 5, 6):
        assert got[k].labels == "" and got[k].n_base == 0 and got[k].first_word is None and got[k].score == 0.0
    assert got[5].n_words == 0 and got[4].n_words == 5
    assert len(licenses.rules()) > 200


def test_license_lists_of_any_length_take_linear_time(spark):
    import time

    def scanned(n):
        row = spark.createDataFrame([(1, "licensed under the mit license and text " * n)], "doc_id long, text string")
        began = time.time()
        (r,) = licenses.scan(row).collect()
        return r, time.time() - began

    r, _ = scanned(20)
    assert [(d.start, d.words, d.label) for d in r.detections] == [(7 * k, 5, "mit") for k in range(20)]
    r, short = scanned(2_000)
    r, long = scanned(20_000)
    assert len(r.detections) == 20_000 and r.n_base == 20_000 and r.last_word == 7 * 19_999 + 1 and long < 10 * max(short, 2)


def brute_detections(text):
    import re

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({k: k + 32 for k in range(65, 91)}))
    t, found = " " + "  ".join(words) + " ", []
    for k, r in enumerate(licenses.rules()):
        for m in re.finditer(licenses._spaced(r.regex), t):
            found.append((t[: m.start()].count(" ") // 2, m.group().count(" ") // 2, r.priority, k, r.label))
    covers = lambda y, x: y[0] <= x[0] and y[0] + y[1] >= x[0] + x[1] and (y[2] > x[2] or (y[2] == x[2] and (y[1] > x[1] or (y[1] == x[1] and y[3] < x[3]))))
    return sorted((x[0], x[1], x[2], x[4]) for x in found if not any(covers(y, x) for y in found))


def test_license_detections_equal_brute_force(spark):
    r = random.Random(6)
    pieces = ["MIT license", "GNU General Public License v3.0 or later", "Apache License, Version 2.0", "under the terms of the", "BSD 3-Clause", "all rights reserved", "CC BY-NC-SA 4.0", "cc by nc", "lorem ipsum", "Mozilla Public License 2.0", "public domain", "is free and unencumbered software released into the public domain", "This", "commercial use is prohibited", "license"]
    rows = [(k, " ".join(r.choice(pieces) for _ in range(r.randrange(0, 25)))) for k in range(60)] + [(60, rows_text := "MIT license"), (60, rows_text)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == 62
    texts = dict(rows)
    for x in got:
        assert [tuple(d) for d in x.detections] == brute_detections(texts[x.doc_id])


def expanded(regex):
    """All strings of an expression of literals, groups of alternatives and question marks."""

    def alternatives(k):
        done, now = [], [""]
        while k < len(regex) and regex[k] != ")":
            if regex.startswith("(?:", k):
                inner, k = alternatives(k + 3)
                k += 1
            elif regex[k] == "|":
                done, now, k = done + now, [""], k + 1
                continue
            else:
                inner, k = [regex[k]], k + 1
            if k < len(regex) and regex[k] == "?":
                inner, k = [*inner, ""], k + 1
            now = [x + y for x in now for y in inner]
        return done + now, k

    return alternatives(0)[0]


def test_every_match_of_a_license_rule_holds_its_keyword():
    for r in licenses.rules():
        texts = expanded(r.regex)
        assert all(r.keyword in t.split() for t in texts), r
        assert max(len(t.split()) for t in texts) <= licenses.longest()


def test_resampling_keeps_good_and_drops_junk(spark):
    good = [(k, " ".join(words(k, 60, 300)) + ".", "en", "s", 1) for k in range(120)]
    junk = [(k, " ".join(w + "!!" for w in words(k, 60, 300)), "en", "s", 1) for k in range(120, 150)]
    odd = [(200, None, "en", "s", 0), (201, "", "en", "s", 0), (None, "w1 w2", "en", "s", 0)]
    table = spark.createDataFrame(good + junk + odd, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(k, 1 if k < 120 else 0, 0) for k in range(0, 150, 3)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in resampling.resample(spark, table, labels).collect()}
    assert len(got) == 153
    assert all(got[k].kept for k in range(120)) and not any(got[k].kept for k in range(120, 150))
    kept = {r.doc_id for r in resampling.keep_good(spark, table, labels).collect()}
    assert kept == {k for k, r in got.items() if r.kept}
    assert resampling.resample(spark, table.limit(0), labels).collect() == []


def plain_ngrams(text):
    from isoreach.llm.textcore import mix, word_hashes

    tokens = resampling._TOKEN.findall(text.encode().lower())
    h = word_hashes(tokens).tolist()
    marked = [int(resampling._AGAIN) if k and h[k] == h[k - 1] else h[k] for k in range(len(h))]
    one = [int(mix(np.array([x], dtype=np.uint64))[0]) % resampling.BUCKETS for x in marked]
    two = [int(mix(np.array([(a * 0x9E3779B97F4A7C15 + b) % 2**64], dtype=np.uint64))[0]) % resampling.BUCKETS for a, b in zip(marked, marked[1:], strict=False)]
    return one + two


def plain_resampling(spark, texts, labels):
    """(log weight of each document, the ids that are kept), by loops over the documents."""
    ids = spark.createDataFrame([(k,) for k in labels], "doc_id long")
    halves = {r.doc_id: r.h for r in ids.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(resampling.SEED)), F.lit(2)).alias("h")).collect()}
    grams = {k: plain_ngrams(t) if t else [] for k, t in texts.items()}
    raw, good = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    for k, g in grams.items():
        for b in g:
            raw[b] += 1
            good[b] += labels.get(k) == 1 and halves[k] == 0
    p = (raw + 1) / (raw.sum() + resampling.BUCKETS)
    q = (good + resampling.BUCKETS * p) / (good.sum() + resampling.BUCKETS)
    weight = {k: sum(np.log(q[b] / p[b]) for b in g) if g else resampling.NOTHING for k, g in grams.items()}
    noise = dict(zip(texts, resampling.gumbel(list(texts), resampling.SEED), strict=True))
    cut = resampling.best_cut(np.array([weight[k] for k, v in labels.items() if k in weight and v == 1 and halves[k] == 1]), np.array([weight[k] for k, v in labels.items() if k in weight and v == 0]))
    n = sum(w > cut for w in weight.values())
    return weight, set(sorted(texts, key=lambda k: -(weight[k] + noise[k]))[:n])


def test_resampling_equals_brute_force(spark):
    texts = {k: " ".join(words(k, 30 + k, 200) + (["ha"] * 9 if k % 3 else [])) for k in range(60)} | {60: "", 61: None, 62: "again and again"}
    labels = {k: int(k % 3 == 0) for k in range(0, 60, 2)}
    table = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in resampling.resample(spark, table, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()}
    weight, kept = plain_resampling(spark, texts, labels)
    assert {k: r.log_weight for k, r in got.items()} == {k: pytest.approx(w, abs=1e-5) for k, w in weight.items()}
    assert 0 < len(kept) < len(texts) and {k for k, r in got.items() if r.kept} == kept


def test_resampling_of_ties_and_repeated_rows(spark):
    rows = [(1, "good words here")] * 4 + [(2, "bad !! bad !!")] * 3 + [(3, "good words here")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = resampling.resample(spark, table, spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")).collect()
    assert len(got) == 8 and len({(r.doc_id, r.log_weight, r.sample_key, r.kept) for r in got}) == 3


def test_kth_largest(spark):
    values = [0.5, 2.0, 2.0, -1.0, 7.25, 3.0]
    keys = spark.createDataFrame([(v,) for v in values], "k double")
    assert [resampling.kth_largest(keys, "k", n) for n in range(1, 7)] == sorted(values, reverse=True)
    assert resampling.kth_largest(spark.createDataFrame([(1.0,)] * 9, "k double"), "k", 5) == 1.0


def pairs_of_words(r, n):  # every second word is fixed by its neighbours
    out = []
    for _ in range(n):
        w = r.randrange(12)
        out += [f"a{w}", f"b{w}"]
    return " ".join(out)


def plain_score(flat, vocabulary, text):
    """The log-probability of each token, by loops."""
    m = {k: v.astype(np.float64) for k, v in maskedlm.views(flat).items()}
    (ids,) = maskedlm.encode([text.encode()], vocabulary)
    total = 0.0
    for at, token in enumerate(ids.tolist()):
        x = m["bias"].copy()
        for o, table in zip(maskedlm.OFFSETS, maskedlm.TABLE, strict=True):
            beside = ids[at + o] if 0 <= at + o < len(ids) else maskedlm.VOCAB
            x += m["emb"][table][beside]
        h = np.append(np.tanh(x), 1.0)
        z, y = h @ m["cw"], h @ m["tw"][token % maskedlm.CLUSTERS]
        total += z[token % maskedlm.CLUSTERS] - np.log(np.exp(z).sum()) + y[token // maskedlm.CLUSTERS] - np.log(np.exp(y).sum())
    return total


def test_masked_lm_at_its_settings_equals_brute_force_and_beats_frequencies(spark):
    r = random.Random(4)
    table = spark.createDataFrame([(k, pairs_of_words(r, 120), "en", "s", 1) for k in range(400)] + [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "a1 b1", "en", "s", 0), (902, "a1 b1", "en", "s", 0)], SCHEMA)
    docs = table.select("doc_id", "text")
    vocabulary, counts, total = maskedlm.learn_vocabulary(docs.where("doc_id < 300").select("text"))
    assert total == 300 * 240 and len(counts) == 24
    flat = maskedlm.fit(maskedlm.encoded(spark, docs.where("doc_id < 300"), vocabulary, total).select("shard", "ids"), counts, total)
    held = [x.text for x in docs.where("doc_id between 300 and 399").collect()]
    got = [plain_score(flat, vocabulary, t) for t in held[:5]]
    padded, place, sizes = maskedlm.laid_out(maskedlm.encode([t.encode() for t in held], vocabulary))
    fast = maskedlm.log_probs(maskedlm.views(flat), padded, place)
    assert [fast[240 * k : 240 * (k + 1)].sum() for k in range(5)] == [pytest.approx(x, abs=1e-2) for x in got]
    assert fast.mean() > -np.log(24) + 0.5  # the words are equally frequent
    out = [x for x in maskedlm.pseudo_likelihood(spark, table).collect()]
    by = {x.doc_id: x for x in out}
    assert len(out) == 404 and by[900].n_tokens == 0 and by[901].log_likelihood == 0.0 and by[901].mean_log_prob is None and by[5].n_tokens == 240
    assert len({x.log_likelihood for x in out if x.doc_id == 902}) == 1
    assert maskedlm.pseudo_likelihood(spark, table.limit(0)).collect() == []


def test_masked_lm_doesnt_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(maskedlm, "SHARD", 5_000)  # several shards of a small table
    r = random.Random(9)
    table = spark.createDataFrame([(k, pairs_of_words(r, 40), "en", "s", 1) for k in range(200)], SCHEMA)
    a, b = ({x.doc_id: x.log_likelihood for x in maskedlm.pseudo_likelihood(spark, table.repartition(n)).collect()} for n in (1, 7))
    assert a == {k: pytest.approx(v, abs=0.05) for k, v in b.items()}


def test_masked_lm_steps_follow_the_slope():
    """A step's change of the embeddings has the sign of the slope of the mean log-probability, by differences."""
    r = np.random.default_rng(2)
    padded, place, _ = maskedlm.laid_out([r.integers(0, 40, 30).astype(np.int16) for _ in range(3)])
    flat = maskedlm.initial(np.ones(40), 40)
    m, g2 = maskedlm.views(flat), {k: np.full(s, 1e-4, dtype=np.float32) for k, s in maskedlm._SHAPES.items()}
    before = flat.copy()
    part = place[5:60]
    maskedlm.step(m, g2, padded, part)
    checked = 0
    for table in range(max(maskedlm.TABLE) + 1):
        for token in range(0, 40, 3):
            moved = (maskedlm.views(flat)["emb"] - maskedlm.views(before)["emb"])[table, token, 0]
            up, down = before.copy(), before.copy()
            maskedlm.views(up)["emb"][table, token, 0] += 0.05
            maskedlm.views(down)["emb"][table, token, 0] -= 0.05
            slope = (maskedlm.log_probs(maskedlm.views(up), padded, part).mean() - maskedlm.log_probs(maskedlm.views(down), padded, part).mean()) / 0.1
            if abs(slope) > 2e-5:
                assert np.sign(moved) == np.sign(slope)
                checked += 1
    assert checked > 20


def test_masked_lm_trains_every_position_once():
    ids = [np.arange(k, k + 50, dtype=np.int16) for k in range(40)]
    seen = []
    for turn in range(maskedlm.ROUNDS):
        t = maskedlm.Trainer(maskedlm.initial(np.ones(100), 100), turn)
        t.feed(ids[:20])
        t.feed(ids[20:])
        seen.append(t.seen)
    assert sum(seen) == 40 * 50 and min(seen) > 0


def test_masked_lm_steps_work_on_small_arrays():
    """A step on a full minibatch holds a part of its rows at a time, besides arrays as large as the parameters."""
    import tracemalloc

    r = np.random.default_rng(5)
    padded, place, _ = maskedlm.laid_out([r.integers(0, maskedlm.VOCAB, maskedlm.MOST).astype(np.int16)])
    trainer = maskedlm.Trainer(maskedlm.initial(np.ones(40), 40), 0)
    maskedlm.step(trainer.m, trainer.g2, padded, place)
    tracemalloc.start()
    maskedlm.step(trainer.m, trainer.g2, padded, place)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * maskedlm.MOST * maskedlm.WIDTH * 4  # 3.5 MB, and 6.5 with all rows at once


def test_masked_lm_probabilities_add_up_to_one():
    flat = np.random.default_rng(1).standard_normal(maskedlm.SIZE).astype(np.float32) * 0.3
    m = maskedlm.views(flat)
    r = maskedlm.REACH
    total = 0.0
    for token in range(0, maskedlm.VOCAB):
        padded = np.full(2 * r + 3, maskedlm.VOCAB)
        padded[r : r + 3] = 3, token, 9
        total += float(np.exp(maskedlm.log_probs(m, padded, np.array([r + 1]))[0]))
    assert abs(total - 1) < 1e-3


def test_line_dedup(spark):
    rows = [(k, f"own {k}\nmenu home about\nmore {k}", "en", "siteA", 1) for k in range(10)]
    rows += [(20 + k, f"text {k}\nmenu home about", "en", "siteB", 1) for k in range(2)]
    rows += [(30, None, "en", "siteA", 0), (31, "menu home about", "en", "siteA", 0), (32, "", "en", None, 0), (33, "a\n\n \na", "en", None, 0)]
    got = {r.doc_id: r for r in sitelines.drop_boilerplate(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3].text == "own 3\nmore 3" and (got[3].n_lines, got[3].n_dropped) == (3, 1)
    assert got[20].text == "text 0\nmenu home about"  # too few pages of its host have it
    assert got[30].text is None and got[30].n_lines == 0 and got[31].text == "" and got[32].text == "" and got[33].text == "a\n\n \na"
    assert sitelines.drop_boilerplate(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_packing_is_an_exact_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    more = spark.createDataFrame([(50, "It's 3 don'ts <|endoftext|> ΑΣ naïve\x85x", "en", "s", 1)], SCHEMA)
    table = docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    pieces = packing.pack(spark, table, with_ids=True).collect()
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    by_sequence = {}
    for p in pieces:
        ids = np.array(tokenizer.encode(texts[p.doc_id], add_special_tokens=False).ids + [1], dtype="<u4")
        part = ids[p.start : p.start + p.length]
        assert p.doc_tokens == len(ids) and p.ids == part.tolist() and p.ids_crc32 == zlib.crc32(part.tobytes())
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(p.length for p in pieces if p.doc_id == 12) == next(p.doc_tokens for p in pieces if p.doc_id == 12)
    whole = packing.sequences(packing.pack(spark, table, with_ids=True)).collect()
    assert all(len(s.ids) == 2048 or len(s.ids) & (len(s.ids) - 1) == 0 for s in whole)
    assert packing.pack(spark, table.limit(0)).collect() == []


def test_best_fit_takes_the_tightest_window():
    r = random.Random(2)
    lengths = sorted((r.randrange(1, 100) for _ in range(400)), reverse=True)
    at, offsets = packing.best_fit(lengths, 100)
    left, want = [], []
    for n in lengths:
        fits = [(room, k) for k, room in enumerate(left) if room >= n]
        if fits:
            room = min(f[0] for f in fits)
            want.append(room - n)
            k = next(k for k, x in enumerate(left) if x == room)
            left[k] -= n
        else:
            left.append(100 - n)
            want.append(100 - n)
    assert [100 - o - n for o, n in zip(offsets, lengths, strict=True)] == want and max(at) + 1 == len(left)


def test_mixing_budgets_and_prefixes(spark, docs):
    leaves = [("d1", "en", "a", 100), ("d1", "en", "b", 900), ("d1", "de", "a", 50), ("d2", "en", "a", 1000)]
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, supply long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(spark, table, {"d1": 50, "d2": 50}, 50, 1).collect()}
    # half of 2050 tokens: 512 each; German has 50 only, its English siblings take over before d2 does
    assert got == {("d1", "de", "a"): 50, ("d1", "en", "a"): 100, ("d1", "en", "b"): 362, ("d2", "en", "a"): 512}
    rich = [(k, " ".join(["t"] * 10), "en", "src1", 1) for k in range(200)]
    mixed = mixing.mix(spark, spark.createDataFrame(rich, SCHEMA), percent=45).collect()
    assert len(mixed) == 90 and {r.mix_epoch for r in mixed} == {0}
    twice = mixing.mix(spark, spark.createDataFrame(rich, SCHEMA), percent=150).collect()
    assert len(twice) == 300 and len({(r.doc_id, r.mix_epoch) for r in twice}) == 300
    assert mixing.mix(spark, docs).count() > 0
    assert mixing.mix(spark, docs.limit(0)).collect() == []


def test_columns_of_the_operators_own_names_do_no_harm(spark, docs):
    clash = docs
    for c in ("n_lines", "n_dropped", "drop", "host", "line", "full", "cut", "rest", "bd", "mix_epoch", "mix_tokens", "kept", "component_id", "key", "a", "b", "doc", "t", "w", "uid", "length"):
        clash = clash.withColumn(c, F.lit("x"))
    ids = sorted(r.doc_id for r in supermin.near_duplicates(spark, docs).collect() if r.kept and r.doc_id is not None)
    assert sorted(r.doc_id for r in supermin.near_duplicates(spark, clash).collect() if r.kept and r.doc_id is not None) == ids
    assert {r.n_dropped for r in sitelines.drop_boilerplate(spark, clash).collect()} == {0}
    assert all(isinstance(r.mix_epoch, int) and r.cut == "x" for r in mixing.mix(spark, clash).collect())
    assert passages.repeated_passages(spark, clash).count() == 5
    assert licenses.scan(clash).count() == cascade.judge(spark, clash).count() == maskedlm.pseudo_likelihood(spark, clash).count() == 14
    assert packing.pack(spark, clash).count() >= 14
    labels = spark.createDataFrame([(1, 1), (10, 0)], "doc_id long, quality int")
    assert resampling.resample(spark, clash, labels).count() == 14 and resampling.keep_good(spark, clash, labels).columns == clash.columns
