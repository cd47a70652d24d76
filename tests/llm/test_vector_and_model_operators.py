"""Embedding near-duplicates, toxicity, decontamination, document near-duplicates, quality, pipeline."""

import zlib
from collections import Counter
from itertools import product
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldloom.llm import decontamination, embeddings, neardup, quality, toxicity
from fieldloom.llm.common import Stage, components, words_of
from fieldloom.llm.queries import tokenizer_path


@pytest.fixture
def stage(spark):
    made = Stage(spark, "test")
    yield made
    made.drop()


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row long, digest string"


def doc(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None, 0.5, 3, "d")


def prose(rng, n, words=400):
    return " ".join(f"w{int(k)}" for k in rng.zipf(1.3, n) % words)


# -- components


def test_components_of_long_chains(spark, stage):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(2000, 2001), (2001, 2000), (5, 5)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), stage).collect()}
    assert found == {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1200)} | {2000: 2000, 2001: 2000}


# -- embeddings


def brute(values, threshold=0.93):
    links, parent = {}, {k: k for k in range(len(values))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def sound(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for a, b in product(range(len(values)), repeat=2):
        (_, v, la), (_, w, lb) = values[a][:3], values[b][:3]
        if a != b and la == lb and sound(v, la) and sound(w, lb) and len(v) == len(w):
            x, y = np.array(v, float), np.array(w, float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] = links.get(a, 0) + 1
                parent[find(a)] = find(b)
    groups = {}
    for k in range(len(values)):
        groups.setdefault(find(k), []).append(values[k][0])
    return Counter((values[k][0], links.get(k, 0), min(groups[find(k)])) for k in range(len(values)))


def test_embeddings_against_brute_force(spark, stage):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 64))
    values = []
    for k in range(400):
        v = centres[k % 12] + rng.standard_normal(64) * (0.15 if k % 3 else 0.3)
        values.append((k, v.astype(np.float32).tolist(), k % 12 // 6))
    values += [(1000 + k, values[0][1], 0) for k in range(5)] + [(1010, [2 * x for x in values[0][1]], 0)]
    values += [(2000, None, 0), (2001, [0.0] * 64, 0), (2002, [float("nan")] * 64, 0), (2003, values[0][1], None), (2004, [], 1),
               (2005, [1.0, 2.0], 0), (2006, [1.0, 2.0], 0), (2007, [1.0, None], 0), (2008, [float("inf"), 1.0], 0),
               (2009, [3.0], 0), (2010, [1.0], 0), (2011, [-1.0], 0), (7, values[7][1], 7 % 12 // 6)]
    df = spark.createDataFrame([(*v, 9, 9) for v in values], "vec_id long, embedding array<float>, label int, class long, filters int")
    got = embeddings.near_duplicates(df, stage, block=40)
    rows = got.collect()
    expected = brute(values)
    # pairs may be missed, none may be added; odd vectors and equal ones are exact
    assert Counter((r["vec_id"], r["component_id"]) for r in rows) == Counter((v, c) for v, _, c in expected.elements())
    most = {v: n for v, n, _ in expected if v != 7}
    assert all(r["n_links"] <= most[r["vec_id"]] for r in rows if r["vec_id"] != 7)
    assert all(r["n_links"] == most[r["vec_id"]] for r in rows if r["vec_id"] >= 2000)
    assert sum(r["n_links"] for r in rows) >= 0.99 * sum(n for _, n, _ in expected.elements())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    assert embeddings.near_duplicates(df.limit(0), Stage(spark, "none")).count() == 0


def test_filter_recall_near_the_threshold():
    rng = np.random.default_rng(5)
    found = 0
    for _ in range(300):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        u = rng.standard_normal(64)
        u -= (u @ v) * v
        w = 0.93 * v + np.sqrt(1 - 0.93**2) * u / np.linalg.norm(u)
        found += bool(set(embeddings.filters_of(v, 768, 48)) & set(embeddings.filters_of(w, 768, 48)))
    assert found >= 285


# -- toxicity


def toxic_texts(rng, n):
    bad = ["idiot", "scum", "moron", "zuvery", "zuvenik"]
    out = []
    for k in range(n):
        words = prose(rng, 40).split()
        if k % 3 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, 40)), bad[int(rng.integers(0, 5))])
        out.append((" ".join(words), int(k % 3 == 0)))
    return out


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(6)
    lengths = np.array([3, 1, 5, 2])
    scores, moves = rng.standard_normal(11) * 2, rng.standard_normal((2, 2))
    got, log_z, pairs = toxicity.forward_backward(scores, lengths, moves)
    at, total, expected_pairs = 0, 0.0, np.zeros((2, 2))
    for n in lengths:
        weight, marginal, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in product((0, 1), repeat=int(n)):
            w = np.exp(sum(s for s, k in zip(scores[at : at + n], y) if k) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            weight += w
            marginal += w * np.array(y)
            for a, b in zip(y, y[1:]):
                own[a, b] += w
        assert np.allclose(got[at : at + n], marginal / weight)
        total += np.log(weight)
        expected_pairs += own / weight
        at += n
    assert np.isclose(log_z, total) and np.allclose(pairs, expected_pairs)


def test_toxicity_learns_words_and_beginnings(spark):
    rng = np.random.default_rng(7)
    texts = toxic_texts(rng, 600)
    docs = spark.createDataFrame([doc(k, t) for k, (t, _) in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(texts) if k < 400], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, max_docs=150)
    odd = [doc(None, None), doc(900, ""), doc(901, "You IDIOT, zuvelon!\nw1 w2"), doc(902, "w1 " * 60_000 + "scum"), doc(900, "")]
    every = docs.union(spark.createDataFrame(odd, DOCS))
    got = toxicity.score_documents(every, model, keep=tuple(every.columns), prefix="_p_").collect()
    assert len(got) == 605 and got[0].asDict()["score"] == 0.5
    by_id = {r["doc_id"]: r for r in got}
    assert sum((by_id[k]["_p_score"] >= 0.5) == bool(texts[k][1]) for k in range(400, 600)) >= 196
    assert by_id[None]["_p_score"] < 0.5 and by_id[900]["_p_spans"] == []
    text = odd[2][1]
    assert "IDIOT, zuvelon" in [text[s["start"] : s["end"]] for s in by_id[901]["_p_spans"]]
    long = by_id[902]["_p_spans"]
    assert odd[3][1][long[-1]["start"] : long[-1]["end"]] == "scum"
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] < 1e-9 for r in toxicity.score_documents(docs, empty).collect()} == {True}
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


# -- decontamination


def passages(docs, items):
    def runs(words, size):
        return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]

    found = {}
    for (d, text), (i, item) in product(docs, items):
        sought = words_of((item or "").encode())
        size = min(5, len(sought)) or 5
        own, other = runs(words_of((text or "").encode()), size), runs(sought, size)
        if not own or not other:
            continue
        best = 0.0
        for k in range(max(1, len(own) - len(other) + 1)):
            a, b = Counter(own[k : k + len(other)]), Counter(other)
            best = max(best, sum((a & b).values()) / sum((a | b).values()))
        if best >= 0.8 - 1e-12:
            found[d, i] = best
    return found


@pytest.mark.parametrize("block", [20_000, 7])
def test_decontamination_against_brute_force(spark, stage, block):
    rng = np.random.default_rng(8)
    items = [(k, prose(rng, int(rng.integers(5, 60)))) for k in range(30)] + [(30, None), (31, "too short"), (32, "a a a a a a a a")]
    docs = []
    for k in range(150):
        words = items[k % 33][1].split() if items[k % 33][1] else []
        if len(words) > 30 and k % 2:
            words[int(rng.integers(0, 3))] = "changed"
        docs.append((k, prose(rng, int(rng.integers(0, 300))) + " " + " ".join(words[: len(words) - k % 4]) + " " + prose(rng, k % 50)))
    # items of one to four words are found word for word, once a document
    items += [(33, "Rare-pair"), (34, "one lonely little phrase"), (35, "solitary"), (36, "rare pair"), (None, "rare pair")]
    docs += [(500, None), (501, ""), (502, items[3][1].upper() + "!"), (503, "x " * 30_000 + items[4][1]), (504, "a " * 50)]
    docs += [(505, "a rare, PAIR and a rare pair; solitary"), (506, "one lonely phrase"), (507, "x one lonely little phrase y"), (508, "pair")]
    docs += [(None, "too\nshort"), (509, "solitary")]
    df = spark.createDataFrame([(*d, "q", 1) for d in docs], "doc_id long, text string, mark string, size int")
    bench = spark.createDataFrame([(*i, "q") for i in items], "item_id long, text string, mark string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.find_passages(df, bench, stage, block_items=block).collect()}
    expected = passages(docs, items)
    assert got.keys() == expected.keys() and all(np.isclose(got[k], expected[k]) for k in got) and len(got) > 60
    if block == 7:
        assert decontamination.find_passages(df.limit(0), bench, Stage(spark, "none")).count() == 0
        assert decontamination.find_passages(df, bench.limit(0), Stage(spark, "none")).count() == 0


# -- near-duplicates


def test_near_duplicates_against_brute_force(spark, stage):
    rng = np.random.default_rng(9)
    docs = []
    for k in range(40):
        base = prose(rng, int(rng.integers(30, 200)), 100_000).split()
        for _ in range(k % 5 + 1):
            words = list(base)
            for _ in range(int(rng.integers(0, 3))):
                words[int(rng.integers(0, len(words)))] = f"new{int(rng.integers(0, 10**6))}"
            docs.append((len(docs), " ".join(words)))
    docs += [(500, None), (501, ""), (502, "!!"), (503, "one two"), (504, "One, two."), (505, "long " * 40_000), (505, "long " * 40_000), (3, docs[3][1])]
    df = spark.createDataFrame([(*d, "q", 1, 2) for d in docs], "doc_id long, text string, digest string, copies long, bucket long")
    components_match(df, docs, neardup.near_duplicates(df, stage, block=8).collect())
    assert neardup.near_duplicates(df.limit(0), Stage(spark, "none")).count() == 0


def test_large_group_of_near_copies(spark, stage):
    rng = np.random.default_rng(12)
    base = prose(rng, 150, 100_000).split()
    docs = []
    for k in range(400):
        words = list(base)
        for _ in range(k % 5 if k % 20 else 7):  # some lie too far from the rest to be linked
            words[int(rng.integers(0, len(words)))] = f"new{int(rng.integers(0, 10**6))}"
        docs.append((k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    components_match(df, docs, neardup.near_duplicates(df, stage, block=16).collect())


def test_texts_travel_as_their_words():
    """What near-duplicates keep of a text to compare it: all its words, in less room than the text takes."""
    texts = ["", "One, TWO -- three!", " ".join(f"Word{i % 97}, (of) No. {i * i % 1009}: «Ünï{i % 13}»;" for i in range(400))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array([t.encode() for t in texts], pa.binary())], ["doc_id", "text"]
    )
    weights = SimpleNamespace(value=np.ones(neardup.CELLS, np.float32))
    kept = [t for out in neardup._sampled(weights)([batch]) for t in out.column(1).to_pylist()]
    numbers = neardup.WordNumbers()
    for text, packed in zip(texts, kept, strict=True):
        flat = zlib.decompress(packed)
        assert flat == b" ".join(words_of(text.encode()))
        for one, other in zip(*(neardup.weighted_set(t, numbers, weights.value) for t in (flat, text.encode())), strict=True):
            assert (one == other).all()
    assert len(kept[2]) < 0.95 * len(zlib.compress(texts[2].encode(), 1))


def test_blocks_pair_all_that_is_not_joined(spark):
    members = [(1, k, 7 if k >= 5 else k) for k in range(1000)] + [(2, k, k) for k in range(30)] + [(3, 1, 1), (3, 2, 1)]
    df = spark.createDataFrame(members, "bucket long, class long, component long")
    blocks = {}
    for r in neardup._across_all(df, 10).collect():
        blocks.setdefault((r["bucket"], r["left"], r["right"]), []).append((r["class"], r["component"], r["own"]))
    rows = sum(len(b) for (bucket, _, _), b in blocks.items() if bucket == 1)
    assert rows == 995 + 5 * (1 + 100)  # linear in the joined ones
    met = {(k[0], *sorted((x[0], y[0]))) for k, b in blocks.items() for x in b for y in b if x[0] != y[0] and (k[1] == k[2] or x[2] != y[2])}
    for bucket in (1, 2, 3):
        own = [(c, m) for b, c, m in members if b == bucket]
        assert all((bucket, x, y) in met for x, m in own for y, n in own if x < y and m != n)
    once = [r["class"] for r in neardup._within(df, 10, 1, 2).where("bucket = 1").collect()]
    assert sorted(once) == list(range(1000))


def components_match(df, docs, rows):
    assert len(rows) == len(docs)
    weights = neardup.shingle_weights(df)
    numbers = neardup.WordNumbers()
    sets = [neardup.weighted_set((t or "").encode(), numbers, weights) for _, t in docs]
    near = (neardup.similarities(sets, columns=64) >= 0.8 - 1e-9) | np.eye(len(sets), dtype=bool)
    for a, b in [(0, 1), (3, 7), (10, 11)]:
        x, y = dict(zip(*map(np.ndarray.tolist, sets[a]))), dict(zip(*map(np.ndarray.tolist, sets[b])))
        low = sum(min(x[h], y[h]) for h in x.keys() & y.keys())
        assert np.isclose(neardup.similarities([sets[a], sets[b]])[0, 1], low / (sum(x.values()) + sum(y.values()) - low))
    component = list(range(len(docs)))
    for _ in docs:
        component = [min(component[b] for b in np.flatnonzero(near[a])) for a in range(len(docs))]
    expected = {}
    for k, (d, _) in enumerate(docs):
        expected[d] = min(e for (e, _), c in zip(docs, component) if c == component[k])
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    kept = Counter(r["component_id"] for r in rows if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == set(expected.values())


def test_samples_estimate_the_similarity():
    rng = np.random.default_rng(10)
    for share in (0.5, 0.8, 0.95):
        found = []
        for _ in range(150):
            n = 200
            common = int(n * 2 * share / (1 + share))
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = np.r_[a[:common], rng.integers(0, 1 << 63, n - common, dtype=np.uint64)]
            w = 1 + 3 * rng.random(n)
            low = w[:common].sum()
            found.append((neardup.sample(a, w) == neardup.sample(b, w)).mean() - low / (2 * w.sum() - low))
        assert abs(np.mean(found)) < 0.02


# -- quality


@pytest.fixture(scope="module")
def rated(spark):
    rng = np.random.default_rng(11)
    docs = [doc(k, prose(rng, 80) if k % 4 else "#|%$ " * 40 + prose(rng, 10).upper(), "en" if k % 2 else "de") for k in range(240)]
    docs += [doc(300, None), doc(301, "", None), doc(302, "w1"), doc(303, prose(rng, 50), "xx"), doc(304, "w1 w2 " * 20_000), doc(5, docs[5][1])]
    labels = [(k, int(bool(k % 4))) for k in range(0, 200)] + [(7, 0), (8, None), (None, 1)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")


def kneser_ney(texts, order):
    """The interpolated modified Kneser-Ney probability of a byte behind a context, from its definition."""
    counts = {order: Counter(), **{k: Counter() for k in range(1, order)}}
    for text in texts:
        data = b"\0" * (order - 1) + text
        counts[order].update(data[i : i + order] for i in range(len(text)))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])

    def discounts(k):
        n = [sum(c == j for c in counts[k].values()) for j in range(1, 5)]
        if not all(n[:3]):
            return [0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.1), j - 0.05) for j in (1, 2, 3)]

    cut = {k: discounts(k) for k in counts}
    behind = {k: {} for k in counts}
    for k, grams in counts.items():
        for g, n in grams.items():
            behind[k].setdefault(g[:-1], []).append(n)

    def p(gram, k=order):
        if k == 0:
            return 1 / 256
        gram = gram[-k:] if k < len(gram) else gram
        seen = behind[k].get(gram[:-1])
        if seen is None:
            return p(gram, k - 1)
        n = counts[k].get(gram, 0)
        own = n - cut[k][min(n, 3) - 1] if n else 0
        return (own + sum(cut[k][min(x, 3) - 1] for x in seen) * p(gram, k - 1)) / sum(seen)

    return p


def number(gram):
    return int.from_bytes(gram, "big")


def probabilities(model, m, grams):
    """Of grams by the sharded model, its shards read one by one."""
    sought = np.array([number(g) for g in grams], np.uint64)
    p = quality.interpolated(model.low[m], sought, np.full(len(sought), 1 / 256), 1)
    shard = quality.shard_of(sought, model.shards)
    for row in model.counts.collect():
        held, n = quality._read_counts(row.asDict())
        found = quality.levels(held, quality._three(n), quality.ORDER, quality.LOW + 1)
        orders = range(quality.LOW + 1, quality.ORDER + 1)
        held = [quality.Level.of(found[k][0], found[k][1][m], model.discounts[m][k - quality.LOW - 1]) for k in orders]
        mine = shard == row["shard"]
        p[mine] = quality.interpolated(held, sought[mine], p[mine], quality.LOW + 1)
    return p


@pytest.mark.parametrize("shards", [1, 7])
def test_model_is_kneser_ney(spark, monkeypatch, shards):
    """Against the definition, for the model of all and those of either fold; and a distribution."""
    rng = np.random.default_rng(15)
    texts = [prose(rng, int(n)) for n in rng.integers(1, 40, 60)] + ["é", "", "aaaaaaaaaaaaaa", "aab" * 9] + [None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    with_fold = docs.withColumn("fold", quality.fold()).collect()
    monkeypatch.setattr(quality, "SHARD", 1000)
    model = quality.train(docs, Stage(spark, "kn"), 1000 * shards)
    assert model.shards == shards
    known = [t.encode() for t in texts if t]
    sought = {b"\0" * (quality.ORDER - 1) + t for t in known} | {b"zzzzzzz" + known[0], b"w1 zz 9 w1"}
    grams = sorted({s[i : i + quality.ORDER] for s in sought for i in range(len(s) - quality.ORDER + 1)})
    grams += [g[:-1] + bytes([c]) for g in grams[:: len(grams) // 4] for c in range(256)]
    for m in quality.MODELS:
        own = [r["text"].encode() for r in with_fold if r["text"] and m in (0, r["fold"])]
        p = kneser_ney(own, quality.ORDER)
        got = probabilities(model, m, grams)
        assert got == pytest.approx([p(g) for g in grams], rel=1e-9)
        assert sum(got[-256:]) == pytest.approx(1)


def test_scores_by_shards_are_those_of_the_model(spark, monkeypatch):
    """Chunks, shards and parts of shards change nothing."""
    rng = np.random.default_rng(16)
    texts = [prose(rng, int(n)) for n in rng.integers(1, 60, 80)] + [None, "", "é" * 3000, "#$% " * 50, prose(rng, 4000)]
    rows = [(k, t, k % 3) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m int").repartition(4)
    monkeypatch.setattr(quality, "SHARD", 10_000)
    for chunk, dealt in ((1 << 24, 1 << 30), (3000, 4000)):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        monkeypatch.setattr(quality, "DEALT", dealt)
        model = quality.train(docs.where("doc_id < 60").select("doc_id", "text"), Stage(spark, "train"), 50_000)
        assert (model.shards, model.deal) == (5, 1 if dealt > 4000 else 3)
        scored = quality.score_documents(docs, model, ("doc_id",), by=F.col("m"))
        found = scored.collect()
        # texts move once
        assert "ReusedExchange" in scored._jdf.queryExecution().executedPlan().toString()
        got = {r["doc_id"]: (r["log_p"], r["n_bytes"]) for r in found}
        assert len(found) == len(rows)
        for k, text, m in rows:
            data = (text or "").encode()
            padded = b"\0" * (quality.ORDER - 1) + data
            grams = [padded[i : i + quality.ORDER] for i in range(len(data))]
            wanted = np.log(probabilities(model, m, grams)).sum() if grams else 0.0
            assert got[k][1] == len(data) and got[k][0] == pytest.approx(wanted, abs=0.51 / quality.SCALE * len(data) + 1e-9)


def test_arrays_are_packed_whole():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 1 << 63, 1000).astype(np.uint64), np.zeros(0, np.uint64), np.arange(70_000).astype(np.uint16)):
        assert (quality.unpacked(quality.packed(values), values.dtype) == values).all()
    grams = np.unique(rng.integers(0, 1 << 56, 1000).astype(np.uint64))
    order, data = quality.sent(grams)
    assert (quality.received(data) == grams[order]).all()


def test_quality_keeps_clean_and_rejects_junk(spark, stage, rated):
    docs, labels = rated
    rows = quality.rate_documents(docs, labels, stage).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r["accepted"] for r in rows}
    assert [by_id[k] for k in range(240)] == [bool(k % 4) for k in range(240)]
    assert by_id[300] and by_id[301] and by_id[302] and by_id[303] and by_id[304]
    kept = quality.accept_documents(docs, labels, Stage(spark, "accept"))
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["accepted"])
    none = quality.rate_documents(docs, labels.limit(0), Stage(spark, "none"))
    assert {(r["accepted"], r["perplexity"]) for r in none.collect()} == {(True, 1.0)}
    assert quality.rate_documents(docs.limit(0), labels, Stage(spark, "empty")).count() == 0


def test_quality_model_grows_with_the_text(spark, stage):
    rng = np.random.default_rng(13)
    docs = stage.table(spark.createDataFrame([doc(k, prose(rng, 200, 5_000)) for k in range(80)], DOCS), "docs")

    def size(n):
        counts = quality.count_grams(docs.where(f"doc_id < {n}"), 4).collect()
        assert [r["shard"] for r in counts] and len(counts) == len({r["shard"] for r in counts}) <= 4
        return sum(len(quality.received(r["grams"])) for r in counts)

    assert size(80) > 2 * size(20)


def test_quality_limits_of_few_or_equal_texts(spark):
    rows = [("en", k, -float(100 + k % 21), 100) for k in range(200)]
    rows += [("one", 1000, -150.0, 100)] + [(None, 1001, -90.0, 100)] + [("hot", 1002, -105.0, 100)] * 500
    rows += [("near", 2000 + k, -105.0, 100) for k in range(500)]  # many texts of the same mean
    found = quality.thresholds(spark.createDataFrame(rows, "lang string, text_hash long, log_p double, n_bytes long")).collect()
    limits = {r["lang"]: (r["middle"], r["limit"]) for r in found if not r["every"]}
    assert set(limits) == {"en", "one", None, "hot", "near"}
    for lang, (middle, limit) in limits.items():
        assert limit >= middle + quality.WIDTH * quality.LEAST_SPREAD, lang
    assert limits["one"][0] == pytest.approx(1.5) and limits[None][0] > 0.9


def test_quality_scores_no_trusted_text_by_a_model_that_read_it(spark, stage):
    rng = np.random.default_rng(14)
    texts = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(40)) for _ in range(20)]
    docs = spark.createDataFrame([doc(k % 20 + 100 * (k // 20), texts[k % 20]) for k in range(40)], DOCS)
    labels = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int")
    rated = {r["doc_id"]: r["perplexity"] for r in quality.rate_documents(docs, labels, stage).collect()}
    # ids from 100 are copies that are not labelled: the model of all has read their texts
    assert all(rated[k] > 2 * rated[100 + k] for k in range(20))


# -- pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = np.random.default_rng(12)
    items = [(k, prose(rng, 30)) for k in range(3)]
    docs, labels = [], []
    for k in range(240):
        text = prose(rng, 60, 100_000)
        if k % 10 == 1:
            text = " ".join(w if n % 6 else "idiot" for n, w in enumerate(text.split()))
        if k % 10 == 2:
            text = "|#% " * 60
        if k % 10 == 3:
            text = docs[k - 3][1]
        if k == 14:
            text += " " + items[1][1]
        docs.append((k, text, "en", "s", len(text), "extra"))
        labels.append((k, int(k % 10 != 2), int(k % 10 == 1)))
    docs += [(None, None, None, None, None, None), (9, docs[9][1], "en", "s", 1, "extra")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = Counter(r["doc_id"] for r in got if r["start"] == 0)
    expected = {k for k in range(240) if k % 10 not in (1, 2, 3) and k != 14} | {None}
    assert set(ids) == expected and ids[9] == 1
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:4]:
        assert step(spark, read, str(tmp_path)).columns == read.columns
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing" and tokenizer_path()
