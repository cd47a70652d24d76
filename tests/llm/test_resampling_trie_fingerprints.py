"""Importance resampling, prefix trie and order MinHash."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks import compare
from fieldloom.llm import importance, order_minhash, prefix_trie
from fieldloom.llm.common import Stage
from fieldloom.llm.oracle import ORACLE
from fieldloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stage(spark):
    made = Stage(spark, "test")
    yield made
    made.drop()


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_prefix_trie"])
def test_against_sql(spark, monkeypatch, name):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLE, name, ORACLE[name])
    assert compare.differences(spark, compare.connect(SF), SF, name) == []


# -- importance resampling

DOCS = "doc_id long, text string, n_words string, score double, rank long, _place long, bucket long"


def doc(doc_id, text):
    return (doc_id, text, "x", 0.5, 7, 8, 9)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def runs(text, n=3):
    ws = words(text)
    return [" ".join(ws[i : i + k]) for k in range(1, n + 1) for i in range(len(ws) - k + 1)]


def by_hand(docs, target, drawn=5, min_words=20):
    bucket = lambda text: Counter(zlib.crc32(g.encode()) % 10000 for g in runs(text))
    found = [bucket(t) for _, t in docs]
    s, t = sum(found, Counter()), sum(map(bucket, target), Counter())
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for (doc_id, text), f in zip(docs, found, strict=True):
        weight = sum(n * gain[b] for b, n in f.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words(text)), f.total(), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for k, r in enumerate(able[: len(able) * drawn // 100], 1):
        r[5] = k
    return out


def test_spans_are_all_runs_of_words():
    for text in ("", "a", "A  b\tc-d", "é1 2 ÀB c", " x ", "ab\x00cd", "one two three four five"):
        assert sorted(g.decode() for g in importance.ngrams(text.encode())) == sorted(runs(text))


def test_importance_equals_brute_force(spark, stage):
    rng = np.random.default_rng(5)
    words_ = [f"w{k}" for k in range(60)] + ["é", "WORD"]
    docs = [(k, " ".join(rng.choice(words_, int(rng.integers(0, 60))))) for k in range(400)]
    target = [" ".join(rng.choice(words_[:20], 30)) for _ in range(9)]
    items = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    found = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), items, stage, drawn=30)
    got = sorted(map(tuple, found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()))
    assert got == sorted(map(tuple, by_hand(docs, target, 30)))
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 1 + sum(r[5] is not None for r in got)))


def test_importance_edges(spark, rows, stage):
    long_one = " ".join(f"w{k % 977}" for k in range(400_000))
    values = [doc(1, None), doc(2, ""), doc(None, "a " * 30), doc(3, "b " * 25), doc(3, "b " * 25), doc(4, "é" * 100_000), doc(5, long_one)]
    items = rows("item_id long, text string, n_words string", (1, None, "x"), (2, "b b b", "y"))
    found = importance.resample(rows(DOCS, *values), items, stage, drawn=50)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got = found.collect()
    expected = by_hand([v[:2] for v in values], [None, "b b b"], 50)
    key = lambda r: (r[0] is None, r[0] or 0, r[5] is None, r[5] or 0)
    assert [tuple(r) for r in sorted(got, key=key)] == [tuple(r) for r in sorted(expected, key=key)]
    none = importance.resample(rows(DOCS).limit(0), items, Stage(spark, "none"))
    assert none.count() == 0
    alone = importance.resample(rows(DOCS, doc(1, "a b")), items.limit(0), Stage(spark, "none"))
    assert alone.first()["n_features"] == 3 and alone.first()["rank"] is None


def test_importance_counts_in_bounded_pieces(monkeypatch):
    flat = importance.collapsed(b"a b c d e f g a b c")
    whole = importance._bucket_counts(flat, importance.span_patterns(), 50)
    monkeypatch.setattr(importance, "SPANS_AT_ONCE", 4)
    assert (importance._bucket_counts(flat, importance.span_patterns(), 50) == whole).all() and whole.sum() == 27


@pytest.mark.parametrize("max_n", [1, 2, 3, 4])
def test_one_scan_finds_spans_of_all_lengths(monkeypatch, max_n):
    pattern = importance.span_patterns(max_n)
    assert pattern.groups == max_n
    for text in ("", "a", "a b", "a b c", "é ab c de fgh i", " ".join("abcdefghij" * 30), "x" * 5000 + " y z " + "w" * 99):
        words = text.encode().split()
        expected = sorted(b" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1))
        for piece in (1, 2, 3, 7, 1 << 16):
            monkeypatch.setattr(importance, "SPANS_AT_ONCE", piece)
            assert sorted(importance.ngrams(text.encode(), max_n)) == expected
            counts = importance._bucket_counts(importance.collapsed(text.encode()), pattern, 50)
            assert counts.sum() == len(expected)


# -- prefix trie

TURNS = "conv_id long, turn long, role string, text string, id string, depth long, chain string"


def turn(conv_id, number, role, text):
    return (conv_id, number, role, text, "x", 1, "y")


def trie_by_hand(built):
    """Nodes of {conv: [(role, text), ...]} as the operator returns them."""
    members, ends = defaultdict(set), defaultdict(list)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(conv)
        ends[tuple(turns)].append(conv)
    own = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    kids = Counter(p[:-1] for p in members if p)
    total, leaves = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            total[p[:d]] += own[p]
            leaves[p[:d]] += not kids[p]
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], total[p], sha(ends[p]), len(ends[p]))
        for p, m in members.items()
    )


def nodes_of(turns, lengths, stage, band):
    found = prefix_trie.prefix_trie(turns, lengths, stage, band)
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


def own(rows, stage):
    placed = prefix_trie.place_turns(rows, stage)
    return prefix_trie.own_turns(placed, stage.table(prefix_trie.conversations(placed), "known"))


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_of_any_depth_equals_brute_force(spark, stage, band):
    rng = np.random.default_rng(band)
    built = {}
    for c in range(60):
        other = built[int(rng.integers(0, c))] if c else []
        kept = other[: int(rng.integers(0, len(other) + 1))]
        built[c] = kept + [("user", f"t{rng.integers(0, 2)}é") for _ in range(int(rng.integers(1, 30)))]
    built[60], built[61] = built[3], built[3]
    built[62] = built[3] + built[4] + built[5] + built[6]
    values = [turn(c, k, role, text) for c, turns in built.items() for k, (role, text) in enumerate(turns)]
    rng.shuffle(values)
    df = spark.createDataFrame([(int(a), int(b), c, d, e, int(f), g) for a, b, c, d, e, f, g in values], TURNS).repartition(5)
    assert nodes_of(*own(df, stage), stage, band) == trie_by_hand(built)


def test_trie_edges(spark, rows, stage):
    long_text = "é" * 300_000
    values = [
        turn(1, None, "user", "first"), turn(1, 0, None, None), turn(1, 1, "", ""), turn(1, 1, "", ""),
        turn(2, 5, "user", "first"), turn(None, 1, "user", "nobody's"), turn(7, 0, "user", long_text), turn(8, 0, "user", long_text),
    ]
    built = {1: [("user", "first"), ("", ""), ("", ""), ("", "")], 2: [("user", "first")], 7: [("user", long_text)], 8: [("user", long_text)]}
    assert nodes_of(*own(rows(TURNS, *values), stage), stage, 2) == trie_by_hand(built)
    empty = Stage(spark, "none")
    assert nodes_of(*own(rows(TURNS).limit(0), empty), empty, 4) == []


def test_lent_turns(spark, rows, stage):
    values = [turn(c, k, "user", f"{c}.{k}") for c, n in ((0, 3), (1, 9), (2, 1), (5, 2), (8, 4), (11, 2)) for k in range(n)]
    placed = prefix_trie.place_turns(rows(TURNS, *values), stage)
    known = stage.table(prefix_trie.conversations(placed), "known")
    lent = {0: 5, 1: 4, 2: 0, 5: 8, 8: 1, 11: 6}
    given = F.create_map(*[F.lit(x).cast("long") for pair in lent.items() for x in pair])
    turns, lengths = prefix_trie.lend_first_turns(placed, known, lambda c: c - c % 5, lambda c: given[c], 8)
    built = {
        0: ["0.0", "0.1", "0.2"], 1: ["0.0", "0.1", "0.2", *[f"1.{k}" for k in range(4, 9)]], 2: ["2.0"],
        5: ["5.0", "5.1"], 8: ["5.0", "8.1", "8.2", "8.3"], 11: [],
    }
    assert {r[0]: r[1] for r in lengths.collect()} == {c: len(t) for c, t in built.items()}
    texts = {c: [("user", t) for t in turns] for c, turns in built.items()}
    assert nodes_of(turns, lengths, stage, 4) == trie_by_hand(texts)


def test_trie_hashes_ids_in_pieces(spark, stage, monkeypatch):
    ids = [(key, c) for c in range(-5, 3000) for key in (b"a" * 16, b"b" * 16) if key[0] == 97 or c % 7 == 0]
    df = spark.createDataFrame(ids, "id binary, conv_id long").repartition(6)
    expected = {
        key: hashlib.sha256(",".join(str(c) for k, c in sorted(ids) if k == key).encode()).hexdigest() for key in {k for k, _ in ids}
    }
    assert {bytes(r[0]): r[1] for r in prefix_trie.hash_members(df).collect()} == expected
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 64)
    whole = spark.createDataFrame(sorted(ids), "id binary, conv_id long").toArrow().to_batches(max_chunksize=100)
    pieces = list(prefix_trie._join_runs(iter(whole)))
    assert sum(b.num_rows for b in pieces) > 100
    hashed = [r for b in prefix_trie._hash_runs(iter(pieces)) for r in b.to_pylist()]
    assert {r["id"]: r["d"] for r in hashed} == expected


# -- order MinHash


def xx(value, seed=42):
    data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=value < 0)
    return xxhash.xxh64_intdigest(data, seed=seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def tuples_by_hand(text, k=3, taken=2, sketches=64):
    """The k-mers numbered, dealt to parts, the smallest taken, put in text order and hashed."""
    pieces = [xx(p) for p in re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text or "")]

    def chained(hashes):
        seed = 42
        for h in hashes:
            seed = xx(signed(h), seed)
        return seed

    kmers = [chained(pieces[i : i + k]) for i in range(max(len(pieces) - k, 0) + 1)] if pieces else []
    seen, parts = Counter(), defaultdict(list)
    for place, h in enumerate(kmers):
        number = xxhash.xxh64_intdigest((seen[h]).to_bytes(4, "little"), seed=xx(signed(h)))
        seen[h] += 1
        parts[number >> 64 - (sketches.bit_length() - 1)].append((number >> 32, place))
    out = []
    for part, members in sorted(parts.items()):
        places = sorted(p for _, p in sorted(members)[:taken])
        out.append(part << 32 | chained([kmers[p] for p in places]) >> 32)
    return out


def likeness_by_hand(a, b):
    filled = {t >> 32 for t in a} | {t >> 32 for t in b}
    return len(set(a) & set(b)) / len(filled) if filled else 1.0


def fingerprints(df, stage, **options):
    return order_minhash.fingerprint_documents(df, stage, **options).collect()


def prints_by_hand(docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    out = []
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, b, c = tuples_by_hand(text), tuples_by_hand(edited), tuples_by_hand(following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), sha, a, b, pytest.approx(likeness_by_hand(a, b)), pytest.approx(likeness_by_hand(a, c))))
    return out


def test_fingerprints_equal_brute_force(spark, stage):
    rng = np.random.default_rng(11)
    vocabulary = ["a", "bé", "longer-than-eight", "\n", "𝄞x", "word", "Word", "\t"]
    docs = [(k * 3, " ".join(rng.choice(vocabulary, int(rng.integers(0, 400))))) for k in range(50)]
    docs += [(1000 + k, "same " * k) for k in range(6)] + [(2000, "".join(rng.choice(list("abcdef"), 3000)))]
    found = fingerprints(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), stage)
    assert [tuple(r) for r in sorted(found, key=lambda r: r[0])] == prints_by_hand(docs)


def test_fingerprint_edges(spark, rows, stage):
    schema = "doc_id long, text string, _key string, fingerprint string, next_key long, copies long"
    extra = ("x", "y", 1, 2)
    long_text = " ".join(f"w{k}" for k in range(60_000))
    docs = [(None, "of no id " * 9), (1, None), (2, ""), (3, "ab"), (4, long_text), (5, "   \n ")]
    found = fingerprints(rows(schema, *[(*d, *extra) for d in docs]), stage)
    assert [tuple(r) for r in sorted(found, key=lambda r: (r[0] is not None, r[0] or 0))] == prints_by_hand(docs)
    # repeated rows are one document in the order
    twice = fingerprints(rows(schema, *[(1, "a b c d e f", *extra)] * 3, (2, "g h i", *extra)), Stage(spark, "twice"))
    assert Counter(r["doc_id"] for r in twice) == {1: 3, 2: 1} and len({tuple(map(str, r)) for r in twice}) == 2
    alone = fingerprints(rows(schema, (1, "a b c d", *extra)), Stage(spark, "alone"))
    assert [(r["near_edited"], r["near_next"]) for r in alone] == [(pytest.approx(likeness_by_hand(tuples_by_hand("a b c d"), tuples_by_hand("a b c a"))), 1.0)]
    assert fingerprints(rows(schema).limit(0), Stage(spark, "none")) == []


def test_fingerprints_feel_order_and_edits(spark, stage):
    rng = np.random.default_rng(2)
    text = [f"w{x}" for x in rng.integers(0, 5000, 2000)]
    few = [w if rng.random() > 0.01 else "new" for w in text]
    halves = text[1000:] + text[:1000]
    shown = spark.createDataFrame([(" ".join(text), " ".join(few), " ".join(halves), " ".join(text[::-1]))], "a string, b string, c string, d string")
    for c in "abcd":
        shown = order_minhash.with_fingerprint(shown, c, f"f{c}", sketches=256)
    near = [order_minhash.likeness(F.col("fa"), F.col(f"f{c}")) for c in "abcd"]
    same, edited, moved, reverse = shown.select(*near).first()
    assert same == 1.0 and 0.85 < edited < 1.0 and 0.3 < moved < 0.7 and reverse < 0.1


def test_fingerprints_without_python(spark):
    """The main path is Spark's own expressions, and no text or k-mer is worked out twice within a lambda."""
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = order_minhash.with_fingerprint(df, "text", "f")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
