"""Candidates by likeness of fields, against all pairs."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.functions import matchkeys
from fieldloom.plans import similarity
from fieldloom.plans.matching import MatchConfig
from fieldloom.plans.similarity import Likeness

FIELDS = ["first_name", "last_name", "email", "phone", "birth_date", "zip"]
CONFIG = MatchConfig(pii={"primary_key": "pk", **{f: f for f in FIELDS}}, person={f: f for f in FIELDS})
SOURCE = "pk long, " + ", ".join(f"{f} string" for f in FIELDS)
PERSON = "voterbase_id string, " + ", ".join(f"{f} string" for f in FIELDS)
WEIGHTS = {"email": 2.0, "phone": 2.0, "birth_date": 3.0, "zip": 1.0}


def apart(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def misspelled(rng, name, edits):
    letters = list(name)
    for _ in range(edits):
        at, what = rng.randrange(len(letters)), rng.randrange(3)
        if what == 0 and len(letters) > 1:
            del letters[at]
        elif what == 1:
            letters.insert(at, rng.choice("abcdé"))
        else:
            letters[at] = rng.choice("abcdé")
    return "".join(letters)


def test_names_two_letters_apart_share_a_key(spark):
    rng = random.Random(4)
    pairs = []
    for n in list(range(1, 40)) * 12:
        name = "".join(rng.choice("abcdé ") for _ in range(n))
        pairs.append((name, misspelled(rng, name, rng.choice([0, 1, 2, 2, 2]))))
    # repeated letters, cuts at either end, around the length from which halves count
    pairs += [("a" * n, "a" * m) for n in range(1, 24) for m in range(max(1, n - 2), n + 3)]
    pairs += [("ab" * 10, "ba" + "ab" * 9), ("x" + "ab" * 9, "ab" * 9 + "x"), ("abcdefgh" * 3, "xyabcdefgh" + "abcdefgh" * 2)]
    pairs = [(a, b) for a, b in pairs if b]
    df = spark.createDataFrame(pairs, "a string, b string")
    common = F.size(F.array_intersect(matchkeys.name_keys(F.col("a")), matchkeys.name_probes(F.col("b"))))
    missed = [(r.a, r.b) for r in df.where(common == 0).collect() if apart(r.a, r.b) <= 2]
    assert missed == []
    assert sum(apart(a, b) <= 2 for a, b in pairs) > 450


def test_keys_of_a_name_are_bounded(spark):
    """The square of the length up to sixteen letters, then the length: whole names, no cut."""
    names = ["".join(chr(0x4E00 + k) for k in range(n)) for n in (1, 2, 3, 8, 15, 16, 17, 18, 19, 40, 400)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    made = df.select(F.length("n"), F.size(matchkeys.name_keys(F.col("n"))), F.size(matchkeys.name_probes(F.col("n")))).collect()
    for n, keys, probes in made:
        whole = 1 + n + n * (n - 1) // 2
        assert keys == (whole if n <= matchkeys.WHOLE_NAME else n + 2)
        assert probes <= (whole if n <= matchkeys.WHOLE_NAME + 2 else 0) + (7 * (n + 2) if n > matchkeys.WHOLE_NAME - 2 else 0)


def by_hand(sources, people, keep, weights=WEIGHTS):
    """All pairs, scored and ranked."""
    def full(r):
        return f"{r['first_name'].lower()} {r['last_name'].lower()}" if r["first_name"] and r["last_name"] else None

    found = {}
    for s in sources:
        for p in people:
            if None in (s["pk"], p["voterbase_id"], full(s), full(p)) or (d := apart(full(s), full(p))) > 2:
                continue
            same = sum(w for f, w in weights.items() if s[f] and s[f] == p[f])
            both = sum(w for f, w in weights.items() if s[f] and p[f])
            score = round((3 * (1 - d / max(len(full(s)), len(full(p)))) + same) / (3 + both), 6)
            best = found.setdefault(s["pk"], {})
            best[p["voterbase_id"]] = max(best.get(p["voterbase_id"], 0), score)
    return sorted(
        (pk, v, score) for pk, best in found.items() for v, score in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:keep]
    )


def made_up(rng, kind, n):
    out = []
    for k in range(n):
        hot = k % 3 == 0
        first = "ann" if hot else misspelled(rng, rng.choice(["ann", "bob", "margaretha", "josé"]), rng.randrange(3))
        last = "li" if hot else misspelled(rng, rng.choice(["li", "smith", "vandenberghe-of-the-hill"]), rng.randrange(2))
        out.append({
            ("pk" if kind == "source" else "voterbase_id"): k if kind == "source" else f"V{rng.randrange(n):04d}",
            "first_name": rng.choice([first, first.upper(), None]) if k % 20 == 1 else first,
            "last_name": last.replace("-", ""),
            "email": rng.choice([None, f"e{rng.randrange(30)}@x.org"]),
            "phone": rng.choice([None, f"555{rng.randrange(20):07d}"]),
            "birth_date": rng.choice([None, f"1970-01-{rng.randrange(1, 20):02d}"]),
            "zip": rng.choice([None, "10001", "60601"]),
        })
    return out


def frames(spark, sources, people):
    return (
        spark.createDataFrame([tuple(s.values()) for s in sources], SOURCE).repartition(3),
        spark.createDataFrame([tuple(p.values()) for p in people], PERSON).repartition(3),
    )


@pytest.mark.parametrize("keep", [1, 3, 10])
def test_top_is_that_of_all_pairs(spark, keep):
    rng = random.Random(keep)
    sources, people = made_up(rng, "source", 120), made_up(rng, "person", 160)
    with session.Staging(spark, "similar") as staging:
        found = similarity.similar_candidates(replace(CONFIG, matches_per_id=keep), *frames(spark, sources, people), staging)
        got = sorted(map(tuple, found.collect()))
    expected = by_hand(sources, people, keep)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected], abs=1.1e-6)


def test_edges(spark):
    blank = dict.fromkeys(FIELDS)
    sources = [
        {"pk": 1, **blank}, {"pk": 2, **blank, "first_name": "Ann"}, {"pk": None, **blank, "first_name": "Ann", "last_name": "Li"},
        {"pk": 3, **blank, "first_name": "Ann", "last_name": "Li"}, {"pk": 3, **blank, "first_name": "Ann", "last_name": "Li"},
        {"pk": 4, **blank, "first_name": "x" * 3000, "last_name": "y"},
    ]
    people = [
        {"voterbase_id": "V1", **blank, "first_name": "ANN", "last_name": "LI", "zip": "10001"},
        {"voterbase_id": "V1", **blank, "first_name": "An", "last_name": "Li"},
        {"voterbase_id": None, **blank, "first_name": "Ann", "last_name": "Li"},
        {"voterbase_id": "V0", **blank, "first_name": "x" * 2998, "last_name": "y"},
    ]
    with session.Staging(spark, "similar") as staging:
        found = similarity.similar_candidates(CONFIG, *frames(spark, sources, people), staging)
        assert sorted(map(tuple, found.collect())) == by_hand(sources, people, 3) == [(3, "V1", 1.0), (4, "V0", 0.999334)]
    with session.Staging(spark, "none") as staging:
        none = similarity.similar_candidates(CONFIG, *(f.limit(0) for f in frames(spark, sources, people)), staging)
        assert none.count() == 0
    with pytest.raises(ValueError):
        many = replace(CONFIG, pii={**CONFIG.pii, "city": "zip", "state_code": "zip", "gender": "zip"}, person={**CONFIG.person, "city": "zip", "state_code": "zip", "gender": "zip"})
        Likeness(fields=dict.fromkeys([*WEIGHTS, "city", "state_code", "gender"], 1.0)).used(many)


def test_index_moves_the_lowest_ids_only(spark):
    """Ids are cut to the lowest of each task before they move, once; copies of a record take no place."""
    plans = {}

    class Watched(session.Staging):
        def table(self, df, name):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return super().table(df, name)

    blank = dict.fromkeys(FIELDS)
    one = {"voterbase_id": "V1", **blank, "first_name": "Ann", "last_name": "Li", "zip": "10001"}
    spelled = [{**one, "zip": z, "first_name": f} for z in ("10001", "10001-2000", "60601") for f in ("Ann", "ANN ")]
    others = [{**one, "voterbase_id": f"V{k}"} for k in range(2, 6)]
    sources = [{"pk": 1, **blank, "first_name": "Ann", "last_name": "Li", "zip": "10001"}]
    sources.append({**sources[0], "first_name": "ann"})
    with Watched(spark, "similar") as staging:
        found = similarity.similar_candidates(CONFIG, *frames(spark, sources, spelled + others), staging)
        assert sorted(map(tuple, found.collect())) == [(1, f"V{k}", 1.0) for k in (1, 2, 3)]
    index = plans["similarity_index"].split("== Initial Plan ==")[-1]
    assert index.count("Exchange hashpartitioning") == 1
    assert index.index("Exchange") < index.rindex("WindowGroupLimit")


def test_hot_name_is_split(spark):
    """A third of 30,000 sources and people share a name: no pairs within it, and its sources are dealt to several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "32",
        # as many map tasks as a table of some size has
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        own = F.translate(F.md5(F.col("id").cast("string")), "0123456789", "ghijklmnop")
        hot = F.col("id") % 3 == 0
        rows = spark.range(30000).select(
            F.col("id").alias("pk"), F.format_string("V%06d", "id").alias("voterbase_id"), F.lit("ann").alias("first_name"),
            F.when(hot, "li").otherwise(own).alias("last_name"),
        )
        rows = session.stage_table(rows.repartition(8), "many")
        config = MatchConfig(
            pii={"primary_key": "pk", "first_name": "first_name", "last_name": "last_name"},
            person={f: f for f in ("first_name", "last_name")},
        )
        with session.Staging(spark, "hot") as staging:
            found = similarity.similar_candidates(config, rows, rows, staging)
            total = found.agg(F.count("*").alias("n"), F.min("score").alias("least"))
            (row,) = total.collect()
            # themselves, and for the third the lowest ids of their name
            assert row.n == 10000 * 3 + 20000 and row.least == 1
            shown = total._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in shown
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
