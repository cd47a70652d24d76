"""Person candidates by how alike their fields are, for names that may be misspelled.

Two records meet if their full names are at most two letters apart (letters missing,
added or replaced). The score of a pair is the weighted mean, over the fields that both
have, of the likeness of the names and of 1 or 0 for other fields that are equal or not.
A source gets the ``matches_per_id`` people with the highest scores, lowest id first.

This is exact, and no pairs within a name are formed:

- Names meet as distinct texts, by an equality join of what is left when letters are
  dropped; the edit distance is worked out for names that meet.
- The other fields count by equality only. So for each set of fields that a pair may
  share, the lowest ids under the same name, the same values and the same fields filled
  are enough: whoever is left out is preceded by as many people with at least his score.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions import matchkeys
from fieldloom.operators.windows import best_per_key
from fieldloom.plans.matching import MatchConfig
from fieldloom.session import Staging

#: Names are compared up to this many letters apart.
APART = 2
#: Sets of shared fields double with each field.
MOST_FIELDS = 6


@dataclass(frozen=True)
class Likeness:
    """How much the name and each other field count; fields a side does not have are left out."""

    name: float = 3.0
    fields: Mapping[str, float] = field(
        default_factory=lambda: {"email": 2.0, "phone": 2.0, "birth_date": 3.0, "full_address": 2.0, "zip": 1.0}
    )

    def used(self, config: MatchConfig) -> dict[str, float]:
        person = {f for f, c in config.person.items() if c}
        used = {f: w for f, w in self.fields.items() if f in config.mapped and f in person}
        if len(used) > MOST_FIELDS:
            raise ValueError(f"at most {MOST_FIELDS} fields besides the name")
        return used


def _records(df: DataFrame, id_col: str, columns: Mapping[str, str], fields: Mapping[str, float], name: str) -> DataFrame:
    """(name, full, v0.., mask): the normal full name and fields of each record that has both names.

    Copies of a record go first: the normal forms are then worked out behind a shuffle, by
    as many tasks as there is work for, however few files the records come from.
    """
    wanted = dict.fromkeys([id_col, *(columns[f] for f in ("first_name", "last_name", *fields))])
    df = df.where(F.col(id_col).isNotNull()).select(*wanted).distinct()
    normal = {f: matchkeys.normal(f, F.col(columns[f])) for f in ("first_name", "last_name", *fields)}
    values = [normal[f].alias(f"v{i}") for i, f in enumerate(fields)]
    full = F.concat(normal["first_name"], F.lit(" "), normal["last_name"])
    rows = df.select(F.col(id_col).alias(name), full.alias("full"), *values)
    filled = [F.col(f"v{i}").isNotNull().cast("int") * (1 << i) for i in range(len(fields))]
    return rows.where(F.col("full").isNotNull()).withColumn("mask", sum(filled, F.lit(0)))


def similar_names(sources: DataFrame, people: DataFrame) -> DataFrame:
    """(full, person_full, apart) of the distinct names (column ``full``) at most two letters apart."""
    known = people.select(F.col("full").alias("person_full")).distinct()
    index = known.select("person_full", F.explode(matchkeys.name_keys(F.col("person_full"))).alias("key"))
    asked = sources.select("full").distinct()
    asked = asked.select("full", F.explode(matchkeys.name_probes(F.col("full"))).alias("key"))
    met = asked.join(index, "key").select("full", "person_full").distinct()
    return met.withColumn("apart", F.levenshtein("full", "person_full", APART)).where(F.col("apart") >= 0)


def _shared_keys(rows: DataFrame, full: str, n_fields: int) -> DataFrame:
    """A row for each set of its filled fields (``shared``, as bits), keyed by name and values."""
    subsets = F.filter(F.array(*map(F.lit, range(1 << n_fields))), lambda e: e.bitwiseAND(F.col("mask")) == e)
    rows = rows.withColumn("shared", F.explode(subsets))
    mark = F.lit(matchkeys.SEPARATOR)
    parts = [F.when(F.col("shared").bitwiseAND(F.lit(1 << i)) > 0, F.col(f"v{i}")).otherwise("") for i in range(n_fields)]
    key = F.concat(F.col(full), *[x for p in parts for x in (mark, p)], mark, F.col("shared").cast("string"))
    return rows.withColumn("key", F.unhex(F.md5(key)))


def _weights(fields: Mapping[str, float], bits: Column) -> Column:
    """The weights of the fields in a set of bits, added up."""
    added = [sum(w for i, w in enumerate(fields.values()) if e >> i & 1) for e in range(1 << len(fields))]
    return F.get(F.array(*[F.lit(float(w)) for w in added]), bits)


def similar_candidates(
    config: MatchConfig,
    source: DataFrame,
    people: DataFrame,
    staging: Staging,
    likeness: Likeness = Likeness(),  # noqa: B008
    id_col: str = "voterbase_id",
) -> DataFrame:
    """(source_id, matched_id, score): at most ``matches_per_id`` people per source row, best first.

    Records without a first or a last name have no candidates. An id listed several
    times is as alike as its best row.
    """
    fields = likeness.used(config)
    sources = staging.table(_records(source, config.key, config.mapped, fields, "source_id"), "source_records")
    persons = staging.table(_records(people, id_col, config.person, fields, "matched_id"), "person_records")
    names = staging.table(similar_names(sources, persons), "similar_names")

    index = _shared_keys(persons, "full", len(fields)).select("key", F.col("mask").alias("person_mask"), "matched_id")
    # ids are ranked before their repeats under a key go: only the lowest ones of each task move
    rank = F.dense_rank().over(Window.partitionBy("key", "person_mask").orderBy("matched_id"))
    lowest = index.withColumn("_rank", rank).where(F.col("_rank") <= config.matches_per_id).drop("_rank")
    index = staging.table(lowest.distinct(), "similarity_index")

    asked = sources.join(names, "full")
    longest = F.greatest(F.length("full"), F.length("person_full"))
    alike = F.lit(likeness.name) * (1 - F.col("apart") / longest)
    asked = _shared_keys(asked.withColumn("alike", alike), "person_full", len(fields))
    pairs = asked.select("source_id", "alike", "mask", "shared", "key").join(index, "key")
    both = _weights(fields, F.col("mask").bitwiseAND(F.col("person_mask")))
    score = F.round((F.col("alike") + _weights(fields, F.col("shared"))) / (likeness.name + both), 6)
    scored = pairs.select("source_id", "matched_id", score.alias("score")).groupBy("source_id", "matched_id")
    scored = scored.agg(F.max("score").alias("score"))
    return best_per_key(scored, ["source_id"], [F.desc("score"), F.col("matched_id")], config.matches_per_id)
