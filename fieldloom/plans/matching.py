"""Linking the rows of any people table to a reference person file.

``match`` runs the whole job; every step is usable alone. Two rounds are made: on
the rows as they are, and again, with cleaned addresses and inferred names, on the
rows the first round left over.

Candidates come from ranked match rules. A rule names the fields two records must
share and how each is compared, and carries the score of a pair that satisfies it;
the score of a pair is its best rule's. Since a pair's score depends on shared keys
only, a source row needs no more than the ``matches_per_id`` lowest person ids of
each key to get its exact top list: any further person under a key is preceded by
those with the same score. So the person file is cut to that many ids per key before
it meets the sources, and the pairs inside a large key group are never formed.

Most records share the values of some of their fields with others. So keys are made of
distinct combinations of values, not of records: rules that look at the same fields form
a block, each combination of a block's fields finds its best people once, and a record
takes over what its combinations have found. That is exact as well: whoever is among a
record's best by some rule is among the best of that rule's combination.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions import address, matchkeys
from fieldloom.functions.names import name_guesses
from fieldloom.functions.text import same_text
from fieldloom.operators.joins import without_keys
from fieldloom.operators.sets import union_all
from fieldloom.operators.windows import best_per_key, chunk_of
from fieldloom.session import Staging
from fieldloom.sources.versions import VersionedTable

FIELDS = [
    "primary_key", "first_name", "middle_name", "last_name", "phone", "email", "full_address", "unit", "city",
    "state_code", "zip", "gender", "birth_date", "birth_year", "birth_month", "birth_day", "house_number",
    "street", "lat", "lon",
]

RESULT = ["person_id", "voterbase_id", "score", "matched_date"]

STANDARD = {
    "full_address": "std_priadr",
    "unit": "std_secadr",
    "city": "std_city",
    "state_code": "std_state",
    "zip": "std_zip",
}


TIED = ("state_code", "first_name", "last_name")

#: What the index of the person file carries for the best match.
CARRIED = ["person_id", *(f"_{f}" for f in TIED)]


@dataclass(frozen=True)
class MatchRule:
    """A pair sharing all these fields has at least this score.

    Comparisons: ``exact``, ``prefix<n>`` (the first n characters) and, for one field
    at most, ``near`` (one slip of the pen apart).
    """

    score: float
    fields: Mapping[str, str]

    def __post_init__(self) -> None:
        if list(self.fields.values()).count("near") > 1:
            raise ValueError("a rule compares one field at most as near")


RULES = (
    MatchRule(0.98, {"email": "exact", "last_name": "exact"}),
    MatchRule(0.96, {"phone": "exact", "last_name": "exact"}),
    MatchRule(0.95, {"first_name": "exact", "last_name": "exact", "birth_date": "exact"}),
    MatchRule(0.92, {"first_name": "exact", "last_name": "exact", "full_address": "exact", "zip": "exact"}),
    MatchRule(0.85, {"first_name": "exact", "last_name": "exact", "zip": "exact"}),
    MatchRule(0.75, {"first_name": "prefix3", "last_name": "exact", "zip": "exact"}),
    MatchRule(0.7, {"first_name": "exact", "last_name": "near", "zip": "exact"}),
    MatchRule(0.65, {"first_name": "near", "last_name": "exact", "zip": "exact"}),
    MatchRule(0.55, {"first_name": "exact", "last_name": "exact", "city": "exact", "state_code": "exact"}),
    MatchRule(0.5, {"email": "exact"}),
    MatchRule(0.45, {"phone": "exact"}),
    MatchRule(0.35, {"first_name": "exact", "last_name": "exact", "state_code": "exact"}),
    MatchRule(0.25, {"first_name": "prefix3", "last_name": "exact", "state_code": "exact"}),
)


@dataclass(frozen=True)
class MatchConfig:
    """Settings of one matching job.

    ``pii`` maps the names in ``FIELDS`` to columns of the source, ``person`` to
    columns of the person file; fields that are missing or None are not used.
    """

    pii: Mapping[str, str | None]
    person: Mapping[str, str | None] = field(
        default_factory=lambda: {f: f for f in ("first_name", "last_name", "state_code")}
    )
    matches_per_id: int = 3
    enable_cleaning: bool = True
    rematch_threshold: float = 0.6
    cutoff_threshold: float = 0.4
    use_extra_match: bool = True
    rules: Sequence[MatchRule] = RULES

    @property
    def mapped(self) -> dict[str, str]:
        unknown = set(self.pii) - set(FIELDS)
        if unknown or not self.pii.get("primary_key"):
            raise ValueError(f"pii needs a primary_key and knows no {sorted(unknown)}")
        return {f: self.pii[f] for f in FIELDS if self.pii.get(f)}

    @property
    def key(self) -> str:
        return self.mapped["primary_key"]

    @property
    def columns(self) -> list[str]:
        """Mapped source columns, each once."""
        return list(dict.fromkeys(self.mapped.values()))

    def source(self, name: str) -> Column:
        """The source column of a field; a typed NULL if it has none."""
        return F.col(self.mapped[name]) if name in self.mapped else F.lit(None).cast("string")

    def person_column(self, name: str) -> Column:
        """The same of the person file."""
        return F.col(self.person[name]) if self.person.get(name) else F.lit(None).cast("string")

    def rules_in_use(self) -> list[tuple[int, MatchRule]]:
        """Rules all of whose fields both sides have, numbered."""
        person = {f for f, c in self.person.items() if c}
        return [(i, r) for i, r in enumerate(self.rules) if set(r.fields) <= set(self.mapped) & person]

    def blocks(self) -> list[tuple[tuple[str, ...], list[tuple[int, MatchRule]]]]:
        """The rules in use by the fields whose values they need: (fields, numbered rules).

        A rule goes with one that looks at more fields than its own. Those with a near
        field have many keys: they stay with the few values that they need themselves.
        """
        rules = self.rules_in_use()
        sets = {frozenset(r.fields) for _, r in rules}
        near = {frozenset(r.fields) for _, r in rules if "near" in r.fields.values()}
        whole = [s for s in sets if s in near or not any(s < other for other in sets)]
        blocks: dict[tuple[str, ...], list[tuple[int, MatchRule]]] = {}
        for number, rule in rules:
            own = frozenset(rule.fields)
            wide = own if own in near else min((s for s in whole if own <= s), key=lambda s: (len(s), sorted(s)))
            blocks.setdefault(tuple(sorted(wide)), []).append((number, rule))
        return list(blocks.items())


def mapped_columns(config: MatchConfig, df: DataFrame) -> DataFrame:
    """The mapped columns of a source, and nothing else of it."""
    return df.select(*config.columns)


def rematch_universe(
    config: MatchConfig, source: DataFrame, previous: DataFrame | None = None, chunks: int = 1
) -> DataFrame:
    """Rows to match: all on the first run, then those without a score or below the threshold.

    The ``score`` column is always there, NULL where there is no earlier match.
    """
    if previous is None:
        rows = source.withColumn("score", F.lit(None).cast("double"))
    else:
        rows = source.join(previous.select(config.key, "score"), config.key, "left").where(
            F.col("score").isNull() | (F.col("score") < config.rematch_threshold)
        )
    return rows.withColumn("chunk", chunk_of(F.col(config.key), chunks))


def _keys(config: MatchConfig, block: Column, columns: Mapping[str, Column]) -> Column:
    """Array of (score, key) of a combination, over the rules of its block; NULL keys for missing fields.

    A key is the digest of the rule's number and its fields.
    """
    mark = F.lit(matchkeys.SEPARATOR)

    def scored(rule: MatchRule, key: Column) -> Column:
        # 16 bytes, however long the fields are
        return F.struct(F.lit(rule.score).alias("score"), F.unhex(F.md5(key)).alias("key"))

    def keys(number: int, rule: MatchRule) -> Column:
        near = [f for f, how in rule.fields.items() if how == "near"]
        parts = [matchkeys.part(columns[f], how) for f, how in reversed(rule.fields.items()) if how != "near"]
        key = F.concat(*[x for p in parts for x in (p, mark)], F.lit(str(number)))
        if not near:
            return F.array(scored(rule, key))
        forms = matchkeys.one_letter_less(columns[near[0]], lambda f: scored(rule, F.concat(key, mark, f)))
        return F.coalesce(F.array_distinct(forms), F.array())

    of_block = [F.concat(*[keys(*r) for r in rules]) for _, rules in config.blocks()]
    return reduce(lambda other, b: F.when(block == b, of_block[b]).otherwise(other), range(len(of_block)), F.array())


def _combinations(
    config: MatchConfig, df: DataFrame, columns: Mapping[str, str], id_col: str, name: str, carried: Sequence[str] = ()
) -> DataFrame:
    """One row per record and block that has a rule for it: the id, what is carried along, the block's values.

    ``combination`` is the digest of a block's number and values, ``_n_`` columns hold
    the values; those of other blocks are NULL.
    """
    blocks = config.blocks()
    used = dict.fromkeys(f for fields, _ in blocks for f in fields)
    normal = {f: F.col(f"_n_{f}") for f in used}
    plain = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias(name), *carried, *[matchkeys.normal(f, F.col(columns[f])).alias(f"_n_{f}") for f in used]
    )
    mark = F.lit(matchkeys.SEPARATOR)
    structs = []
    for number, (fields, rules) in enumerate(blocks):
        filled = [reduce(and_, [normal[f].isNotNull() for f in rule.fields]) for _, rule in rules]
        # normal values are never empty and hold no mark
        text = F.concat(F.lit(str(number)), *[x for f in fields for x in (mark, F.coalesce(normal[f], F.lit("")))])
        values = [(normal[f] if f in fields else F.lit(None).cast("string")).alias(f"_n_{f}") for f in used]
        one = F.struct(F.lit(number).alias("_block"), F.unhex(F.md5(text)).alias("combination"), *values)
        structs.append(F.when(reduce(or_, filled), one))
    if not structs:
        nothing = F.lit(None)
        rows = plain.withColumns({"_block": nothing.cast("int"), "combination": nothing.cast("binary")})
        return rows.where(F.lit(False))
    exploded = plain.select(name, *carried, F.explode(F.array(*structs)).alias("c")).where(F.col("c").isNotNull())
    return exploded.select(name, *carried, "c.*")


def _keyed(config: MatchConfig, combinations: DataFrame, *kept: str) -> DataFrame:
    """One row per combination and key: the columns kept, the score of the rule, the key."""
    columns = {f: F.col(f"_n_{f}") for fields, _ in config.blocks() for f in fields}
    if not columns:
        nothing = {"score": F.lit(None).cast("double"), "key": F.lit(None).cast("binary")}
        return combinations.select(*kept).withColumns(nothing)
    exploded = combinations.select(*kept, F.explode(_keys(config, F.col("_block"), columns)).alias("k"))
    return exploded.where(F.col("k.key").isNotNull()).select(*kept, "k.score", "k.key")


def _tied(config: MatchConfig) -> dict[str, Column]:
    """What the tie-out compares of a person, by the name it is carried under."""
    person = {f: config.person_column(f) for f in TIED}
    return {f"_{f}": F.left(c, F.lit(3)) if f == "first_name" else c for f, c in person.items()}


def person_index(config: MatchConfig, people: DataFrame, id_col: str = "voterbase_id") -> DataFrame:
    """Under each key the lowest ``matches_per_id`` person ids, with what the best match needs of them.

    Columns: ``key, matched_id`` and ``CARRIED``; an id listed several times is found by
    the fields of all its rows and stands with the data of the lowest one. Stage it
    before use: both rounds read it, and read back it is a plain side of a join, which
    the adaptive planner can pair with a split hot key of the sources.
    """
    wanted = [c for c in dict.fromkeys(config.person.values()) if c and c != id_col]
    # candidates alone need no person id
    person_id = F.col("person_id") if "person_id" in people.columns else F.lit(None).cast("string")
    carried = F.struct(person_id.alias("person_id"), *[c.alias(n) for n, c in _tied(config).items()])
    listed = people.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("matched_id"), *wanted, carried.alias("_p"))
    if id_col in config.person.values():
        listed = listed.withColumn(id_col, F.col("matched_id"))
    lowest = listed.groupBy("matched_id").agg(F.min(F.struct(F.col("_p.person_id").isNull(), "_p")).alias("_lowest"))
    once = listed.drop("_p").join(lowest, "matched_id").select("*", "_lowest._p.*").drop("_lowest")

    def lowest_ids(rows: DataFrame, of: str) -> DataFrame:
        rank = F.dense_rank().over(Window.partitionBy(of).orderBy("matched_id"))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= config.matches_per_id).drop("_rank")

    combinations = _combinations(config, once.distinct(), config.person, "matched_id", "matched_id", CARRIED)
    keyed = _keyed(config, lowest_ids(combinations, "combination"), "matched_id", *CARRIED)
    # repeats of an id under a key go before ids are ranked
    return lowest_ids(keyed.select("key", "matched_id", *CARRIED).distinct(), "key")


def match_candidates(
    config: MatchConfig, source: DataFrame, index: DataFrame, keep_unmatched: bool = True, carry: bool = False
) -> DataFrame:
    """(source_id, matched_id, score): at most ``matches_per_id`` people per source row.

    Highest score first, lowest id among equals. With ``keep_unmatched`` a source
    without any candidate is there once, with NULLs; with ``carry`` the rows have the
    ``CARRIED`` columns of the index too, which ``best_match`` then need not look up.
    """
    carried = CARRIED if carry else []

    def best(pairs: DataFrame, of: str) -> DataFrame:
        scored = pairs.groupBy(of, "matched_id", *carried).agg(F.max("score").alias("score"))
        return best_per_key(scored, [of], [F.desc("score"), F.col("matched_id")], config.matches_per_id)

    combinations = _combinations(config, source, config.mapped, config.key, "source_id")
    asked = _keyed(config, combinations.drop("source_id").distinct(), "combination")
    found = best(asked.join(index.select("key", "matched_id", *carried), "key"), "combination")
    top = best(combinations.select("source_id", "combination").join(found, "combination"), "source_id")
    if not keep_unmatched:
        return top
    ids = source.select(F.col(config.key).alias("source_id")).where(F.col("source_id").isNotNull()).distinct()
    return ids.join(top, "source_id", "left")


def tie_out(config: MatchConfig, person: Mapping[str, Column]) -> Column:
    """1 where state, last name and the first three letters of the first name agree, else 0.

    ``person`` has the first name already cut.
    """
    if not config.use_extra_match or not set(TIED) <= set(config.mapped):
        return F.lit(0)
    agree = (
        same_text(config.source("state_code"), person["state_code"])
        & same_text(F.left(config.source("first_name"), F.lit(3)), person["first_name"])
        & same_text(config.source("last_name"), person["last_name"])
    )
    return F.when(agree, 1).otherwise(0)


def best_match(
    config: MatchConfig,
    candidates: DataFrame,
    source: DataFrame,
    people: DataFrame | None = None,
    run_date: date | None = None,
) -> DataFrame:
    """The accepted match of each source row, with its mapped columns.

    A source's candidates are ranked by tie-out, then score; only the first counts.
    If that one has no person id or neither tie-out nor a score at the cutoff, the
    source stays without a match. Candidates that do not carry what is needed of a
    person are looked up in ``people`` by their voter id.
    """
    found = candidates.where(F.col("matched_id").isNotNull())
    if not set(CARRIED) <= set(found.columns):
        tied = [c.alias(name) for name, c in _tied(config).items()]
        person = people.select("person_id", F.col("voterbase_id").alias("_voter"), *tied)
        found = found.join(person, F.col("matched_id") == F.col("_voter"), "left")
    known = mapped_columns(config, source).withColumn("_key", F.col(config.key))
    kept = found.select(
        F.col("source_id").alias("_source"), F.col("person_id").alias("_person"), F.col("matched_id").alias("_voter"),
        F.col("score").alias("_score"), *[f"_{f}" for f in TIED],
    )
    rows = kept.join(known, F.col("_source") == F.col("_key")).select(
        "_source",
        F.col("_person").alias("person_id"),
        F.col("_voter").alias("voterbase_id"),
        F.col("_score").alias("score"),
        *config.columns,
        tie_out(config, {f: F.col(f"_{f}") for f in TIED}).alias("_extra"),
    )
    # the join has brought the rows of a source together in order: its first row is an
    # aggregate that needs no further sort, and that is taken in two steps where the
    # join had to be split for a hot key
    order = [-F.col("_extra"), F.col("score").isNull(), -F.col("score"), F.col("voterbase_id"), F.col("person_id").isNull()]
    first = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], *rows.drop("_source").columns)
    accepted = (
        rows.groupBy("_source")
        .agg(F.min(first).alias("first"))
        .select("first.*")
        .where(((F.col("score") >= config.cutoff_threshold) | (F.col("_extra") == 1)) & F.col("person_id").isNotNull())
    )
    today = F.current_date() if run_date is None else F.lit(run_date)
    return accepted.withColumn("matched_date", today).select(*RESULT, *config.columns)


def cleaning_universe(
    config: MatchConfig, universe: DataFrame, matched: DataFrame, cleaned: DataFrame | None = None
) -> DataFrame:
    """Rows that found no match and were never cleaned before."""
    others = [matched] if cleaned is None else [matched, cleaned]
    return without_keys(universe, config.key, *others)


def standardise_addresses(config: MatchConfig, df: DataFrame) -> DataFrame:
    """``df`` with the five ``std_`` address columns; row by row, nothing moves."""
    return df.withColumns(
        {
            "std_priadr": address.standard_street(config.source("full_address")),
            "std_secadr": address.standard_unit(config.source("full_address"), config.source("unit")),
            "std_city": address.standard_city(config.source("city")),
            "std_state": address.standard_state(config.source("state_code")),
            "std_zip": address.standard_zip(config.source("zip")),
        }
    )


def infer_names(config: MatchConfig, df: DataFrame) -> DataFrame:
    """(key, first_name_guess, last_name_guess), one row per key.

    A key with several rows is judged by the one with the lowest email.
    """
    names = ["email", "first_name", "last_name"]
    if not any(f in config.mapped for f in names):
        nothing = F.lit(None).cast("string")
        return df.select(config.key).distinct().withColumns(
            {"first_name_guess": nothing, "last_name_guess": nothing}
        )
    one = best_per_key(
        df.select(F.col(config.key), *[config.source(f).alias(f"_{f}") for f in names]),
        [config.key],
        [F.col(f"_{f}").asc_nulls_last() for f in names],
    )
    first, last = name_guesses(F.col("_first_name"), F.col("_last_name"), F.col("_email"))
    return one.select(config.key, first.alias("first_name_guess"), last.alias("last_name_guess"))


def coalesce_cleaned(config: MatchConfig, df: DataFrame, names: DataFrame) -> DataFrame:
    """Mapped columns with guessed names and standard addresses where there are any.

    ``df`` has its ``std_`` columns. Values are kept whole; rows without a key are dropped.
    """
    guesses = {"first_name": "first_name_guess", "last_name": "last_name_guess"}
    columns = {}
    for name, column in config.mapped.items():
        if name in guesses:
            value = F.coalesce(guesses[name], column)
        elif name in STANDARD:
            value = F.coalesce(F.col(STANDARD[name]).cast("string"), F.col(column).cast("string"))
        else:
            value = F.col(column)
        columns.setdefault(column, value.alias(column))
    return df.join(names, config.key, "left").where(F.col(config.key).isNotNull()).select(*columns.values())


def cleaning_history(cleaned: DataFrame, run_date: date | None = None) -> DataFrame:
    """Cleaned rows with the day of cleaning, as they are appended to the history."""
    return cleaned.withColumn("cass_date", F.current_date() if run_date is None else F.lit(run_date))


def merge_matches(config: MatchConfig, *rounds: DataFrame | None) -> DataFrame:
    """The match with the highest score of each key over rounds and earlier output.

    Among equal scores the newer match wins, then the lower voter id.
    """
    columns = [*RESULT, *config.columns]
    rows = union_all(r.select(*columns) for r in rounds if r is not None)
    order = [
        F.col("score").desc_nulls_last(),
        F.col("matched_date").desc_nulls_last(),
        F.col("voterbase_id"),
        F.col("person_id"),
    ]
    order += [F.col(c).asc_nulls_last() for c in config.columns]
    return best_per_key(rows, [config.key], order)


@dataclass(frozen=True)
class MatchResult:
    """``matches`` is the whole new output, ``cleaned`` what to append to the history.

    Both read the stage tables of the run. As a context manager it drops those at its
    end, when both are written, and keeps them after an error.
    """

    matches: DataFrame
    cleaned: DataFrame | None
    staging: Staging

    def __enter__(self) -> MatchResult:
        return self

    def __exit__(self, error: type | None, *_: object) -> None:
        if error is None:
            self.staging.drop()


def match(
    config: MatchConfig,
    source: DataFrame,
    people: DataFrame,
    previous: DataFrame | None = None,
    cleaned: DataFrame | None = None,
    run_date: date | None = None,
    index: DataFrame | None = None,
) -> MatchResult:
    """The whole job over one source. Results that several later steps read are staged.

    Copies of a source row are reduced to one first. Cleaning runs on all rows at
    once, partition by partition; it needs no chunks. A stored ``person_index`` of the
    person file saves making it again.
    """
    staging = Staging(source.sparkSession, "match")
    mapped = mapped_columns(config, source).where(F.col(config.key).isNotNull()).distinct()
    universe = staging.table(mapped_columns(config, rematch_universe(config, mapped, previous)), "stage_0_input")
    if index is None:
        index = staging.table(person_index(config, people), "person_index")

    def one_round(rows: DataFrame, name: str) -> DataFrame:
        found = match_candidates(config, rows, index, keep_unmatched=False, carry=True)
        return staging.table(best_match(config, found, rows, run_date=run_date), name)

    first = one_round(universe, "stage_2_fullmatch")
    if not config.enable_cleaning:
        return MatchResult(merge_matches(config, first, previous), None, staging)

    left_over = staging.table(cleaning_universe(config, universe, first, cleaned), "stage_3_rematch")
    tidy = staging.table(
        coalesce_cleaned(config, standardise_addresses(config, left_over), infer_names(config, left_over)),
        "stage_5_coalesce",
    )
    second = one_round(tidy, "stage_7_fullmatch")
    return MatchResult(merge_matches(config, first, second, previous), cleaning_history(tidy, run_date), staging)


def match_job(
    config: MatchConfig,
    source: DataFrame,
    people: DataFrame,
    output: VersionedTable,
    history: VersionedTable,
    run_date: date | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """One run of a recurring job: published matches in ``output``, cleaned rows in ``history``.

    Either table may not exist yet. With the primary key as their key, neither is
    shuffled when the next run joins it. The output is a new version, current once it is
    whole; it is published first: should the run end before the history is written, the
    next one cleans and matches the same rows again.
    """
    with match(config, source, people, output.read(), history.read(), run_date, index) as result:
        published = result.staging.table(result.matches, "all_matches")
        written = output.publish(published)
        if result.cleaned is not None:
            history.append(result.cleaned)
        return written
