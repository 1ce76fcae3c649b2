"""Lookup joins that keep every fact row exactly once and stand up to hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import vocab


def fits_broadcast(
    df: DataFrame, max_rows: int = config.BROADCAST_MAX_ROWS, max_bytes: int = config.BROADCAST_MAX_BYTES
) -> bool:
    """Whether ``df`` is counted below both bounds. Each task sends one row of sums, whatever the size."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    width = sum(texts, F.lit(16 * len(df.columns)))
    found = df.agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return found["n"] <= max_rows and (found["b"] or 0) <= max_bytes


def own_shuffle(key: Column) -> Column:
    """A text of the key that the optimizer takes for another column.

    A side that was aggregated by the key is already partitioned by it and would not be
    shuffled again for a join. Adaptive execution splits a hot partition only where both
    sides of the join read a shuffle made for it, so joining on this text keeps that open.
    """
    return F.concat(key.cast("string"), F.lit(""))


#: Bytes of an id and its key in a crosswalk, as ``fits_broadcast`` measures them, for ids of up to 24 bytes.
CROSSWALK_ROW = 56


def not_broadcast(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent to the driver.

    The optimizer broadcasts by an estimate, which it scales down with every projection: nine million ids taken from
    wide JSON count as a few megabytes. A merge join has no such bound, and hot keys of it are split.
    """
    return df.hint("merge")


@dataclass(frozen=True)
class Lookup:
    """A frame with at most one row per ``key``; ``small`` when counted below the broadcast bounds, shuffled otherwise."""

    df: DataFrame
    key: tuple[str, ...]
    small: bool = False


def left_lookup(facts: DataFrame, lookup: Lookup, fact_key: Sequence[Column], spread: Column) -> DataFrame:
    """Left join that adds the lookup's other columns to every fact row.

    A small lookup is broadcast, so the facts stay where they are. Otherwise both sides are
    shuffled on the key, and two things keep one task from getting a large share of the facts:

    * facts with a null key match nothing, so they get a key of their own taken from
      ``spread`` and are dealt over all tasks;
    * the lookup is shuffled for this join alone, so that adaptive execution can split the
      partition of a hot key.

    The keys themselves are compared too: by them the optimizer knows that no fact is doubled, and leaves the join out
    where none of the lookup's columns is used.
    """
    names = [f"_k{i}" for i in range(len(fact_key))]
    plain = [f"_p{i}" for i in range(len(fact_key))]
    values = [c for c in lookup.df.columns if c not in lookup.key]
    if lookup.small:
        keyed_facts = facts.withColumns(dict(zip(names, fact_key)))
        keyed = F.broadcast(lookup.df.select(*[F.col(k).alias(n) for n, k in zip(names, lookup.key)], *values))
    else:
        stray = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string"))
        keyed_facts = facts.withColumns({n: F.coalesce(k, stray) for n, k in zip(names, fact_key)} | dict(zip(plain, fact_key)))
        own = [own_shuffle(F.col(k)).alias(n) for n, k in zip(names, lookup.key)]
        keyed = not_broadcast(lookup.df.select(*own, *[F.col(k).alias(p) for p, k in zip(plain, lookup.key)], *values))
        names = names + plain
    return keyed_facts.join(keyed, names, "left").drop(*names)


# -- facts to persons and visits ---------------------------------------------------------

def _few_ids(at_most: int | None) -> bool:
    """Whether a crosswalk of so many ids is within the broadcast bounds; not if nobody has counted them."""
    bound = min(config.BROADCAST_MAX_ROWS, config.BROADCAST_MAX_BYTES // CROSSWALK_ROW)
    return at_most is not None and at_most <= bound


def person_crosswalk(silver_patient: DataFrame, at_most: int | None = None) -> Lookup:
    """Source patient id to person id, one row per patient, of whom there are ``at_most`` so many.

    Facts name the patient's resource id. ``person_source_value`` is the national id where
    there is one, so joining on it would lose every enrolled patient.
    """
    ids = silver_patient.filter(F.col("fhir_patient_id").isNotNull()).select("fhir_patient_id").distinct()
    persons = ids.withColumn("person_id", X.surrogate_key(F.col("fhir_patient_id")))
    return Lookup(persons, ("fhir_patient_id",), _few_ids(at_most))


def visit_crosswalk(silver_encounter: DataFrame, at_most: int | None = None) -> Lookup:
    """Source encounter id to visit id, one row per encounter, of which there are ``at_most`` so many."""
    ids = silver_encounter.filter(F.col("fhir_encounter_id").isNotNull()).select("fhir_encounter_id").distinct()
    visits = ids.withColumn("visit_occurrence_id", X.surrogate_key(F.col("fhir_encounter_id")))
    return Lookup(visits, ("fhir_encounter_id",), _few_ids(at_most))


def resolve_person(facts: DataFrame, persons: Lookup) -> DataFrame:
    """Adds ``person_id``; null where the patient is unknown."""
    return left_lookup(facts, persons, [F.col("fhir_patient_id")], F.col("_lineage_id"))


def resolve_visit(facts: DataFrame, visits: Lookup) -> DataFrame:
    """Adds ``visit_occurrence_id``; 0 where the encounter is absent or unknown."""
    joined = left_lookup(facts, visits, [F.col("fhir_encounter_id")], F.col("_lineage_id"))
    return joined.withColumn("visit_occurrence_id", F.coalesce("visit_occurrence_id", X.bigint(config.UNMAPPED)))


# -- facts to concepts -------------------------------------------------------------------

def map_visit_type(encounter_class: Column) -> Column:
    """Visit type of an encounter class; 0 for an unknown or missing one. Four values need no join."""
    pairs = [x for code, concept in config.VISIT_TYPE_BY_CLASS.items() for x in (F.lit(code), X.bigint(concept))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), encounter_class), X.bigint(config.UNMAPPED))


def map_concept(
    facts: DataFrame, lookup: Lookup, code: str, out: str, system: str | None = None
) -> DataFrame:
    """Adds concept id ``out`` of a source code; 0 where there is none.

    A code whose system names a vocabulary is looked up there alone; the same code may mean
    something else in another one. Without a known system (or ``system=None``) the code is
    looked up in all vocabularies of the lookup.
    """
    vocabulary = F.lit(vocab.ANY)
    if system is not None:
        vocabulary = F.coalesce(X.vocabulary_of(F.col(system)), vocabulary)
    joined = left_lookup(facts, lookup, [vocabulary, F.col(code)], F.col("_lineage_id"))
    return joined.withColumnRenamed("concept_id", out).withColumn(out, F.coalesce(out, X.bigint(config.UNMAPPED)))


def map_gender(patients: DataFrame, lookup: Lookup) -> DataFrame:
    """Adds ``gender_concept_id`` by a case-insensitive match of the gender."""
    joined = left_lookup(patients, lookup, [F.lower("gender_code")], F.col("_lineage_id"))
    return joined.withColumn("gender_concept_id", F.coalesce("gender_concept_id", X.bigint(config.UNMAPPED)))


def map_race(patients: DataFrame, lookup: Lookup) -> DataFrame:
    """Adds ``race_concept_id`` by an exact match of the race code."""
    joined = left_lookup(patients, lookup, [F.col("race_code")], F.col("_lineage_id"))
    return joined.withColumn("race_concept_id", F.coalesce("race_concept_id", X.bigint(config.UNMAPPED)))


# -- persons to their records ------------------------------------------------------------

def person_rollup(person: DataFrame, visit: DataFrame, condition: DataFrame, drug: DataFrame) -> DataFrame:
    """Distinct conditions and drugs of the person, per person and visit.

    Joining all four frames first would multiply a person's visits, conditions and drugs.
    Here conditions and drugs are counted per person before any join. The visits meet these
    counts in one join, on a key shuffled for it alone, so a person with very many visits is
    split over tasks. Every person joins it with a row without a visit too, which is dropped
    where there are visits, so the counts are made once.
    """
    counts = person.select("person_id").distinct()
    alone = counts.select("person_id", X.null_of("bigint").alias("visit_occurrence_id"))
    for df, key, name in [
        (condition, "condition_occurrence_id", "condition_count"),
        (drug, "drug_exposure_id", "drug_count"),
    ]:
        per_person = df.groupBy("person_id").agg(F.countDistinct(key).alias(name))
        counts = counts.join(not_broadcast(per_person), "person_id", "left").withColumn(name, F.coalesce(name, X.bigint(0)))
    visits = visit.select("person_id", "visit_occurrence_id").distinct()
    visited = visits.select("person_id").distinct().withColumn("_visited", F.lit(True))
    counts = counts.join(not_broadcast(visited), "person_id", "left")
    key = own_shuffle(F.col("person_id"))
    # A person without an id has no visits, but is kept.
    named = F.coalesce(key, F.lit("\u0000"))
    keyed = counts.withColumn("_k", named).drop("person_id")
    rows = visits.select("*", key.alias("_k"), F.lit(False).alias("_alone")).unionByName(
        alone.select("*", named.alias("_k"), F.lit(True).alias("_alone"))
    )
    joined = rows.join(not_broadcast(keyed), "_k")
    return joined.filter(~F.col("_alone") | F.col("_visited").isNull()).drop("_k", "_alone", "_visited")
