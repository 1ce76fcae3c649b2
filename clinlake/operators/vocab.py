"""Vocabulary tables: loading filters, lookups with one row per key, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake import config

# Vocabulary name under which a code is found when its own vocabulary is not known.
ANY = "*"


def load_concept(concept: DataFrame, active_only: bool = False) -> DataFrame:
    """Standard concepts, and all of the vocabularies that may lack the standard flag."""
    keep = (F.col("standard_concept") == "S") | F.col("vocabulary_id").isin(config.UNSTANDARDIZED_VOCABULARIES)
    kept = concept.filter(keep)
    return kept.filter(_still_valid()) if active_only else kept


def load_relationship(relationship: DataFrame) -> DataFrame:
    """Relationships still valid."""
    return relationship.filter(_still_valid())


def _still_valid() -> Column:
    return F.col("valid_end_date") == F.lit(config.OPEN_END_DATE).cast("date")


def is_member(
    vocabularies: Sequence[str] | None = None, domain: str | None = None, standard_only: bool = True
) -> Column:
    """Condition for a concept of some vocabularies, of one domain, a standard one."""
    member = F.lit(True)
    if vocabularies is not None:
        member = member & F.col("vocabulary_id").isin(list(vocabularies))
    if domain is not None:
        member = member & (F.col("domain_id") == domain)
    if standard_only:
        member = member & (F.col("standard_concept") == "S")
    return member


def concept_subset(
    concept: DataFrame,
    vocabularies: Sequence[str] | None = None,
    domain: str | None = None,
    standard_only: bool = True,
) -> DataFrame:
    """Those concepts. The condition reaches the scan."""
    return concept.filter(is_member(vocabularies, domain, standard_only))


def lookup_vocabulary(vocabulary: Column) -> Column:
    """Vocabulary name used as lookup key."""
    out = vocabulary
    for name, alias in config.VOCABULARY_ALIAS.items():
        out = F.when(vocabulary == name, alias).otherwise(out)
    return out


def concept_keys(subset: DataFrame) -> DataFrame:
    """``(vocabulary, code)`` to the lowest concept id; each code also under ``ANY``.

    One row per key, so that a join with it never multiplies facts.
    """
    names = F.array(lookup_vocabulary(F.col("vocabulary_id")), F.lit(ANY))
    keyed = subset.select(F.explode(names).alias("vocabulary"), "concept_code", "concept_id")
    return keyed.groupBy("vocabulary", "concept_code").agg(F.min("concept_id").alias("concept_id"))


def code_keys(subset: DataFrame) -> DataFrame:
    """As ``concept_keys``, for codes without a vocabulary."""
    keys = subset.groupBy("concept_code").agg(F.min("concept_id").alias("concept_id"))
    return keys.select(F.lit(ANY).alias("vocabulary"), "concept_code", "concept_id")


def gender_keys(genders: DataFrame) -> DataFrame:
    """Gender word to concept id. Sources send words, vocabularies hold words or letters as
    codes: both the code and the name of a concept are keys."""
    words = F.array(F.lower("concept_code"), F.lower("concept_name"))
    keyed = genders.select(F.explode(words).alias("gender_word"), F.col("concept_id").alias("gender_concept_id"))
    return keyed.groupBy("gender_word").agg(F.min("gender_concept_id").alias("gender_concept_id"))


def race_keys(races: DataFrame) -> DataFrame:
    return races.groupBy(F.col("concept_code").alias("race_word")).agg(F.min("concept_id").alias("race_concept_id"))


def concept_fanout(concept: DataFrame, vocabularies: Sequence[str], domain: str | None = None) -> DataFrame:
    """Codes that more than one concept answers to: a plain join would repeat their facts."""
    subset = concept_subset(concept, vocabularies, domain)
    per_code = subset.groupBy("concept_code").agg(F.count("*").alias("concepts"))
    return per_code.filter(F.col("concepts") > 1)


def vocab_coverage(concept: DataFrame) -> DataFrame:
    """Concepts, standard concepts and domains per vocabulary, largest first."""
    return (
        concept.groupBy("vocabulary_id")
        .agg(
            F.count("*").alias("concept_count"),
            F.count_if(F.col("standard_concept") == "S").alias("standard_concepts"),
            F.countDistinct("domain_id").alias("domains"),
        )
        .orderBy(F.desc("concept_count"), "vocabulary_id")
    )


def missing_vocabularies(concept: DataFrame, required: Sequence[str] = config.REQUIRED_VOCABULARIES) -> DataFrame:
    """Required vocabularies of which no concept is loaded."""
    spark = concept.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in required])).alias("vocabulary_id"))
    have = concept.filter(F.col("vocabulary_id").isin(list(required))).select("vocabulary_id").distinct()
    return wanted.join(have, "vocabulary_id", "left_anti")


def vocab_sample(concept: DataFrame, vocabularies: Sequence[str], n: int | None = None, standard_only: bool = True) -> DataFrame:
    """Some concepts of the vocabularies, by id; all of them without ``n``."""
    subset = concept_subset(concept, vocabularies, standard_only=standard_only)
    sample = subset.select("concept_id", "concept_code", "concept_name", "domain_id").orderBy("concept_id")
    return sample if n is None else sample.limit(n)


def source_to_standard_edges(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """``(vocabulary, code)`` of any concept to every standard concept it maps to, one row each.

    Needs the concept table before ``load_concept``, which drops source concepts.
    """
    edges = relationship.filter(F.col("relationship_id") == "Maps to").select("concept_id_1", "concept_id_2")
    source = concept.select(
        lookup_vocabulary(F.col("vocabulary_id")).alias("vocabulary"), "concept_code", F.col("concept_id").alias("concept_id_1")
    )
    target = concept_subset(concept).select(F.col("concept_id").alias("concept_id_2"))
    return source.join(edges, "concept_id_1").join(target, "concept_id_2").select("vocabulary", "concept_code", "concept_id_2")


def source_to_standard_keys(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """``(vocabulary, code)`` to one standard concept it maps to, the one with the lowest id."""
    mapped = source_to_standard_edges(concept, relationship)
    return mapped.groupBy("vocabulary", "concept_code").agg(F.min("concept_id_2").alias("concept_id"))


def source_to_standard_targets(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """``(vocabulary, code)`` to all standard concepts it maps to, in the order of their ids: one row per code.

    A code has as many targets as the vocabulary gives it, however many facts carry it.
    """
    mapped = source_to_standard_edges(concept, relationship)
    targets = F.array_sort(F.collect_set("concept_id_2")).alias("targets")
    return mapped.groupBy("vocabulary", "concept_code").agg(targets)
