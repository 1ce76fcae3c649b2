"""Staging frames to the research data model. Every mapper keeps the row count of its input."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import joins, vocab
from clinlake.operators.joins import Lookup


# Vocabularies and domain of each concept lookup; None stands for all.
LOOKUPS = {
    "gender": (["Gender"], None),
    "race": (["Race"], None),
    "condition": (config.CONDITION_VOCABULARIES, "Condition"),
    "drug": (config.DRUG_VOCABULARIES, "Drug"),
    "measurement": (config.OBSERVATION_VOCABULARIES, "Measurement"),
    "observation": (config.OBSERVATION_VOCABULARIES, None),
    "value": (None, None),
}


def build_lookups(concept: DataFrame) -> dict[str, Lookup]:
    """The lookups of a build, each with one row per key.

    One narrow pass over the concepts measures all of them. Those within the broadcast bounds
    are marked small, the others will be joined by a shuffle.
    """
    measures = []
    for name, (vocabularies, domain) in LOOKUPS.items():
        member = F.coalesce(vocab.is_member(vocabularies, domain), F.lit(False))
        width = F.lit(32) + F.coalesce(F.octet_length("concept_code"), F.lit(0))
        if name == "gender":
            width = width + F.coalesce(F.octet_length("concept_name"), F.lit(0))
        measures += [
            F.count_if(member).alias(f"{name}_rows"),
            F.coalesce(F.sum(F.when(member, width.cast("bigint"))), F.lit(0)).alias(f"{name}_bytes"),
        ]
    found = concept.agg(*measures).first()

    lookups = {}
    for name, (vocabularies, domain) in LOOKUPS.items():
        subset = vocab.concept_subset(concept, vocabularies, domain)
        # A code is held under its vocabulary and under any: twice the measured rows.
        small = (
            2 * found[f"{name}_rows"] <= config.BROADCAST_MAX_ROWS
            and 2 * found[f"{name}_bytes"] <= config.BROADCAST_MAX_BYTES
        )
        if name == "gender":
            lookups[name] = Lookup(vocab.gender_keys(subset), ("gender_word",), small)
        elif name == "race":
            lookups[name] = Lookup(vocab.race_keys(subset), ("race_word",), small)
        else:
            keys = vocab.code_keys(subset) if vocabularies is None else vocab.concept_keys(subset)
            lookups[name] = Lookup(keys, ("vocabulary", "concept_code"), small)
    return lookups


def _audit(transformed_at: Column | None) -> list[Column]:
    now = F.current_timestamp() if transformed_at is None else transformed_at
    return [F.col("_lineage_id"), F.col("_source_file"), F.col("_loaded_at"), now.alias("_transformed_at")]


def _nulls(type_name: str, *names: str) -> list[Column]:
    return [X.null_of(type_name).alias(n) for n in names]


def omop_person(
    patient: DataFrame, gender: Lookup, race: Lookup, transformed_at: Column | None = None
) -> DataFrame:
    mapped = joins.map_race(joins.map_gender(patient, gender), race)
    return mapped.select(
        X.surrogate_key(F.col("fhir_patient_id")).alias("person_id"),
        "gender_concept_id",
        F.year("birth_date").alias("year_of_birth"),
        F.month("birth_date").alias("month_of_birth"),
        F.dayofmonth("birth_date").alias("day_of_birth"),
        "race_concept_id",
        X.bigint(config.UNMAPPED).alias("ethnicity_concept_id"),
        F.col("gender_code").alias("gender_source_value"),
        F.col("race_code").alias("race_source_value"),
        X.bigint(config.UNMAPPED).alias("race_source_concept_id"),
        F.coalesce("abha_id", "fhir_patient_id").alias("person_source_value"),
        *_nulls("bigint", "provider_id", "care_site_id"),
        X.place_key(F.col("state"), F.col("postal_code")).alias("location_id"),
        *_audit(transformed_at),
    )


def omop_visit_occurrence(
    encounter: DataFrame, persons: Lookup, transformed_at: Column | None = None
) -> DataFrame:
    """Visits. Ids of care site and provider are made of the registry codes in the row, so no join is needed."""
    start_date = F.col("period_start").cast("date")
    # A staging table of before has no practitioners.
    practitioner = F.col("practitioner_code") if "practitioner_code" in encounter.columns else X.null_of("string")
    return joins.resolve_person(encounter, persons).select(
        X.surrogate_key(F.col("fhir_encounter_id")).alias("visit_occurrence_id"),
        "person_id",
        joins.map_visit_type(F.col("encounter_class")).alias("visit_type_concept_id"),
        start_date.alias("visit_start_date"),
        F.col("period_end").cast("date").alias("visit_end_date"),
        F.col("period_start").alias("visit_start_datetime"),
        F.col("period_end").alias("visit_end_datetime"),
        X.bigint(config.VISIT_CONCEPT).alias("visit_concept_id"),
        X.surrogate_key(practitioner).alias("provider_id"),
        X.surrogate_key(F.col("hfr_facility_code")).alias("care_site_id"),
        *_nulls(
            "bigint", "admitting_concept_id", "admitting_source_concept_id",
            "discharge_to_concept_id", "preceding_visit_occurrence_id",
        ),
        "duration_minutes",
        F.col("encounter_class").alias("visit_source_value"),
        X.bigint(config.UNMAPPED).alias("visit_source_concept_id"),
        "encounter_type_code",
        "encounter_type_display",
        "hfr_facility_code",
        "facility_name",
        F.year(start_date).alias("year_start"),
        *_audit(transformed_at),
    )


def omop_condition_occurrence(
    condition: DataFrame, persons: Lookup, concepts: Lookup, transformed_at: Column | None = None
) -> DataFrame:
    mapped = joins.map_concept(
        joins.resolve_person(condition, persons),
        concepts, "condition_source_code", "condition_concept_id", system="condition_source_vocabulary",
    )
    return mapped.select(
        X.surrogate_key(F.col("fhir_condition_id")).alias("condition_occurrence_id"),
        "person_id",
        "condition_concept_id",
        "condition_start_date",
        *_nulls("date", "condition_end_date"),
        F.col("clinical_status").alias("condition_status_source_value"),
        X.bigint(config.CONDITION_TYPE).alias("condition_type_concept_id"),
        "condition_source_code",
        "condition_source_vocabulary",
        "condition_source_display",
        X.bigint(config.UNMAPPED).alias("condition_source_concept_id"),
        F.when(F.col("clinical_status") == "resolved", "Resolved").alias("stop_reason"),
        F.year("condition_start_date").alias("year_start"),
        *_audit(transformed_at),
    )


def omop_drug_exposure(
    medication: DataFrame, persons: Lookup, concepts: Lookup, transformed_at: Column | None = None
) -> DataFrame:
    mapped = joins.map_concept(
        joins.resolve_person(medication, persons),
        concepts, "drug_source_code", "drug_concept_id", system="drug_source_vocabulary",
    )
    ended = F.col("status").isin("stopped", "cancelled")
    return mapped.select(
        X.surrogate_key(F.col("fhir_medication_request_id")).alias("drug_exposure_id"),
        "person_id",
        "drug_concept_id",
        "drug_exposure_start_date",
        F.when(ended, F.col("drug_exposure_start_date")).alias("drug_exposure_end_date"),
        X.bigint(config.DRUG_TYPE).alias("drug_type_concept_id"),
        F.col("dose_value").alias("quantity"),
        "dose_unit",
        *_nulls("int", "days_supply"),
        *_nulls("bigint", "route_concept_id"),
        F.col("doses_per_day").alias("effective_drug_dose"),
        F.col("dose_unit").alias("dose_unit_source_value"),
        "drug_source_code",
        "drug_source_vocabulary",
        "drug_source_display",
        X.bigint(config.UNMAPPED).alias("drug_source_concept_id"),
        F.when(ended, F.initcap("status")).alias("stop_reason"),
        *_nulls("int", "refills"),
        *_nulls("string", "lot_number"),
        *_nulls("bigint", "visit_occurrence_id", "visit_detail_id", "provider_id"),
        F.year("drug_exposure_start_date").alias("year_start"),
        *_audit(transformed_at),
    )


def is_measurement() -> Column:
    """Observations with a number."""
    return F.col("value_quantity").isNotNull()


def is_observation() -> Column:
    """Observations with a text, a code or no number. One with a number and a code is both."""
    return F.col("value_string").isNotNull() | F.col("value_concept_code").isNotNull() | F.col("value_quantity").isNull()


def omop_measurement(
    observation: DataFrame, persons: Lookup, visits: Lookup, concepts: Lookup, transformed_at: Column | None = None
) -> DataFrame:
    facts = joins.resolve_visit(joins.resolve_person(observation.filter(is_measurement()), persons), visits)
    mapped = joins.map_concept(
        facts, concepts, "observation_source_code", "measurement_concept_id", system="observation_source_vocabulary"
    )
    date = F.col("effective_datetime").cast("date")
    return mapped.select(
        X.surrogate_key(F.col("fhir_observation_id")).alias("measurement_id"),
        "person_id",
        "visit_occurrence_id",
        *_nulls("bigint", "visit_detail_id"),
        "measurement_concept_id",
        date.alias("measurement_date"),
        F.col("effective_datetime").alias("measurement_datetime"),
        X.bigint(config.OBSERVATION_TYPE).alias("measurement_type_concept_id"),
        F.col("value_quantity").alias("value_as_number"),
        *_nulls("bigint", "value_as_concept_id"),
        X.bigint(config.UNMAPPED).alias("unit_concept_id"),
        F.col("value_unit").alias("unit_source_display"),
        F.col("value_unit_code").alias("unit_source_value"),
        "range_low",
        "range_high",
        *_nulls("bigint", "provider_id"),
        *_nulls("string", "value_source_value"),
        "observation_source_code",
        "observation_source_vocabulary",
        "observation_source_display",
        X.bigint(config.UNMAPPED).alias("observation_source_concept_id"),
        X.bigint(config.UNMAPPED).alias("observation_category_concept_id"),
        F.col("category").alias("observation_category_source_value"),
        F.year(date).alias("year_start"),
        *_audit(transformed_at),
    )


def omop_observation(
    observation: DataFrame,
    persons: Lookup,
    visits: Lookup,
    concepts: Lookup,
    values: Lookup,
    transformed_at: Column | None = None,
) -> DataFrame:
    facts = joins.resolve_visit(joins.resolve_person(observation.filter(is_observation()), persons), visits)
    mapped = joins.map_concept(
        facts, concepts, "observation_source_code", "observation_concept_id", system="observation_source_vocabulary"
    )
    mapped = joins.map_concept(mapped, values, "value_concept_code", "value_as_concept_id")
    date = F.col("effective_datetime").cast("date")
    return mapped.select(
        X.surrogate_key(F.col("fhir_observation_id")).alias("observation_id"),
        "person_id",
        "visit_occurrence_id",
        *_nulls("bigint", "visit_detail_id"),
        "observation_concept_id",
        date.alias("observation_date"),
        F.col("effective_datetime").alias("observation_datetime"),
        X.bigint(config.OBSERVATION_TYPE).alias("observation_type_concept_id"),
        F.when(F.col("value_concept_code").isNull(), F.col("value_quantity")).alias("value_as_number"),
        "value_as_concept_id",
        F.col("value_string").alias("value_as_string"),
        *_nulls("bigint", "qualifier_concept_id", "unit_concept_id"),
        *_nulls("string", "unit_source_value"),
        *_nulls("bigint", "provider_id"),
        *_nulls("string", "value_source_value"),
        "observation_source_code",
        "observation_source_vocabulary",
        "observation_source_display",
        X.bigint(config.UNMAPPED).alias("observation_source_concept_id"),
        X.bigint(config.UNMAPPED).alias("obs_event_field_concept_id"),
        F.col("category").alias("obs_event_field_source_value"),
        F.year(date).alias("year_start"),
        *_audit(transformed_at),
    )


# Record id column of each gold table.
RECORD_IDS = {
    "omop_person": "person_id",
    "omop_visit_occurrence": "visit_occurrence_id",
    "omop_condition_occurrence": "condition_occurrence_id",
    "omop_drug_exposure": "drug_exposure_id",
    "omop_measurement": "measurement_id",
    "omop_observation": "observation_id",
}


def lineage_audit(gold: dict[str, DataFrame]) -> DataFrame:
    """Every gold record with the lineage id and file it came from."""

    def part(table: str) -> DataFrame:
        source = F.col("person_source_value") if table == "omop_person" else X.null_of("string")
        return gold[table].select(
            F.lit(table.removeprefix("omop_")).alias("omop_table"),
            "_lineage_id",
            F.col(RECORD_IDS[table]).cast("string").alias("record_id"),
            source.alias("fhir_resource_id"),
            "_source_file",
            "_loaded_at",
            "_transformed_at",
        )

    return reduce(DataFrame.unionByName, [part(t) for t in RECORD_IDS if t in gold])


def lineage_statement(table_name: Callable[[str], str]) -> str:
    """The same audit as a statement over stored tables, for a view that outlives the session."""
    parts = []
    for table, record_id in RECORD_IDS.items():
        source = "person_source_value" if table == "omop_person" else "CAST(NULL AS STRING)"
        parts.append(
            f"SELECT '{table.removeprefix('omop_')}' AS omop_table, _lineage_id, CAST({record_id} AS STRING) AS record_id, "
            f"{source} AS fhir_resource_id, _source_file, _loaded_at, _transformed_at FROM {table_name(table)}"
        )
    return " UNION ALL ".join(parts)


def records_per_file(audit: DataFrame) -> DataFrame:
    """The audit with the number of gold records that came of the same file; without rows that name none.

    One shuffle of the audit's columns. A bundle file is one task's work already where it is read, and so are its records here.
    """
    named = audit.filter(F.col("_source_file").isNotNull())
    return named.withColumn("records", F.count("*").over(Window.partitionBy("_source_file")))


def trace_lineage(audit: DataFrame, lineage_id: str | None = None, source_file: str | None = None) -> DataFrame:
    """Gold records of one resource (lineage id) or of one bundle (file)."""
    if lineage_id is not None:
        audit = audit.filter(F.col("_lineage_id") == lineage_id)
    if source_file is not None:
        audit = audit.filter(F.col("_source_file") == source_file)
    return audit
