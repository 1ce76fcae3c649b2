"""Analytical reports over gold tables, one function each.

Reports with a limit are top-k reports or samples by nature. Their order ends in a key, so
that the same rows come out on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.functions import exprs as X
from clinlake.operators import joins
from clinlake.operators.bronze import route


def counts_by(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows per combination of the columns, most frequent first."""
    counted = df.groupBy(*columns).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *columns)
    return counted if limit is None else counted.limit(limit)


def _mapped(column: str) -> Column:
    return F.count_if(F.col(column) > 0)


def _coverage(column: str) -> Column:
    return X.percent(_mapped(column), F.count("*")).alias("coverage_pct")


# -- bronze -----------------------------------------------------------------------------

def bronze_type_distribution(bronze: DataFrame) -> DataFrame:
    counted = bronze.groupBy("resource_type").agg(F.count("*").alias("record_count"))
    return counted.orderBy(F.desc("record_count"), "resource_type")


def patient_spot_check(bronze: DataFrame, limit: int = 1) -> DataFrame:
    """Id, birth date, gender and identifier systems of some raw patients."""
    patients = route(bronze, "Patient").orderBy("fhir_resource_id", "_lineage_id").limit(limit)
    identifiers = X.parse_json_array(X.json_path("resource_json", "$.identifier"))
    return patients.select(
        X.json_path("resource_json", "$.id").alias("patient_id"),
        X.json_path("resource_json", "$.birthDate").alias("birth_date"),
        X.json_path("resource_json", "$.gender").alias("gender"),
        F.array_join(F.transform(identifiers, lambda i: i["system"]), ", ").alias("identifier_systems"),
    )


# -- persons ------------------------------------------------------------------------------

def person_stats(person: DataFrame) -> DataFrame:
    return person.agg(
        F.count("*").alias("total_persons"),
        F.countDistinct("person_id").alias("unique_persons"),
        _mapped("gender_concept_id").alias("persons_with_gender"),
        _mapped("race_concept_id").alias("persons_with_race"),
        F.count("year_of_birth").alias("persons_with_birth_year"),
    )


def gender_coverage(person: DataFrame) -> DataFrame:
    return counts_by(person, ["gender_source_value", "gender_concept_id"])


def race_coverage(person: DataFrame) -> DataFrame:
    known = F.col("race_source_value").isNotNull() | (F.col("race_concept_id") > 0)
    return counts_by(person.filter(known), ["race_source_value", "race_concept_id"])


def person_sample(person: DataFrame, limit: int = 10) -> DataFrame:
    columns = ["person_id", "person_source_value", "year_of_birth", "gender_source_value"]
    return person.select(*columns).orderBy("person_source_value", "person_id").limit(limit)


# -- conditions ---------------------------------------------------------------------------

def condition_stats(condition: DataFrame) -> DataFrame:
    concept = "condition_concept_id"
    return condition.agg(
        F.count("*").alias("total_conditions"),
        _mapped(concept).alias("mapped_conditions"),
        _coverage(concept),
        F.count_if(F.col(concept) == 0).alias("unmapped_conditions"),
    )


def top_conditions(condition: DataFrame, limit: int | None = 10) -> DataFrame:
    mapped = condition.filter(F.col("condition_concept_id") > 0)
    return counts_by(mapped, ["condition_source_code", "condition_source_display", "condition_concept_id"], limit)


def condition_status(condition: DataFrame) -> DataFrame:
    return counts_by(condition, ["condition_status_source_value"])


def top_unmapped_conditions(condition: DataFrame, limit: int | None = 10) -> DataFrame:
    unmapped = condition.filter(F.col("condition_concept_id") == 0)
    return counts_by(unmapped, ["condition_source_code", "condition_source_display"], limit)


# -- drugs --------------------------------------------------------------------------------

def drug_stats(drug: DataFrame) -> DataFrame:
    return drug.agg(
        F.count("*").alias("total_drug_exposures"),
        _mapped("drug_concept_id").alias("mapped_drugs"),
        _coverage("drug_concept_id"),
        F.count_if(F.col("drug_concept_id") == 0).alias("unmapped_drugs"),
    )


def top_drugs(drug: DataFrame, limit: int | None = 10) -> DataFrame:
    mapped = drug.filter(F.col("drug_concept_id") > 0)
    return counts_by(mapped, ["drug_source_code", "drug_source_display", "drug_concept_id"], limit)


def stop_reasons(drug: DataFrame) -> DataFrame:
    return counts_by(drug, ["stop_reason"])


def dosage_groups(drug: DataFrame, limit: int | None = 10) -> DataFrame:
    dosed = drug.filter(F.col("quantity").isNotNull())
    columns = ["drug_source_display", "quantity", "dose_unit_source_value", "effective_drug_dose"]
    return counts_by(dosed, columns, limit)


def top_unmapped_drugs(drug: DataFrame, limit: int | None = 10) -> DataFrame:
    return counts_by(drug.filter(F.col("drug_concept_id") == 0), ["drug_source_code", "drug_source_display"], limit)


# -- measurements and observations ----------------------------------------------------------

def measurement_stats(measurement: DataFrame) -> DataFrame:
    return measurement.agg(
        F.count("*").alias("total_measurements"),
        _mapped("measurement_concept_id").alias("mapped_measurements"),
        _coverage("measurement_concept_id"),
        F.countDistinct("observation_source_code").alias("unique_measurement_codes"),
    )


def top_measurements(measurement: DataFrame, limit: int | None = 10) -> DataFrame:
    columns = ["observation_source_code", "observation_source_display", "unit_source_value"]
    mapped = measurement.filter(F.col("measurement_concept_id") > 0)
    counted = (
        mapped.groupBy(*columns)
        .agg(F.count("*").alias("count"), X.exact_avg(F.col("value_as_number"), 2).alias("avg_value"))
        .orderBy(F.desc("count"), *columns)
    )
    return counted if limit is None else counted.limit(limit)


def observation_stats(observation: DataFrame) -> DataFrame:
    return observation.agg(
        F.count("*").alias("total_observations"),
        _mapped("observation_concept_id").alias("mapped_observations"),
        _coverage("observation_concept_id"),
        F.count("value_as_string").alias("text_observations"),
        _mapped("value_as_concept_id").alias("coded_observations"),
    )


_VALUE_COLUMNS = ["observation_source_code", "observation_source_display", "value_as_string"]


def top_coded_observations(observation: DataFrame, limit: int | None = 10) -> DataFrame:
    return counts_by(observation.filter(F.col("value_as_concept_id") > 0), _VALUE_COLUMNS, limit)


def top_text_observations(observation: DataFrame, limit: int | None = 10) -> DataFrame:
    return counts_by(observation.filter(F.col("value_as_string").isNotNull()), _VALUE_COLUMNS, limit)


# -- visits ---------------------------------------------------------------------------------

def visit_stats(visit: DataFrame) -> DataFrame:
    return visit.agg(
        F.count("*").alias("total_visits"),
        F.countDistinct("person_id").alias("unique_persons"),
        F.round(F.avg("duration_minutes"), 1).alias("avg_duration_minutes"),
        _mapped("visit_type_concept_id").alias("mapped_visit_types"),
    )


def visit_types(visit: DataFrame) -> DataFrame:
    renamed = visit.withColumnRenamed("visit_source_value", "encounter_class")
    return counts_by(renamed, ["encounter_class", "visit_type_concept_id"])


def visit_dates(visit: DataFrame, limit: int | None = 20) -> DataFrame:
    """Start, end and the days between them in minutes."""
    start, end = F.col("visit_start_date"), F.col("visit_end_date")
    listed = visit.orderBy("visit_start_datetime", "_lineage_id")
    return (listed if limit is None else listed.limit(limit)).select(
        "visit_occurrence_id",
        start.cast("string").alias("start_date"),
        end.cast("string").alias("end_date"),
        X.days_as_minutes(start, end).alias("duration_minutes"),
        "encounter_type_display",
    )


def facility_visits(visit: DataFrame, limit: int | None = 10) -> DataFrame:
    coded = visit.filter(F.col("hfr_facility_code").isNotNull())
    counted = (
        coded.groupBy("hfr_facility_code", "facility_name")
        .agg(F.count("*").alias("visit_count"))
        .orderBy(F.desc("visit_count"), "hfr_facility_code", "facility_name")
    )
    return counted if limit is None else counted.limit(limit)


def visit_record_counts(
    person: DataFrame, visit: DataFrame, condition: DataFrame, drug: DataFrame, limit: int | None = 10
) -> DataFrame:
    """Conditions and drugs of the person, per person and visit."""
    rollup = joins.person_rollup(person, visit, condition, drug)
    return rollup if limit is None else rollup.orderBy("person_id", "visit_occurrence_id").limit(limit)


# -- across tables ----------------------------------------------------------------------------

def mapped_samples(condition: DataFrame, drug: DataFrame, measurement: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent mapped codes of three tables."""
    parts = [
        ("condition", top_conditions(condition, limit), "condition_source_code", "condition_source_display", "condition_concept_id"),
        ("drug", top_drugs(drug, limit), "drug_source_code", "drug_source_display", "drug_concept_id"),
        (
            "measurement",
            counts_by(
                measurement.filter(F.col("measurement_concept_id") > 0),
                ["observation_source_code", "observation_source_display", "measurement_concept_id"],
                limit,
            ),
            "observation_source_code", "observation_source_display", "measurement_concept_id",
        ),
    ]
    frames = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(code).alias("source_code"),
            F.col(display).alias("source_display"),
            F.col(concept).alias("concept_id"),
            "count",
        )
        for kind, df, code, display, concept in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
