"""Quality gates and coverage figures. A gate that finds nothing returns no rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators.gold import RECORD_IDS
from clinlake.operators.joins import not_broadcast

CONCEPT_COLUMNS = {
    "omop_condition_occurrence": "condition_concept_id",
    "omop_drug_exposure": "drug_concept_id",
    "omop_measurement": "measurement_concept_id",
    "omop_observation": "observation_concept_id",
}


class QualityError(Exception):
    """A gate found rows that must not exist."""


def require_none(violations: DataFrame, gate: str) -> None:
    """Raise if there is a violation; looks at one row only."""
    first = violations.take(1)
    if first:
        raise QualityError(f"{gate}: {first[0].asDict()}")


# -- bronze ----------------------------------------------------------------------------

def bronze_nulls(bronze: DataFrame) -> DataFrame:
    """Rows, and nulls in the routing and lineage columns. Type and lineage must have none."""
    return bronze.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("resource_type").isNull()).alias("null_resource_type"),
        F.count_if(F.col("fhir_resource_id").isNull()).alias("null_fhir_resource_id"),
        F.count_if(F.col("_lineage_id").isNull()).alias("null_lineage_id"),
    )


def check_bronze(bronze: DataFrame) -> None:
    broken = bronze_nulls(bronze).filter((F.col("null_resource_type") > 0) | (F.col("null_lineage_id") > 0))
    require_none(broken, "bronze_not_null")


def consent_count(bronze: DataFrame) -> DataFrame:
    consents = bronze.filter(F.lower("resource_type") == "consent")
    return consents.agg(F.count("*").alias("consent_count"))


# -- silver ------------------------------------------------------------------------------

def abha_coverage(patient: DataFrame) -> DataFrame:
    """Patients with and without a national health id."""
    present = F.col("abha_id").isNotNull()
    return patient.agg(
        F.count("*").alias("total_patients"),
        F.count_if(present).alias("with_abha"),
        F.count_if(~present).alias("without_abha"),
        X.percent(F.count_if(present), F.count("*")).alias("abha_coverage_pct"),
    )


def field_coverage(df: DataFrame, column: str, label: str) -> DataFrame:
    """How many rows carry a value in ``column``."""
    present = F.count_if(F.col(column).isNotNull())
    return df.agg(
        F.lit(label).alias("field"),
        present.alias("present"),
        F.count("*").alias("total"),
        X.percent(present, F.count("*")).alias("coverage_pct"),
    )


def hfr_coverage(encounter: DataFrame) -> DataFrame:
    """Encounters with a facility-registry code."""
    return field_coverage(encounter, "hfr_facility_code", "HFR Facility Code")


def abha_format(patient: DataFrame) -> DataFrame:
    """Per patient: the national id, its digits, and whether it has the form of one."""
    return patient.select(
        "fhir_patient_id",
        "abha_id",
        X.digit_count(F.col("abha_id")).alias("digit_count"),
        X.health_id_status(F.col("abha_id")).alias("abha_status"),
    )


def value_type_distribution(observation: DataFrame) -> DataFrame:
    kind = X.value_type(F.col("value_quantity"), F.col("value_concept_code"), F.col("value_string"))
    return (
        observation.groupBy(kind.alias("value_type"), "category")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value_type", "category")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""

    def one(name: str) -> DataFrame:
        columns = len(tables[name].columns)
        return tables[name].agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.lit(columns).alias("column_count")
        )

    return reduce(DataFrame.unionByName, [one(name) for name in tables])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and their total."""
    counts = table_counts(tables).select("table_name", "row_count")
    # The total is one more group of the same counts, so no table is read twice.
    name = F.when(F.grouping("table_name") == 1, "TOTAL").otherwise(F.col("table_name"))
    return counts.rollup("table_name").agg(name.alias("_name"), F.sum("row_count").alias("row_count")).select(
        F.col("_name").alias("table_name"), "row_count"
    )


# -- gold --------------------------------------------------------------------------------

def person_required(person: DataFrame) -> DataFrame:
    """Persons that lack a required value."""
    required = ["person_id", "gender_concept_id", "year_of_birth", "person_source_value"]
    return person.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required]))


def drug_dates_ordered(drug: DataFrame) -> DataFrame:
    """Exposures that end before they start."""
    end = F.col("drug_exposure_end_date")
    return drug.filter(end.isNotNull() & (F.col("drug_exposure_start_date") > end))


def condition_coverage(condition: DataFrame, minimum_pct: float = 50.0) -> DataFrame:
    """The coverage of condition concepts, as a row only while it is below the minimum."""
    mapped = F.count_if(F.col("condition_concept_id") > 0)
    stats = condition.agg(
        F.count("*").alias("total"),
        mapped.alias("mapped"),
        F.count_if(F.col("condition_concept_id") == 0).alias("unmapped"),
        X.percent(mapped, F.count("*")).alias("coverage_pct"),
    )
    return stats.filter(F.col("coverage_pct") < minimum_pct)


def mapping_rates(gold: dict[str, DataFrame]) -> DataFrame:
    """Mapped and all rows of each table with a concept."""

    def one(table: str) -> DataFrame:
        mapped = F.count_if(F.col(CONCEPT_COLUMNS[table]) > 0)
        return gold[table].agg(
            F.lit(table).alias("table_name"),
            mapped.alias("mapped"),
            F.count("*").alias("total"),
            F.coalesce(X.percent(mapped, F.count("*")), F.lit(0.0)).alias("pct"),
        )

    return reduce(DataFrame.unionByName, [one(t) for t in CONCEPT_COLUMNS if t in gold])


def person_source_uniqueness(person: DataFrame) -> DataFrame:
    distinct = F.countDistinct("person_source_value")
    return person.agg(
        F.count("*").alias("total_persons"),
        distinct.alias("unique_person_sources"),
        (F.count("*") - distinct).alias("duplicate_sources"),
    )


def abha_persons(person: DataFrame) -> DataFrame:
    """Persons known by a national health id."""
    keyed = person.filter(F.col("person_source_value").rlike(config.HEALTH_ID_PATTERN))
    return keyed.select("person_id", "person_source_value", "gender_source_value", "year_of_birth", "_source_file")


def abha_fallback(person: DataFrame) -> DataFrame:
    """Persons known by something else, and their distinct lineage ids."""
    others = person.filter(~F.col("person_source_value").rlike(config.HEALTH_ID_PATTERN))
    return others.agg(F.count("*").alias("fallback_persons"), F.countDistinct("_lineage_id").alias("unique_bundles"))


def unresolved_references(gold: dict[str, DataFrame]) -> DataFrame:
    """Per fact table: rows, rows without a person, rows whose person is not in the person table."""
    known = gold["omop_person"].select("person_id").distinct().withColumn("known", F.lit(True))
    
    def one(table: str) -> DataFrame:
        # Counted per person first, so a person with very many rows joins as one.
        per_person = gold[table].groupBy("person_id").agg(F.count("*").alias("n"))
        joined = per_person.join(not_broadcast(known), "person_id", "left")
        missing = F.col("person_id").isNull()
        dangling = ~missing & F.col("known").isNull()
        return joined.agg(
            F.lit(table).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("without_person"),
            F.coalesce(F.sum(F.when(dangling, F.col("n"))), F.lit(0)).alias("dangling"),
        )

    return reduce(DataFrame.unionByName, [one(t) for t in RECORD_IDS if t in gold and t != "omop_person"])
