"""Raw resources to typed staging frames, one per resource type.

Each resource text is parsed once, by a struct type that names the wanted paths, instead of
once per path. A path that is absent or of another shape gives null in its own column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators.bronze import route

LINEAGE = ["_lineage_id", "_source_file", "_loaded_at"]

_CODINGS = "struct<coding:array<struct<system:string,code:string,display:string>>>"
_QUANTITY = "struct<value:string,unit:string,code:string>"
_IDENTIFIER = "struct<system:string,value:string>"
_REFERENCE = "struct<reference:string>"

_SHAPES = {
    "Patient": f"""
        id string, birthDate string, gender string,
        extension array<struct<url:string,extension:array<struct<url:string,valueCoding:struct<code:string>>>>>,
        address array<struct<state:string,postalCode:string>>, name array<struct<family:string>>,
        identifier array<{_IDENTIFIER}>, deceasedBoolean string, deceasedDateTime string""",
    "Condition": f"""
        id string, subject {_REFERENCE}, code {_CODINGS}, onsetDateTime string,
        onsetPeriod struct<start:string>, recordedDate string,
        clinicalStatus {_CODINGS}, verificationStatus {_CODINGS}""",
    "MedicationRequest": f"""
        id string, subject {_REFERENCE}, medicationCodeableConcept {_CODINGS},
        authoredOn string, status string, intent string,
        dosageInstruction array<struct<
            timing:struct<repeat:struct<frequency:string,period:string,periodUnit:string>>,
            doseAndRate:array<struct<doseQuantity:{_QUANTITY}>>>>""",
    "Observation": f"""
        id string, subject {_REFERENCE}, encounter {_REFERENCE}, status string,
        category array<{_CODINGS}>, code {_CODINGS},
        effectiveDateTime string, effectivePeriod struct<start:string>,
        valueQuantity {_QUANTITY}, valueCodeableConcept {_CODINGS}, valueString string,
        referenceRange array<struct<low:{_QUANTITY},high:{_QUANTITY}>>""",
    "Encounter": f"""
        id string, subject {_REFERENCE}, status string, class struct<code:string>,
        type array<{_CODINGS}>, period struct<start:string,end:string>,
        serviceProvider struct<display:string,identifier:{_IDENTIFIER}>,
        participant array<struct<individual:struct<identifier:{_IDENTIFIER}>>>""",
}


def _parsed(bronze: DataFrame, resource_type: str, filtered: bool = True) -> DataFrame:
    """Resources with their text as struct ``r``.

    The struct comes out of a generator and not a projection: a later filter on one of its
    fields would be moved below a projection, and parse every text once more for itself.
    Types that nothing filters by a field come out of a projection, which is left out where rows are only counted.
    """
    shape = " ".join(_SHAPES[resource_type].split())
    parsed = F.from_json("resource_json", shape).alias("r")
    parsed = F.inline(F.array(F.struct(parsed))) if filtered else parsed
    return route(bronze, resource_type).select(parsed, *LINEAGE)


def _patient_id() -> Column:
    return X.strip_reference(F.col("r.subject.reference"), "Patient").alias("fhir_patient_id")


def _coding(path: str, prefix: str) -> list[Column]:
    coding = X.first_coding(F.col(path))
    return [
        coding["system"].alias(f"{prefix}_source_vocabulary"),
        coding["code"].alias(f"{prefix}_source_code"),
        coding["display"].alias(f"{prefix}_source_display"),
    ]


def _race_code() -> Column:
    """Code of the race extension; of the first extension when none is marked as race."""
    extensions = F.col("r.extension")
    marked = X.safe_get(F.filter(extensions, lambda x: x["url"] == config.RACE_EXTENSION))
    codes = F.transform(marked["extension"], lambda x: x["valueCoding"]["code"])
    by_url = X.safe_get(F.filter(codes, lambda c: c.isNotNull()))
    by_position = X.safe_get(X.safe_get(extensions)["extension"])["valueCoding"]["code"]
    return F.coalesce(by_url, by_position)


def silver_patient(bronze: DataFrame) -> DataFrame:
    address = X.safe_get(F.col("r.address"))
    return _parsed(bronze, "Patient").select(
        F.col("r.id").alias("fhir_patient_id"),
        X.to_date(F.col("r.birthDate")).alias("birth_date"),
        F.col("r.gender").alias("gender_code"),
        _race_code().alias("race_code"),
        address["state"].alias("state"),
        address["postalCode"].alias("postal_code"),
        X.safe_get(F.col("r.name"))["family"].alias("family_name"),
        X.identifier_by_system(F.col("r.identifier"), config.HEALTH_ID_SYSTEM).alias("abha_id"),
        X.identifier_by_system(F.col("r.identifier"), config.HEALTH_ID_SYSTEM, negate=True).alias("mrn"),
        X.deceased(F.col("r.deceasedBoolean"), F.col("r.deceasedDateTime")).alias("is_deceased"),
        X.to_timestamp(F.col("r.deceasedDateTime")).alias("deceased_datetime"),
        *LINEAGE,
    )


def silver_condition(bronze: DataFrame) -> DataFrame:
    recorded = X.to_date(F.col("r.recordedDate"))
    start = F.coalesce(X.to_date(F.col("r.onsetDateTime")), X.to_date(F.col("r.onsetPeriod.start")), recorded)
    return _parsed(bronze, "Condition", filtered=False).select(
        F.col("r.id").alias("fhir_condition_id"),
        _patient_id(),
        *_coding("r.code", "condition"),
        start.alias("condition_start_date"),
        recorded.alias("condition_recorded_date"),
        X.first_coding(F.col("r.clinicalStatus"))["code"].alias("clinical_status"),
        X.first_coding(F.col("r.verificationStatus"))["code"].alias("verification_status"),
        *LINEAGE,
    )


def silver_medication_request(bronze: DataFrame) -> DataFrame:
    dosage = X.safe_get(F.col("r.dosageInstruction"))
    dose = X.safe_get(dosage["doseAndRate"])["doseQuantity"]
    repeat = dosage["timing"]["repeat"]
    per_day = X.doses_per_day(X.to_double(repeat["frequency"]), X.to_double(repeat["period"]), repeat["periodUnit"])
    return _parsed(bronze, "MedicationRequest").select(
        F.col("r.id").alias("fhir_medication_request_id"),
        _patient_id(),
        *_coding("r.medicationCodeableConcept", "drug"),
        X.to_date(F.col("r.authoredOn")).alias("drug_exposure_start_date"),
        F.col("r.status").alias("status"),
        F.col("r.intent").alias("intent"),
        X.to_double(dose["value"]).alias("dose_value"),
        dose["unit"].alias("dose_unit"),
        per_day.alias("doses_per_day"),
        *LINEAGE,
    )


def silver_observation(bronze: DataFrame) -> DataFrame:
    effective = F.coalesce(
        X.to_timestamp(F.col("r.effectiveDateTime")), X.to_timestamp(F.col("r.effectivePeriod.start"))
    )
    value_coding = X.first_coding(F.col("r.valueCodeableConcept"))
    reference_range = X.safe_get(F.col("r.referenceRange"))
    return _parsed(bronze, "Observation").select(
        F.col("r.id").alias("fhir_observation_id"),
        _patient_id(),
        X.strip_reference(F.col("r.encounter.reference"), "Encounter").alias("fhir_encounter_id"),
        F.col("r.status").alias("status"),
        X.first_coding(X.safe_get(F.col("r.category")))["code"].alias("category"),
        *_coding("r.code", "observation"),
        effective.alias("effective_datetime"),
        X.to_double(F.col("r.valueQuantity.value")).alias("value_quantity"),
        F.col("r.valueQuantity.unit").alias("value_unit"),
        F.col("r.valueQuantity.code").alias("value_unit_code"),
        value_coding["code"].alias("value_concept_code"),
        value_coding["display"].alias("value_concept_display"),
        F.col("r.valueString").alias("value_string"),
        X.to_double(reference_range["low"]["value"]).alias("range_low"),
        X.to_double(reference_range["high"]["value"]).alias("range_high"),
        *LINEAGE,
    )


def _practitioner_code() -> Column:
    """Registry code of the first participant who has one."""
    held = F.transform(F.col("r.participant"), lambda p: p["individual"]["identifier"])
    return X.identifier_by_system(held, config.PRACTITIONER_SYSTEM)


def silver_encounter(bronze: DataFrame) -> DataFrame:
    start = X.to_timestamp(F.col("r.period.start"))
    end = X.to_timestamp(F.col("r.period.end"))
    visit_type = X.first_coding(X.safe_get(F.col("r.type")))
    provider = F.col("r.serviceProvider.identifier")
    return _parsed(bronze, "Encounter").select(
        F.col("r.id").alias("fhir_encounter_id"),
        _patient_id(),
        F.col("r.status").alias("status"),
        F.col("r.class.code").alias("encounter_class"),
        visit_type["code"].alias("encounter_type_code"),
        visit_type["display"].alias("encounter_type_display"),
        start.alias("period_start"),
        end.alias("period_end"),
        X.duration_minutes(start, end).alias("duration_minutes"),
        F.when(provider["system"] == config.FACILITY_SYSTEM, provider["value"]).alias("hfr_facility_code"),
        F.col("r.serviceProvider.display").alias("facility_name"),
        _practitioner_code().alias("practitioner_code"),
        *LINEAGE,
    )


FLATTENERS = {
    "Patient": silver_patient,
    "Encounter": silver_encounter,
    "Condition": silver_condition,
    "MedicationRequest": silver_medication_request,
    "Observation": silver_observation,
}

# Silver table and resource-id column of each resource type.
SILVER_TABLES = {
    "Patient": ("silver_patient", "fhir_patient_id"),
    "Encounter": ("silver_encounter", "fhir_encounter_id"),
    "Condition": ("silver_condition", "fhir_condition_id"),
    "MedicationRequest": ("silver_medication_request", "fhir_medication_request_id"),
    "Observation": ("silver_observation", "fhir_observation_id"),
}
