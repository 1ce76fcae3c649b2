import datetime as dt

import pytest
import xxhash
from conftest import (
    CONDITION, CONSENT, ENCOUNTER, HEALTH_ID, ICD10, MEDICATION, OBSERVATION, PATIENT, SNOMED, one, without,
)
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import extensions, gold, joins, silver, vocab
from clinlake.sources import contracts


def key_of(text):
    signed = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return abs(signed - 2**64 if signed >= 2**63 else signed)


@pytest.fixture
def persons(raw):
    return joins.person_crosswalk(silver.silver_patient(raw(PATIENT)))


@pytest.fixture
def visits(raw):
    return joins.visit_crosswalk(silver.silver_encounter(raw(ENCOUNTER)))


# -- keys ------------------------------------------------------------------------------------

@pytest.mark.parametrize("text", ["p-31", "urn:uuid:7", "", "é", "x" * 100])
def test_surrogate_key_is_the_absolute_hash(scalar, text):
    got = scalar(X.surrogate_key(F.col("x")), row=(text,))
    assert got == key_of(text) and 0 <= got < 2**63


def test_surrogate_key_is_pinned(scalar):
    assert scalar(X.surrogate_key(F.col("x")), row=("p-31",)) == 8375838412878165151


def test_surrogate_key_of_null_is_null(scalar):
    assert scalar(X.surrogate_key(F.col("x"))) is None


def test_surrogate_keys_differ(spark):
    keys = spark.range(10000).select(X.surrogate_key(F.concat(F.lit("id-"), "id")).alias("k"))
    assert keys.distinct().count() == 10000


# -- person ----------------------------------------------------------------------------------

def person(raw, lookups, *patients):
    return gold.omop_person(silver.silver_patient(raw(*patients)), lookups["gender"], lookups["race"])


def test_person_row(raw, lookups):
    r = one(person(raw, lookups, PATIENT))
    assert r.person_id == key_of("p-31") and r.person_source_value == HEALTH_ID
    assert (r.year_of_birth, r.month_of_birth, r.day_of_birth) == (1972, 2, 29)
    assert (r.gender_concept_id, r.gender_source_value) == (8507, "male")
    assert (r.race_concept_id, r.ethnicity_concept_id, r.race_source_concept_id) == (0, 0, 0)
    assert r.provider_id is None and r.care_site_id is None and r.location_id == key_of("West Bengal|700091")
    assert r._transformed_at is not None


@pytest.mark.parametrize(
    "gender, concept_id", [("male", 8507), ("MALE", 8507), ("M", 8507), ("female", 8532), ("other", 0), (None, 0)]
)
def test_gender_is_matched_by_code_or_name(raw, lookups, gender, concept_id):
    assert one(person(raw, lookups, without(PATIENT, gender=gender))).gender_concept_id == concept_id


def test_race_is_matched_exactly(raw, lookups):
    race = {
        "url": "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race",
        "extension": [{"url": "ombCategory", "valueCoding": {"code": "2028-9"}}],
    }
    assert one(person(raw, lookups, without(PATIENT, extension=[race]))).race_concept_id == 8515


def test_person_without_national_id_is_known_by_its_own(raw, lookups):
    assert one(person(raw, lookups, without(PATIENT, "identifier"))).person_source_value == "p-31"


def test_empty_vocabulary_gives_zero(raw, concept):
    none = gold.build_lookups(concept.limit(0))
    assert one(person(raw, none, PATIENT)).gender_concept_id == 0


# -- visit -----------------------------------------------------------------------------------

def test_visit_row(raw, persons):
    r = one(gold.omop_visit_occurrence(silver.silver_encounter(raw(ENCOUNTER)), persons))
    assert (r.visit_occurrence_id, r.person_id) == (key_of("v-5"), key_of("p-31"))
    assert (r.visit_type_concept_id, r.visit_concept_id, r.visit_source_value) == (9201, 581399, "IMP")
    assert (r.visit_start_date, r.visit_end_date) == (dt.date(2016, 8, 18), dt.date(2016, 8, 19))
    assert (r.duration_minutes, r.preceding_visit_occurrence_id) == (585, None)
    assert (r.encounter_type_code, r.visit_source_concept_id, r.hfr_facility_code) == ("32485007", 0, "IN2910000042")
    assert (r.care_site_id, r.provider_id, r.year_start) == (key_of("IN2910000042"), None, 2016)


def test_ids_of_visits_and_persons_lead_to_their_rows(raw, persons, lookups):
    def met(n, practitioners, **changes):
        people = [{"individual": {"display": f"Dr {c}", "identifier": {"system": s, "value": c}}} for s, c in practitioners]
        return without(ENCOUNTER, id=f"v-{n}", participant=[{}] + people, **changes)

    registry, other = config.PRACTITIONER_SYSTEM, "https://other.example.org"
    bronze = raw(met(1, [(other, "Z"), (registry, "A"), (registry, "B")]), met(2, [(other, "Z")], serviceProvider={}), met(3, []))
    encounter = silver.silver_encounter(bronze)
    visits = gold.omop_visit_occurrence(encounter, persons)
    found = extensions.visit_references(visits, extensions.care_site(encounter), extensions.provider(bronze))
    got = {r._lineage_id: (r.care_site_source_value, r.care_site_name, r.provider_source_value, r.provider_name) for r in found.collect()}
    site = ("IN2910000042", "Lakeside Clinic")
    assert got == {"lin-0": (*site, "A", "Dr A"), "lin-1": (None,) * 4, "lin-2": (*site, None, None)}
    # Providers beyond the first stay rows of their own; a staging table without practitioners has visits without.
    assert {r.provider_source_value for r in extensions.provider(bronze).collect()} == {"A", "B"}
    before = gold.omop_visit_occurrence(encounter.drop("practitioner_code"), persons)
    assert before.filter("provider_id is not null").isEmpty() and before.columns == visits.columns

    places = [[{"state": "Goa"}], [{"state": "", "postalCode": "700091"}], [{"state": "", "postalCode": ""}], []]
    patient = silver.silver_patient(raw(*[without(PATIENT, id=f"p-{n}", address=a) for n, a in enumerate(places)]))
    people = gold.omop_person(patient, lookups["gender"], lookups["race"])
    at = {r._lineage_id: (r.state, r.zip, r.location_id is not None) for r in extensions.person_locations(people, extensions.location(patient)).collect()}
    assert at == {"lin-0": ("Goa", None, True), "lin-1": (None, "700091", True), "lin-2": (None, None, False), "lin-3": (None, None, False)}


@pytest.mark.parametrize("code, concept_id", [("AMB", 9202), ("IMP", 9201), ("EMER", 9203), ("HH", 9204), ("VR", 0), (None, 0)])
def test_visit_type(raw, persons, code, concept_id):
    encounter = silver.silver_encounter(raw(without(ENCOUNTER, **{"class": {"code": code}})))
    r = one(gold.omop_visit_occurrence(encounter, persons))
    assert r.visit_type_concept_id == concept_id and r.visit_source_value == code


def test_facts_of_a_patient_with_national_id_are_resolved(raw, persons):
    # Joining on person_source_value would lose this patient.
    assert one(gold.omop_visit_occurrence(silver.silver_encounter(raw(ENCOUNTER)), persons)).person_id is not None


def test_facts_of_an_unknown_patient_are_kept(raw, persons):
    stranger = without(ENCOUNTER, subject={"reference": "Patient/nobody"})
    nobody = without(ENCOUNTER, "subject", id="enc-2")
    rows = gold.omop_visit_occurrence(silver.silver_encounter(raw(stranger, nobody)), persons).collect()
    assert [r.person_id for r in rows] == [None, None]


def test_a_patient_sent_twice_does_not_repeat_facts(raw):
    twice = joins.person_crosswalk(silver.silver_patient(raw(PATIENT, PATIENT)))
    assert gold.omop_visit_occurrence(silver.silver_encounter(raw(ENCOUNTER)), twice).count() == 1


# -- condition -------------------------------------------------------------------------------

def condition(raw, persons, lookups, **changes):
    frame = silver.silver_condition(raw(without(CONDITION, **changes)))
    return one(gold.omop_condition_occurrence(frame, persons, lookups["condition"]))


def coding(code, system=SNOMED):
    return {"coding": [{"system": system, "code": code}] if system else [{"code": code}]}


def test_condition_row(raw, persons, lookups):
    r = condition(raw, persons, lookups)
    assert (r.condition_occurrence_id, r.person_id) == (key_of("c-9"), key_of("p-31"))
    assert (r.condition_concept_id, r.condition_type_concept_id, r.condition_source_concept_id) == (317009, 32882, 0)
    assert (r.condition_start_date, r.condition_end_date, r.year_start) == (dt.date(2016, 7, 1), None, 2016)


@pytest.mark.parametrize(
    "code, concept_id",
    [
        (coding("38341003"), 316866),
        (coding("no-such"), 0),
        (coding("dust-7"), 0),  # exists, in another domain
        (coding("195967001", system=None), 317009),
        (coding("195967001", system="urn:unknown"), 317009),
        (coding("195967001", system=ICD10), 0),  # another vocabulary's code
        ({"text": "no coding"}, 0),
    ],
)
def test_condition_concept(raw, persons, lookups, code, concept_id):
    assert condition(raw, persons, lookups, code=code).condition_concept_id == concept_id


@pytest.mark.parametrize(
    "status, reason", [("resolved", "Resolved"), ("active", None), ("inactive", None), ("recurrence", None), (None, None)]
)
def test_condition_stop_reason(raw, persons, lookups, status, reason):
    r = condition(raw, persons, lookups, clinicalStatus={"coding": [{"code": status}]})
    assert (r.stop_reason, r.condition_status_source_value) == (reason, status)


# -- drug ------------------------------------------------------------------------------------

def test_drug_row(raw, persons, lookups):
    r = one(gold.omop_drug_exposure(silver.silver_medication_request(raw(MEDICATION)), persons, lookups["drug"]))
    # The extension vocabulary has the same code: the lower id is taken, the row is not repeated.
    assert (r.drug_exposure_id, r.drug_concept_id, r.drug_type_concept_id) == (key_of("m-2"), 1332419, 38000177)
    assert (r.quantity, r.dose_unit, r.effective_drug_dose) == (2.5, "tablet", 1.5)
    assert (r.days_supply, r.refills, r.lot_number, r.visit_occurrence_id) == (None, None, None, None)


@pytest.mark.parametrize(
    "status, ended, reason",
    [("stopped", True, "Stopped"), ("cancelled", True, "Cancelled"), ("active", False, None), ("on-hold", False, None)],
)
def test_drug_end(raw, persons, lookups, status, ended, reason):
    frame = silver.silver_medication_request(raw(without(MEDICATION, status=status)))
    r = one(gold.omop_drug_exposure(frame, persons, lookups["drug"]))
    assert r.drug_exposure_end_date == (dt.date(2016, 8, 19) if ended else None) and r.stop_reason == reason


# -- measurement and observation ---------------------------------------------------------------

CODED = {"coding": [{"code": "260385009"}]}


@pytest.mark.parametrize(
    "drop, add, measured, observed",
    [
        ([], {}, 1, 0),
        (["valueQuantity"], {"valueCodeableConcept": CODED}, 0, 1),
        (["valueQuantity"], {"valueString": "normal"}, 0, 1),
        (["valueQuantity"], {}, 0, 1),
        ([], {"valueCodeableConcept": CODED}, 1, 1),
        ([], {"valueString": "note"}, 1, 1),
    ],
)
def test_routing_by_value(raw, drop, add, measured, observed):
    df = silver.silver_observation(raw(without(OBSERVATION, *drop, **add)))
    assert (df.filter(gold.is_measurement()).count(), df.filter(gold.is_observation()).count()) == (measured, observed)


def test_measurement_row(raw, persons, visits, lookups):
    frame = silver.silver_observation(raw(OBSERVATION))
    r = one(gold.omop_measurement(frame, persons, visits, lookups["measurement"]))
    assert (r.measurement_id, r.visit_occurrence_id) == (key_of("o-77"), key_of("v-5"))
    assert (r.measurement_concept_id, r.measurement_type_concept_id) == (3004249, 38000280)
    assert (r.value_as_number, r.unit_source_value, r.unit_source_display) == (131.5, "mm[Hg]", "millimetres")
    assert (r.range_low, r.range_high, r.measurement_date) == (90.0, 139.5, dt.date(2016, 8, 18))
    assert r.observation_category_source_value == "exam"


def test_same_code_in_another_vocabulary(raw, persons, visits, lookups):
    snomed = silver.silver_observation(raw(without(OBSERVATION, code=coding("8480-6"))))
    assert one(gold.omop_measurement(snomed, persons, visits, lookups["measurement"])).measurement_concept_id == 90000003


def test_observation_without_known_visit_gets_zero(raw, persons, visits, lookups):
    frame = silver.silver_observation(
        raw(without(OBSERVATION, "encounter"), without(OBSERVATION, id="o2", encounter={"reference": "Encounter/x"}))
    )
    rows = gold.omop_measurement(frame, persons, visits, lookups["measurement"]).collect()
    assert [r.visit_occurrence_id for r in rows] == [0, 0]


def test_observation_row(raw, persons, visits, lookups):
    frame = silver.silver_observation(raw(without(OBSERVATION, valueCodeableConcept=CODED)))
    r = one(gold.omop_observation(frame, persons, visits, lookups["observation"], lookups["value"]))
    assert (r.observation_id, r.observation_concept_id) == (key_of("o-77"), 3004249)
    assert (r.value_as_concept_id, r.value_as_number, r.value_as_string) == (9189, None, None)
    assert r.obs_event_field_source_value == "exam"


def test_observation_number_is_kept_without_a_code(raw, persons, visits, lookups):
    frame = silver.silver_observation(raw(without(OBSERVATION, valueString="note")))
    r = one(gold.omop_observation(frame, persons, visits, lookups["observation"], lookups["value"]))
    assert (r.value_as_number, r.value_as_string, r.value_as_concept_id) == (131.5, "note", 0)


# -- lineage and contracts ----------------------------------------------------------------------

@pytest.fixture
def all_gold(raw, persons, visits, lookups):
    observation = silver.silver_observation(raw(without(OBSERVATION, valueCodeableConcept=CODED)))
    return {
        "omop_person": person(raw, lookups, PATIENT),
        "omop_visit_occurrence": gold.omop_visit_occurrence(silver.silver_encounter(raw(ENCOUNTER)), persons),
        "omop_condition_occurrence": gold.omop_condition_occurrence(
            silver.silver_condition(raw(CONDITION)), persons, lookups["condition"]
        ),
        "omop_drug_exposure": gold.omop_drug_exposure(
            silver.silver_medication_request(raw(MEDICATION)), persons, lookups["drug"]
        ),
        "omop_measurement": gold.omop_measurement(observation, persons, visits, lookups["measurement"]),
        "omop_observation": gold.omop_observation(
            observation, persons, visits, lookups["observation"], lookups["value"]
        ),
    }


def test_lineage_audit(all_gold):
    audit = gold.lineage_audit(all_gold)
    assert audit.columns == [
        "omop_table", "_lineage_id", "record_id", "fhir_resource_id", "_source_file", "_loaded_at", "_transformed_at"
    ]
    rows = {r.omop_table: r for r in audit.collect()}
    assert set(rows) == {
        "person", "visit_occurrence", "condition_occurrence", "drug_exposure", "measurement", "observation"
    }
    assert rows["person"].record_id == str(key_of("p-31"))
    assert rows["person"].fhir_resource_id == HEALTH_ID
    assert rows["drug_exposure"].fhir_resource_id is None
    assert gold.trace_lineage(audit, lineage_id="lin-0").count() == 6
    assert gold.trace_lineage(audit, source_file="other").count() == 0


def test_no_column_is_untyped(all_gold):
    for frame in all_gold.values():
        assert "void" not in dict(frame.dtypes).values()


def test_gold_meets_the_contracts(all_gold):
    for table, frame in all_gold.items():
        name = table.removeprefix("omop_")
        conformed = contracts.to_cdm(frame, name)
        assert conformed.columns == contracts.CDM[name].fieldNames()
        assert [f.dataType for f in conformed.schema] == [f.dataType for f in contracts.CDM[name]]
        assert contracts.contract_violations(conformed, contracts.CDM[name]).count() == 0
        assert contracts.CDM_PARTITION[name] in conformed.columns


def test_contract_keeps_source_codes(all_gold):
    assert one(contracts.to_cdm(all_gold["omop_drug_exposure"], "drug_exposure")).drug_source_value == "197361"
    assert one(contracts.to_cdm(all_gold["omop_measurement"], "measurement")).measurement_source_value == "8480-6"


def test_contract_violation_is_found(spark):
    df = spark.createDataFrame([(None, "x")], "care_site_id bigint, care_site_name string")
    report = contracts.contract_report(contracts.conform(df, contracts.CDM["care_site"]), contracts.CDM["care_site"], "c")
    assert tuple(one(report)) == ("c", 1, 1)


# -- functions and consents ---------------------------------------------------------------------

def test_profile_detection(raw):
    other = without(CONDITION, meta={"profile": ["http://hl7.org/fhir/StructureDefinition/Condition"]})
    flagged = raw(CONSENT, other, PATIENT).select(X.has_profile("resource_json").alias("f")).collect()
    assert [r.f for r in flagged] == [True, False, False]


@pytest.mark.parametrize(
    "value, status",
    [
        (None, "Missing"), (HEALTH_ID, "Valid"), ("00-0000-0000-0000", "Valid"), (HEALTH_ID[1:], "Invalid"),
        (HEALTH_ID + "0", "Invalid"), (HEALTH_ID.replace("-", ""), "Invalid"), (HEALTH_ID.replace("-", " "), "Invalid"),
        (HEALTH_ID.replace("4", "x"), "Invalid"), (" " + HEALTH_ID, "Invalid"), ("", "Invalid"), ("२३-4417-0052-8806", "Invalid"),
    ],
)
def test_health_id_status(scalar, value, status):
    assert scalar(X.health_id_status(F.col("x")), row=(value,)) == status


def test_safe_get_is_null_out_of_range(scalar):
    assert scalar(X.safe_get(F.array(F.lit(1)), 3)) is None


def test_percent_of_nothing_is_null(scalar):
    assert scalar(X.percent(F.lit(0), F.lit(0))) is None
    assert scalar(X.percent(F.lit(1), F.lit(3))) == 33.3


def test_exact_avg_does_not_depend_on_order(spark):
    values = [0.1, 1e6, -1e6, 0.3, 0.005] * 7
    frames = [spark.createDataFrame([(v,) for v in vs], "v double") for vs in (values, sorted(values), values[::-1])]
    assert len({one(df.agg(X.exact_avg(F.col("v"), 4).alias("a"))).a for df in frames}) == 1


def test_exact_avg_takes_every_value(spark):
    def mean(*values):
        return one(spark.createDataFrame([(v,) for v in values], "v double").agg(X.exact_avg(F.col("v"), 12).alias("a"))).a

    assert mean(1e25, 3e25) == 2e25
    assert mean(1e-9, 3e-9) == 2e-9
    assert mean(1.0, float("nan")) != mean(1.0, float("nan"))
    assert mean(1.0, float("inf")) == float("inf")
    assert mean(None, 2.0, 3.0) == 2.5 and mean(None) is None


# -- vocabulary ---------------------------------------------------------------------------------

def ids(df):
    return sorted(r.concept_id for r in df.collect())


def test_load_concept_keeps_standard_and_unflagged_vocabularies(spark, raw_concept):
    unflagged = raw_concept.filter("concept_id = 8515").withColumn("standard_concept", F.lit(None).cast("string"))
    kept = ids(vocab.load_concept(raw_concept.filter("concept_id <> 8515").unionByName(unflagged)))
    assert 8515 in kept and 90000004 not in kept and 90000005 in kept
    assert 90000005 not in ids(vocab.load_concept(raw_concept, active_only=True))


def test_lookup_has_one_row_per_key(concept):
    keys = vocab.concept_keys(vocab.concept_subset(concept, ["LOINC", "SNOMED"]))
    assert keys.count() == keys.select("vocabulary", "concept_code").distinct().count()
    assert one(keys.filter("vocabulary = '*' AND concept_code = '8480-6'")).concept_id == 3004249


def test_fanout_names_the_codes_a_plain_join_would_repeat(concept):
    assert [tuple(r) for r in vocab.concept_fanout(concept, ["LOINC", "SNOMED"]).collect()] == [("8480-6", 2)]


def test_coverage_and_missing(concept):
    first = vocab.vocab_coverage(concept).first()
    assert tuple(first) == ("SNOMED", 6, 6, 4)
    assert [r.vocabulary_id for r in vocab.missing_vocabularies(concept, ["LOINC", "UCUM"]).collect()] == ["UCUM"]


def test_source_code_maps_to_standard(spark, raw, raw_concept):
    from clinlake.operators import extensions

    edges = spark.createDataFrame(
        [(90000004, 317009, "Maps to", dt.date(2099, 12, 31)), (90000004, 316866, "Maps to", dt.date(2015, 1, 1))],
        "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, valid_end_date date",
    )
    keys = vocab.source_to_standard_keys(raw_concept, vocab.load_relationship(edges))
    icd = silver.silver_condition(raw(without(CONDITION, code=coding("J45", ICD10)), CONDITION))
    mapped = extensions.map_source_to_standard(icd, keys, "condition_source_vocabulary", "condition_source_code", "c")
    assert sorted(r.c for r in mapped.collect()) == [0, 317009]
