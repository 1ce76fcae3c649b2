import datetime as dt
import hashlib
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

LOADED = dt.datetime(2024, 1, 1)
BUNDLE_SCHEMA = "bundle_json string, _source_file string, _loaded_at timestamp, _content_hash string"
BRONZE_SCHEMA = (
    "resource_json string, resource_type string, fhir_resource_id string, _lineage_id string, "
    "_source_file string, _loaded_at timestamp, _content_hash string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clinlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def bundle_of(*resources):
    entries = [{"resource": r} for r in resources]
    return json.dumps({"resourceType": "Bundle", "type": "transaction", "entry": entries})


@pytest.fixture
def bundles(spark):
    def make(*texts):
        rows = [
            (t, f"file-{i}.json", LOADED, None if t is None else hashlib.sha256(t.encode()).hexdigest())
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, BUNDLE_SCHEMA)

    return make


@pytest.fixture
def raw(spark):
    """Bronze rows of resources given as dicts."""

    def make(*resources):
        rows = [
            (json.dumps(r), r["resourceType"], r.get("id"), f"lin-{i}", "f.json", LOADED, "h")
            for i, r in enumerate(resources)
        ]
        return spark.createDataFrame(rows, BRONZE_SCHEMA)

    return make


@pytest.fixture(scope="session")
def scalar(spark):
    """Value of a column expression over one row of named values."""

    def evaluate(column, schema="x string", row=(None,)):
        return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]

    return evaluate


SNOMED, LOINC, RXNORM, ICD10 = (
    "http://snomed.info/sct", "http://loinc.org", "http://www.nlm.nih.gov/research/umls/rxnorm", "http://hl7.org/fhir/sid/icd-10",
)

# id, name, domain, vocabulary, class, standard, code, invalid. Ids and codes of the public vocabularies, but for those
# from 90,000,000 on, which are made up.
CONCEPT_ROWS = [
    (8507, "MALE", "Gender", "Gender", "Gender", "S", "M", None),
    (8532, "Female", "Gender", "Gender", "Gender", "S", "Female", None),
    (8515, "Asian", "Race", "Race", "Race", "S", "2028-9", None),
    (317009, "Asthma", "Condition", "SNOMED", "Disorder", "S", "195967001", None),
    (316866, "Hypertensive disorder", "Condition", "SNOMED", "Disorder", "S", "38341003", None),
    (90000001, "House dust", "Observation", "SNOMED", "Substance", "S", "dust-7", None),
    (9189, "Negative", "Meas Value", "SNOMED", "Qualifier", "S", "260385009", None),
    (1332419, "Amlodipine 5 MG Oral Tablet", "Drug", "RxNorm", "Clinical Drug", "S", "197361", None),
    (90000002, "Amlodipine box", "Drug", "RxNorm Extension", "Box", "S", "197361", None),
    (3004249, "Systolic blood pressure", "Measurement", "LOINC", "Clinical Obs", "S", "8480-6", None),
    (90000003, "Another thing of that code", "Measurement", "SNOMED", "Clinical Obs", "S", "8480-6", None),
    (90000004, "Asthma (classification)", "Condition", "ICD10", "Code", None, "J45", None),
    (90000005, "Withdrawn", "Condition", "SNOMED", "Disorder", "S", "gone-1", "D"),
]


@pytest.fixture(scope="session")
def raw_concept(spark):
    rows = [
        (i, name, domain, vocabulary, cls, std, code, dt.date(1970, 1, 1),
         dt.date(2015, 1, 1) if invalid else dt.date(2099, 12, 31), invalid)
        for i, name, domain, vocabulary, cls, std, code, invalid in CONCEPT_ROWS
    ]
    schema = (
        "concept_id bigint, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, "
        "standard_concept string, concept_code string, valid_start_date date, valid_end_date date, invalid_reason string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def concept(raw_concept):
    from clinlake.operators import vocab

    return vocab.load_concept(raw_concept)


@pytest.fixture(scope="session")
def lookups(concept):
    from clinlake.operators import gold

    return gold.build_lookups(concept)


def resource(kind, key, /, **fields):
    return {"id": key, **fields, "resourceType": kind}


def codings(*triples):
    return {"coding": [dict(zip(("code", "system", "display"), t)) for t in triples]}


def at(kind, name):
    return {"reference": f"{kind}/{name}"}


HEALTH_ID = "23-4417-0052-8806"
PATIENT = resource(
    "Patient", "p-31",
    address=[{"city": "Kolkata", "postalCode": "700091", "state": "West Bengal"}, {"state": "Goa"}],
    birthDate="1972-02-29",
    gender="male",
    identifier=[
        {"value": "W/204", "system": "urn:example:ward-list"},
        {"value": HEALTH_ID, "system": "https://healthid.ndhm.gov.in"},
        {"value": "second", "system": "urn:example:other"},
    ],
    name=[{"given": ["Meena", "S"], "family": "Pillai"}, {"family": "Unused"}],
)
CONDITION = resource(
    "Condition", "c-9",
    clinicalStatus=codings(("recurrence",)),
    code=codings(("195967001", SNOMED, "Asthma"), ("J45", ICD10, "Asthma, unspecified")),
    onsetDateTime="2016-07-01",
    recordedDate="2016-08-19",
    subject=at("Patient", "p-31"),
    verificationStatus=codings(("provisional",), ("confirmed",)),
)
ENCOUNTER = resource(
    "Encounter", "v-5",
    period={"end": "2016-08-19T07:25:00+05:30", "start": "2016-08-18T21:40:00+05:30"},
    serviceProvider={
        "identifier": {"value": "IN2910000042", "system": "https://facility.ndhm.gov.in"},
        "display": "Lakeside Clinic",
    },
    status="triaged",
    subject=at("Patient", "p-31"),
    type=[codings(("32485007", SNOMED, "Admission"), ("extra",)), codings(("later",))],
    **{"class": {"code": "IMP"}},
)
OBSERVATION = resource(
    "Observation", "o-77",
    category=[codings(("exam",)), codings(("unused",))],
    code=codings(("8480-6", LOINC, "Systolic"), ("other", SNOMED, "Other")),
    effectiveDateTime="2016-08-18T22:05:30.250+05:30",
    encounter=at("Encounter", "v-5"),
    referenceRange=[{"high": {"value": 139.5}, "low": {"value": 90}}],
    status="amended",
    subject=at("Patient", "p-31"),
    valueQuantity={"code": "mm[Hg]", "unit": "millimetres", "value": 131.5},
)
MEDICATION = resource(
    "MedicationRequest", "m-2",
    authoredOn="2016-08-19",
    dosageInstruction=[
        {
            "doseAndRate": [{"doseQuantity": {"unit": "tablet", "value": 2.5}}, {"doseQuantity": {"value": 9}}],
            "timing": {"repeat": {"period": 2, "frequency": 3, "periodUnit": "d"}},
        }
    ],
    intent="plan",
    medicationCodeableConcept=codings(("197361", RXNORM, "Amlodipine")),
    status="active",
    subject=at("Patient", "p-31"),
)
CONSENT = resource(
    "Consent", "k-1",
    dateTime="2016-08-18",
    meta={"profile": ["urn:example:any", "https://nrces.in/ndhm/fhir/r4/StructureDefinition/Consent"]},
    patient=at("Patient", "p-31"),
    scope=codings(("research",)),
    status="proposed",
)


def without(resource, *keys, **changes):
    out = {k: v for k, v in resource.items() if k not in keys}
    out.update(changes)
    return out


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
