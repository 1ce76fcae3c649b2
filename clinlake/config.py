"""Constants of the mapping: identifier systems, concept ids, table layout, size bounds."""

# Public identifier-system and profile URLs.
HEALTH_ID_SYSTEM = "https://healthid.ndhm.gov.in"
FACILITY_SYSTEM = "https://facility.ndhm.gov.in"
PRACTITIONER_SYSTEM = "https://doctor.ndhm.gov.in"
CONSENT_PROFILE = "https://nrces.in/ndhm/fhir/r4/StructureDefinition/Consent"
RACE_EXTENSION = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"

# Fixed value: a national health id is 2-4-4-4 digits.
HEALTH_ID_PATTERN = r"^\d{2}-\d{4}-\d{4}-\d{4}$"

# Code-system URL to vocabulary name.
SYSTEM_VOCABULARY = {
    "http://snomed.info/sct": "SNOMED",
    "http://loinc.org": "LOINC",
    "http://www.nlm.nih.gov/research/umls/rxnorm": "RxNorm",
    "http://hl7.org/fhir/sid/icd-10": "ICD10",
    "http://hl7.org/fhir/sid/icd-10-cm": "ICD10CM",
}

# Concept ids of the common data model.
UNMAPPED = 0
VISIT_TYPE_BY_CLASS = {"AMB": 9202, "IMP": 9201, "EMER": 9203, "HH": 9204}
VISIT_CONCEPT = 581399
CONDITION_TYPE = 32882
DRUG_TYPE = 38000177
OBSERVATION_TYPE = 38000280

# Vocabularies used by each lookup.
CONDITION_VOCABULARIES = ["SNOMED"]
DRUG_VOCABULARIES = ["RxNorm", "RxNorm Extension"]
OBSERVATION_VOCABULARIES = ["LOINC", "SNOMED"]
UNSTANDARDIZED_VOCABULARIES = ["Gender", "Race", "Visit"]
REQUIRED_VOCABULARIES = ["Gender", "Race", "SNOMED", "RxNorm", "LOINC"]
# An extension vocabulary is looked up under the name of the one it extends.
VOCABULARY_ALIAS = {"RxNorm Extension": "RxNorm"}

# Fixed value: end date of a concept or relationship that is still valid.
OPEN_END_DATE = "2099-12-31"

RESOURCE_TYPES = ["Patient", "Encounter", "Condition", "MedicationRequest", "Observation"]

# Columns by which each gold table is clustered, the date that gives its year partition.
CLUSTER_COLUMNS = {
    "omop_person": ["person_id"],
    "omop_visit_occurrence": ["person_id", "visit_start_date"],
    "omop_condition_occurrence": ["person_id", "condition_start_date"],
    "omop_drug_exposure": ["person_id", "drug_exposure_start_date"],
    "omop_measurement": ["person_id", "measurement_date"],
    "omop_observation": ["person_id", "observation_date"],
}

# A lookup is broadcast only when it is counted below both bounds. The driver holds each as rows, as a hash table of about
# 130 bytes a row and as serialized blocks, and a gold table has up to four of them.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 16 * 1024 * 1024
