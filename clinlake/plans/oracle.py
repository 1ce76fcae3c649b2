"""SQL counterparts of the registered queries, computed straight from the driver's tables.

They never see a bundle: what a patient, an encounter or a concept must look like is stated
here a second time, relationally, so an error in building or parsing JSON cannot cancel out.
"""

from __future__ import annotations

_LINEAGE = "sha256({file} || '|' || {id})"
_BASIC = """sha256('{"resourceType":"Basic"}')"""


def _lineage(file: str, resource_id: str) -> str:
    return _LINEAGE.format(file=file, id=resource_id)


# Source frames and gold frames, each able to use those before it.
CTES = {
    "whole": """
        SELECT c_custkey AS k, 'bundles/customer/' || c_custkey AS file, c_nationkey AS nation, c_name
        FROM customer""",
    "all_patient": """
        SELECT c_custkey AS k, c_nationkey AS nation,
            'cust-' || c_custkey AS fhir_patient_id,
            DATE '1940-01-01' + CAST(c_custkey * 17 % 25000 AS INTEGER) AS birth_date,
            CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END AS gender_code,
            CASE WHEN c_nationkey % 10 = 0 THEN '2028-9' WHEN c_nationkey % 5 = 0 THEN '9999-9' END AS race_code,
            'STATE_' || c_nationkey AS state,
            CAST(c_custkey % 900 + 100000 AS VARCHAR) AS postal_code,
            c_name AS family_name,
            CASE WHEN c_custkey % 30 = 0 THEN 'ABHA' || c_custkey
                 WHEN c_custkey % 3 = 0 THEN '91-' || lpad(CAST(h % 10000 AS VARCHAR), 4, '0')
                    || '-' || lpad(CAST(h * 7 % 10000 AS VARCHAR), 4, '0')
                    || '-' || lpad(CAST(h * 13 % 10000 AS VARCHAR), 4, '0') END AS abha_id,
            'MRN-' || c_custkey AS mrn,
            c_custkey % 10 IN (1, 2) AS is_deceased,
            CASE WHEN c_custkey % 10 = 2 THEN CAST(DATE '2021-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP)
                 + INTERVAL 60 MINUTE - INTERVAL 330 MINUTE END AS deceased_datetime,
            'bundles/customer/' || c_custkey AS _source_file
        FROM (SELECT *, CASE WHEN c_custkey % 60 = 9 THEN c_custkey - 3 ELSE c_custkey END AS h FROM customer)""",
    "patient": f"""
        SELECT *, {_lineage('_source_file', 'fhir_patient_id')} AS _lineage_id
        FROM all_patient""",
    "encounter": f"""
        SELECT *, {_lineage('_source_file', 'fhir_encounter_id')} AS _lineage_id FROM (
        SELECT o_orderkey AS o, o_custkey AS k, 'ord-' || o_orderkey AS fhir_encounter_id,
            'cust-' || o_custkey AS fhir_patient_id,
            CASE WHEN o_orderstatus = 'O' THEN 'in-progress' ELSE 'finished' END AS status,
            CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EMER' WHEN '2' THEN 'IMP' WHEN '3' THEN 'AMB'
                 WHEN '4' THEN 'HH' ELSE 'VR' END AS encounter_class,
            'T' || o_orderkey % 20 AS encounter_type_code, 'Type ' || o_orderkey % 20 AS encounter_type_display,
            o_orderdate + to_minutes(CAST(o_orderkey % 1440 - 330 AS INTEGER)) AS period_start,
            CASE WHEN o_orderstatus <> 'O' THEN o_orderdate
                 + to_minutes(CAST(o_orderkey % 1440 - 330 + o_orderkey % 240 AS INTEGER)) END AS period_end,
            CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey % 240 AS INTEGER) END AS duration_minutes,
            CASE WHEN o_custkey % 2 = 0 THEN 'HFR_' || o_custkey % 100 END AS hfr_facility_code,
            CASE WHEN o_custkey % 10 <> 1 THEN 'Facility ' || o_custkey % 100 END AS facility_name,
            CASE WHEN o_orderkey % 3 = 0 THEN 'HPR_' || o_orderkey % 50 END AS practitioner_code,
            'bundles/order/' || o_orderkey AS _source_file
        FROM orders)""",
    "line": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id,
            o_custkey AS k, 'cust-' || o_custkey AS fhir_patient_id, l_partkey AS p, l_suppkey AS s,
            l_linenumber AS n, l_quantity AS quantity, l_returnflag AS flag, l_linestatus AS linestatus,
            CAST(l_shipdate AS DATE) AS shipped
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "condition": f"""
        SELECT *, {_lineage('_source_file', 'fhir_condition_id')} AS _lineage_id FROM (
        SELECT k, p, s, 'cond-' || line_id AS fhir_condition_id, fhir_patient_id,
            CASE WHEN s % 10 = 0 THEN 'http://hl7.org/fhir/sid/icd-10'
                 WHEN s % 10 <> 1 THEN 'http://snomed.info/sct' END AS condition_source_vocabulary,
            CAST(p AS VARCHAR) AS condition_source_code, 'Part ' || p AS condition_source_display,
            CASE WHEN n % 3 = 2 THEN shipped + 1 ELSE shipped END AS condition_start_date,
            shipped + 1 AS condition_recorded_date,
            CASE WHEN linestatus = 'F' THEN 'resolved' ELSE 'active' END AS clinical_status,
            'confirmed' AS verification_status, 'bundles/line/cond-' || line_id AS _source_file
        FROM line WHERE flag IN ('R', 'A'))""",
    "medication": f"""
        SELECT *, {_lineage('_source_file', 'fhir_medication_request_id')} AS _lineage_id FROM (
        SELECT k, p, 'med-' || line_id AS fhir_medication_request_id, fhir_patient_id,
            'http://www.nlm.nih.gov/research/umls/rxnorm' AS drug_source_vocabulary,
            CAST(p AS VARCHAR) AS drug_source_code, 'Part ' || p AS drug_source_display,
            shipped AS drug_exposure_start_date,
            CASE n WHEN 1 THEN 'stopped' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'on-hold' ELSE 'active' END AS status,
            'order' AS intent, CASE WHEN n <> 7 THEN quantity END AS dose_value,
            CASE WHEN n <> 7 THEN 'mg' END AS dose_unit,
            CASE WHEN n <> 7 AND s % 5 <> 0 AND s % 3 <> 0 THEN CAST(n AS DOUBLE) / (s % 3) END AS doses_per_day,
            'bundles/line/med-' || line_id AS _source_file
        FROM line WHERE flag = 'N')""",
    "observation": f"""
        SELECT *, {_lineage('_source_file', 'fhir_observation_id')} AS _lineage_id FROM (
        SELECT e, user_id AS k, 'evt-' || e AS fhir_observation_id, 'cust-' || user_id AS fhir_patient_id,
            CASE WHEN e % 2 = 0 THEN 'ord-' || e * 2 END AS fhir_encounter_id,
            CASE WHEN kind = 'error' THEN 'registered' ELSE 'final' END AS status,
            CASE WHEN measured THEN 'vital-signs' WHEN kind = 'click' THEN 'laboratory'
                 ELSE 'social-history' END AS category,
            CASE WHEN e % 5 = 0 THEN 'http://snomed.info/sct' ELSE 'http://loinc.org' END AS observation_source_vocabulary,
            code AS observation_source_code, 'Code ' || code AS observation_source_display,
            ts - INTERVAL 330 MINUTE AS effective_datetime,
            CASE WHEN measured THEN value END AS value_quantity,
            CASE kind WHEN 'view' THEN 'beats/minute' WHEN 'purchase' THEN 'milligrams' END AS value_unit,
            CASE kind WHEN 'view' THEN '/min' WHEN 'purchase' THEN 'mg' END AS value_unit_code,
            CASE WHEN coded THEN code END AS value_concept_code,
            CASE WHEN coded THEN 'Value ' || code END AS value_concept_display,
            CASE WHEN kind = 'signup' THEN 'text ' || e % 5 END AS value_string,
            CASE WHEN e % 3 = 0 THEN CAST(10.5 AS DOUBLE) END AS range_low,
            CASE WHEN e % 3 = 0 THEN CAST(100 AS DOUBLE) END AS range_high,
            'bundles/event/' || e AS _source_file
        FROM (SELECT *, event_id AS e, event_type AS kind, json_extract_string(props, '$.k') AS code,
                event_type IN ('purchase', 'view') AS measured,
                event_type = 'click' OR (event_type = 'purchase' AND event_id % 17 = 0) AS coded FROM events))""",
    "raw_concept": """
        SELECT base + p_partkey AS concept_id, p_name AS concept_name, domain_id, vocabulary_id,
            p_type AS concept_class_id, standard_concept, CAST(p_partkey AS VARCHAR) AS concept_code,
            CASE WHEN p_partkey % 13 = 0 THEN DATE '2015-12-31' ELSE DATE '2099-12-31' END AS valid_end_date,
            CASE WHEN p_partkey % 13 = 0 THEN 'D' END AS invalid_reason
        FROM (
            SELECT *, 500000000 AS base, 'LOINC' AS vocabulary_id, 'S' AS standard_concept,
                CASE WHEN p_partkey % 2 = 0 THEN 'Measurement' ELSE 'Observation' END AS domain_id
            FROM part WHERE p_partkey % 3 <> 0
            UNION ALL
            SELECT *, 1000000000, 'SNOMED', CASE WHEN p_partkey % 11 <> 0 THEN 'S' END,
                CASE WHEN p_size % 10 = 0 THEN 'Procedure' ELSE 'Condition' END
            FROM part WHERE p_partkey % 5 <> 0
            UNION ALL
            SELECT *, 2000000000, 'RxNorm', 'S', CASE WHEN p_size % 7 = 0 THEN 'Device' ELSE 'Drug' END
            FROM part WHERE p_partkey % 4 <> 0
            UNION ALL
            SELECT *, 3000000000, 'RxNorm Extension', 'S', 'Drug' FROM part WHERE p_partkey % 6 = 0
            UNION ALL
            SELECT *, 4000000000, 'ICD10', NULL, 'Condition' FROM part WHERE p_partkey % 2 = 0)
        UNION ALL
        SELECT concept_id, concept_name, vocabulary_id, vocabulary_id, vocabulary_id, 'S', concept_code,
            DATE '2099-12-31', NULL
        FROM (VALUES (8507, 'MALE', 'Gender', 'M'), (8532, 'FEMALE', 'Gender', 'F'),
                     (8515, 'Asian', 'Race', '2028-9'), (8527, 'White', 'Race', '2106-3'))
            v(concept_id, concept_name, vocabulary_id, concept_code)""",
    "concept": """
        SELECT * FROM raw_concept WHERE standard_concept = 'S' OR vocabulary_id IN ('Gender', 'Race', 'Visit')""",
    "standard": "SELECT * FROM concept WHERE standard_concept = 'S'",
    "relationship": """
        SELECT 4000000000 + p_partkey AS concept_id_1, 1000000000 + p_partkey AS concept_id_2,
            CASE WHEN p_partkey % 8 = 0 THEN 'Mapped from' ELSE 'Maps to' END AS relationship_id,
            CASE WHEN p_partkey % 17 = 0 THEN DATE '2020-01-01' ELSE DATE '2099-12-31' END AS valid_end_date
        FROM part WHERE p_partkey % 2 = 0""",
    "person": """
        SELECT k, fhir_patient_id,
            CAST(CASE gender_code WHEN 'male' THEN 8507 WHEN 'female' THEN 8532 ELSE 0 END AS BIGINT) AS gender_concept_id,
            CAST(year(birth_date) AS INTEGER) AS year_of_birth, CAST(month(birth_date) AS INTEGER) AS month_of_birth,
            CAST(day(birth_date) AS INTEGER) AS day_of_birth,
            CAST(CASE WHEN race_code = '2028-9' THEN 8515 ELSE 0 END AS BIGINT) AS race_concept_id,
            CAST(0 AS BIGINT) AS ethnicity_concept_id, gender_code AS gender_source_value,
            race_code AS race_source_value, CAST(0 AS BIGINT) AS race_source_concept_id,
            coalesce(abha_id, fhir_patient_id) AS person_source_value, _lineage_id, _source_file
        FROM patient""",
    "visit": """
        SELECT e.k, e.o, p.k IS NOT NULL AS person_known,
            CAST(CASE encounter_class WHEN 'AMB' THEN 9202 WHEN 'IMP' THEN 9201 WHEN 'EMER' THEN 9203
                 WHEN 'HH' THEN 9204 ELSE 0 END AS BIGINT) AS visit_type_concept_id,
            CAST(period_start AS DATE) AS visit_start_date, CAST(period_end AS DATE) AS visit_end_date,
            period_start AS visit_start_datetime, period_end AS visit_end_datetime,
            CAST(581399 AS BIGINT) AS visit_concept_id, duration_minutes, encounter_class AS visit_source_value,
            CAST(0 AS BIGINT) AS visit_source_concept_id, encounter_type_code, encounter_type_display,
            hfr_facility_code, facility_name, CAST(year(period_start) AS INTEGER) AS year_start,
            e._lineage_id, e._source_file
        FROM encounter e LEFT JOIN patient p ON e.k = p.k""",
    "snomed_condition": """
        SELECT concept_code, min(concept_id) AS concept_id FROM standard
        WHERE vocabulary_id = 'SNOMED' AND domain_id = 'Condition' GROUP BY concept_code""",
    "cond": """
        SELECT c.k, p.k IS NOT NULL AS person_known,
            CASE WHEN c.s % 10 = 0 THEN 0 ELSE coalesce(v.concept_id, 0) END AS condition_concept_id,
            condition_start_date, clinical_status AS condition_status_source_value,
            CAST(32882 AS BIGINT) AS condition_type_concept_id, condition_source_code, condition_source_vocabulary,
            condition_source_display, CAST(0 AS BIGINT) AS condition_source_concept_id,
            CASE WHEN clinical_status = 'resolved' THEN 'Resolved' END AS stop_reason,
            CAST(year(condition_start_date) AS INTEGER) AS year_start, c._lineage_id, c._source_file
        FROM condition c LEFT JOIN patient p ON c.k = p.k
        LEFT JOIN snomed_condition v ON c.condition_source_code = v.concept_code""",
    "rxnorm_drug": """
        SELECT concept_code, min(concept_id) AS concept_id FROM standard
        WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension') AND domain_id = 'Drug' GROUP BY concept_code""",
    "drug": """
        SELECT m.k, p.k IS NOT NULL AS person_known, coalesce(v.concept_id, 0) AS drug_concept_id,
            drug_exposure_start_date,
            CASE WHEN status IN ('stopped', 'cancelled') THEN drug_exposure_start_date END AS drug_exposure_end_date,
            CAST(38000177 AS BIGINT) AS drug_type_concept_id, dose_value AS quantity, dose_unit,
            doses_per_day AS effective_drug_dose, dose_unit AS dose_unit_source_value, drug_source_code,
            drug_source_vocabulary, drug_source_display, CAST(0 AS BIGINT) AS drug_source_concept_id,
            CASE status WHEN 'stopped' THEN 'Stopped' WHEN 'cancelled' THEN 'Cancelled' END AS stop_reason,
            CAST(year(drug_exposure_start_date) AS INTEGER) AS year_start, m._lineage_id, m._source_file
        FROM medication m LEFT JOIN patient p ON m.k = p.k
        LEFT JOIN rxnorm_drug v ON m.drug_source_code = v.concept_code""",
    "obs_code": """
        SELECT CASE vocabulary_id WHEN 'LOINC' THEN 'http://loinc.org' ELSE 'http://snomed.info/sct' END AS system,
            concept_code, min(concept_id) AS concept_id,
            min(CASE WHEN domain_id = 'Measurement' THEN concept_id END) AS measurement_id
        FROM standard WHERE vocabulary_id IN ('LOINC', 'SNOMED') GROUP BY 1, 2""",
    "value_code": "SELECT concept_code, min(concept_id) AS concept_id FROM standard GROUP BY concept_code",
    "observed": """
        SELECT o.*, p.k IS NOT NULL AS person_known, e.o IS NOT NULL AS visit_known,
            coalesce(c.concept_id, 0) AS observation_concept_id, coalesce(c.measurement_id, 0) AS measurement_concept_id,
            coalesce(v.concept_id, 0) AS value_as_concept_id, CAST(effective_datetime AS DATE) AS effective_date
        FROM observation o LEFT JOIN patient p ON o.k = p.k
        LEFT JOIN encounter e ON o.fhir_encounter_id = e.fhir_encounter_id
        LEFT JOIN obs_code c ON o.observation_source_vocabulary = c.system AND o.observation_source_code = c.concept_code
        LEFT JOIN value_code v ON o.value_concept_code = v.concept_code""",
    "measurement": """
        SELECT k, person_known, visit_known, measurement_concept_id, effective_date AS measurement_date,
            effective_datetime AS measurement_datetime, CAST(38000280 AS BIGINT) AS measurement_type_concept_id,
            value_quantity AS value_as_number, CAST(0 AS BIGINT) AS unit_concept_id, value_unit AS unit_source_display,
            value_unit_code AS unit_source_value, range_low, range_high, observation_source_code,
            observation_source_vocabulary, observation_source_display, CAST(0 AS BIGINT) AS observation_source_concept_id,
            CAST(0 AS BIGINT) AS observation_category_concept_id, category AS observation_category_source_value,
            CAST(year(effective_date) AS INTEGER) AS year_start, _lineage_id, _source_file
        FROM observed WHERE value_quantity IS NOT NULL""",
    "omop_observation": """
        SELECT k, person_known, visit_known, observation_concept_id, effective_date AS observation_date,
            effective_datetime AS observation_datetime, CAST(38000280 AS BIGINT) AS observation_type_concept_id,
            CASE WHEN value_concept_code IS NULL THEN value_quantity END AS value_as_number, value_as_concept_id,
            value_string AS value_as_string, observation_source_code, observation_source_vocabulary,
            observation_source_display, CAST(0 AS BIGINT) AS observation_source_concept_id,
            CAST(0 AS BIGINT) AS obs_event_field_concept_id, category AS obs_event_field_source_value,
            CAST(year(effective_date) AS INTEGER) AS year_start, _lineage_id, _source_file
        FROM observed WHERE value_string IS NOT NULL OR value_concept_code IS NOT NULL OR value_quantity IS NULL""",
    "resources": f"""
        SELECT 'Patient' AS resource_type, fhir_patient_id AS fhir_resource_id, _lineage_id, _source_file FROM patient
        UNION ALL SELECT 'Consent', 'consent-' || k, {_lineage('file', "'consent-' || k")}, file FROM whole WHERE k % 4 = 0
        UNION ALL SELECT 'Basic', NULL, {_lineage('file', _BASIC)}, file
            FROM whole WHERE k % 13 = 0
        UNION ALL SELECT 'Encounter', fhir_encounter_id, _lineage_id, _source_file FROM encounter
        UNION ALL SELECT 'Condition', fhir_condition_id, _lineage_id, _source_file FROM condition
        UNION ALL SELECT 'MedicationRequest', fhir_medication_request_id, _lineage_id, _source_file FROM medication
        UNION ALL SELECT 'Observation', fhir_observation_id, _lineage_id, _source_file FROM observation""",
    "audit": """
        SELECT 'person' AS omop_table, _lineage_id, person_source_value AS fhir_resource_id, _source_file FROM person
        UNION ALL SELECT 'visit_occurrence', _lineage_id, NULL, _source_file FROM visit
        UNION ALL SELECT 'condition_occurrence', _lineage_id, NULL, _source_file FROM cond
        UNION ALL SELECT 'drug_exposure', _lineage_id, NULL, _source_file FROM drug
        UNION ALL SELECT 'measurement', _lineage_id, NULL, _source_file FROM measurement
        UNION ALL SELECT 'observation', _lineage_id, NULL, _source_file FROM omop_observation""",
    "facts": """
        SELECT 'omop_visit_occurrence' AS table_name, person_known FROM visit
        UNION ALL SELECT 'omop_condition_occurrence', person_known FROM cond
        UNION ALL SELECT 'omop_drug_exposure', person_known FROM drug
        UNION ALL SELECT 'omop_measurement', person_known FROM measurement
        UNION ALL SELECT 'omop_observation', person_known FROM omop_observation""",
    "mapped": """
        SELECT 'omop_condition_occurrence' AS table_name, condition_concept_id AS c FROM cond
        UNION ALL SELECT 'omop_drug_exposure', drug_concept_id FROM drug
        UNION ALL SELECT 'omop_measurement', measurement_concept_id FROM measurement
        UNION ALL SELECT 'omop_observation', observation_concept_id FROM omop_observation""",
}

_VALID = r"regexp_full_match({}, '\d{{2}}-\d{{4}}-\d{{4}}-\d{{4}}')"


def _valid(column: str) -> str:
    return _VALID.format(column)


def _pct(condition: str) -> str:
    return f"round(100.0 * count(*) FILTER (WHERE {condition}) / count(*), 1)"


def _counts(table: str, columns: str, where: str = "true", limit: int | None = None) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    cut = f" LIMIT {limit}" if limit else ""
    return (
        f"SELECT {columns}, count(*) AS count FROM {table} WHERE {where} GROUP BY {columns} "
        f"ORDER BY count DESC, {order}{cut}"
    )


_SAMPLE = """(SELECT '{kind}' AS kind, {prefix}_source_code AS source_code, {prefix}_source_display AS source_display,
    {concept} AS concept_id, count(*) AS count FROM {table} WHERE {concept} > 0 GROUP BY 1, 2, 3, 4
    ORDER BY count DESC, 2, 3, 4 LIMIT 5)"""

_BODIES = {
    # -- files and bronze
    "scan_bundles": """
        SELECT 'Patient' AS resource_type, 'cust-' || c_custkey AS fhir_resource_id, true AS traced FROM customer
        UNION ALL SELECT 'Consent', 'consent-' || c_custkey, true FROM customer WHERE c_custkey % 4 = 0
        UNION ALL SELECT 'Basic', NULL, true FROM customer WHERE c_custkey % 13 = 0""",
    "bronze_resources": "SELECT * FROM resources",
    "bronze_quarantine": """
        SELECT 'bundles/damaged/' || c_custkey AS _source_file,
            CASE c_custkey % 50 WHEN 24 THEN 'empty file' ELSE 'not valid JSON' END AS reason
        FROM customer WHERE c_custkey % 50 IN (7, 24, 49)""",
    "bronze_skipped_entries": """
        SELECT file AS _source_file, skipped FROM (SELECT file, CAST(k % 7 = 0 AS BIGINT) + CAST(k % 11 = 0 AS BIGINT)
            + CAST(k % 17 = 0 AS BIGINT) AS skipped FROM whole) WHERE skipped > 0""",
    # The text of every encounter's bundle, letter by letter, and of the empty files.
    "bronze_content_hash": f"""
        SELECT * FROM (WITH started AS (SELECT *, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS t0 FROM orders),
        texts AS (
            SELECT 'bundles/order/' || o_orderkey AS _source_file, '{{"resourceType":"Bundle","type":"transaction","entry":[{{"resource":'
                || '{{"resourceType":"Encounter","id":"ord-' || o_orderkey || '","subject":{{"reference":"Patient/cust-' || o_custkey || '"}},'
                || '"status":"' || CASE WHEN o_orderstatus = 'O' THEN 'in-progress' ELSE 'finished' END || '",'
                || '"class":{{"code":"' || CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EMER' WHEN '2' THEN 'IMP' WHEN '3' THEN 'AMB'
                    WHEN '4' THEN 'HH' ELSE 'VR' END || '"}},"type":[{{"coding":[{{"code":"T' || o_orderkey % 20 || '","display":"Type '
                || o_orderkey % 20 || '"}}]}}],"period":{{"start":"' || strftime(t0, '%Y-%m-%dT%H:%M:%S') || '+05:30"'
                || CASE WHEN o_orderstatus <> 'O' THEN ',"end":"' || strftime(t0 + to_minutes(CAST(o_orderkey % 240 AS INTEGER)),
                    '%Y-%m-%dT%H:%M:%S') || '+05:30"' ELSE '' END || '}}'
                || CASE WHEN o_orderkey % 3 = 0 THEN ',"participant":[{{"individual":{{"display":"Dr ' || o_orderkey % 50
                    || '","identifier":{{"system":"https://doctor.ndhm.gov.in","value":"HPR_' || o_orderkey % 50 || '"}}}}}}]' ELSE '' END
                || CASE WHEN o_custkey % 10 <> 1 THEN ',"serviceProvider":{{"display":"Facility ' || o_custkey % 100
                    || '","identifier":{{"system":"' || CASE WHEN o_custkey % 2 = 0 THEN 'https://facility.ndhm.gov.in","value":"HFR_'
                    ELSE 'https://other-registry.example.org","value":"OTHER_' END || o_custkey % 100 || '"}}}}' ELSE '' END
                || '}}}}]}}' AS text
            FROM started
            UNION ALL SELECT 'bundles/damaged/' || c_custkey, ' ' || chr(10) FROM customer WHERE c_custkey % 50 = 24)
        SELECT _source_file, sha256(text) AS _content_hash FROM texts)""",
    "bronze_route": "SELECT fhir_medication_request_id AS fhir_resource_id, status FROM medication",
    "bronze_new_files": """
        SELECT 'bundles/customer/' || c_custkey AS _source_file FROM customer
        WHERE c_custkey % 2 = 1
        UNION ALL SELECT 'bundles/damaged/' || c_custkey FROM customer WHERE c_custkey % 50 IN (7, 24, 49)""",
    "identifiers_exploded": """
        SELECT fhir_patient_id, 'urn:clinlake:registration' AS system, mrn AS value FROM patient
        UNION ALL SELECT fhir_patient_id, 'https://healthid.ndhm.gov.in', abha_id FROM patient WHERE abha_id IS NOT NULL""",
    # -- silver
    "silver_patient": "SELECT * EXCLUDE (k, nation, _source_file) FROM patient",
    "silver_encounter": "SELECT * EXCLUDE (o, k, _source_file) FROM encounter",
    "silver_condition": "SELECT * EXCLUDE (k, p, s, _source_file) FROM condition",
    "silver_medication_request": "SELECT * EXCLUDE (k, p, _source_file) FROM medication",
    "silver_observation": "SELECT * EXCLUDE (e, k, _source_file) FROM observation",
    # -- vocabulary
    "load_concept": "SELECT * FROM concept",
    "load_concept_active": "SELECT concept_id FROM concept WHERE valid_end_date = DATE '2099-12-31'",
    "load_relationship": "SELECT * FROM relationship WHERE valid_end_date = DATE '2099-12-31'",
    "concept_subset": """
        SELECT concept_id, concept_code FROM standard
        WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension') AND domain_id = 'Drug'""",
    "vocab_coverage": """
        SELECT vocabulary_id, count(*) AS concept_count, count(*) FILTER (WHERE standard_concept = 'S') AS standard_concepts,
            count(DISTINCT domain_id) AS domains FROM concept GROUP BY vocabulary_id""",
    "missing_vocabularies": """
        SELECT v AS vocabulary_id FROM (VALUES ('Gender'), ('Race'), ('SNOMED'), ('RxNorm'), ('LOINC'), ('UCUM')) r(v)
        WHERE v NOT IN (SELECT vocabulary_id FROM concept)""",
    "vocab_sample": """
        SELECT concept_id, concept_code, concept_name, domain_id FROM standard
        WHERE vocabulary_id = 'SNOMED' ORDER BY concept_id LIMIT 5""",
    "vocab_demographic": """
        SELECT concept_id, concept_code, concept_name, domain_id FROM concept WHERE vocabulary_id IN ('Gender', 'Race')""",
    "concept_fanout": """
        SELECT concept_code, count(*) AS concepts FROM standard WHERE vocabulary_id IN ('LOINC', 'SNOMED')
        GROUP BY concept_code HAVING count(*) > 1""",
    "concept_lookup_keys": """
        SELECT vocabulary, concept_code, min(concept_id) AS concept_id FROM (
            SELECT unnest(['RxNorm', '*']) AS vocabulary, concept_code, concept_id FROM standard
            WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension') AND domain_id = 'Drug') GROUP BY 1, 2""",
    "read_vocab_tsv": """
        SELECT vocabulary_id, standard_concept, valid_end_date, count(*) AS concepts,
            CAST(sum(concept_id) AS BIGINT) AS id_sum FROM raw_concept GROUP BY 1, 2, 3""",
    # -- joins
    "join_resolve_person": """
        SELECT fhir_encounter_id, p.fhir_patient_id AS resolved_patient FROM encounter e LEFT JOIN patient p ON e.k = p.k""",
    "join_resolve_visit": """
        SELECT fhir_observation_id, CASE WHEN visit_known THEN fhir_encounter_id END AS resolved_encounter FROM observed""",
    "map_demographics": "SELECT fhir_patient_id, gender_concept_id, race_concept_id FROM person",
    "map_visit_type": """
        SELECT fhir_encounter_id, encounter_class, visit_type_concept_id FROM encounter JOIN visit USING (o)""",
    "map_concept_any_vocabulary": """
        SELECT fhir_observation_id, coalesce(c.id, 0) AS concept FROM observation LEFT JOIN (
            SELECT concept_code, min(concept_id) AS id FROM obs_code GROUP BY 1) c ON observation_source_code = c.concept_code""",
    "map_concept_shuffled": "SELECT fhir_observation_id, observation_concept_id AS concept FROM observed",
    "map_value_concept": "SELECT fhir_observation_id, value_as_concept_id FROM observed",
    # -- gold
    "gold_person": "SELECT * EXCLUDE (k, fhir_patient_id, _source_file) FROM person",
    "gold_visit_occurrence": "SELECT * EXCLUDE (k, o, _source_file) FROM visit",
    "gold_condition_occurrence": "SELECT * EXCLUDE (k, _source_file) FROM cond",
    "gold_drug_exposure": "SELECT * EXCLUDE (k, _source_file) FROM drug",
    "gold_measurement": "SELECT * EXCLUDE (k, _source_file) FROM measurement",
    "gold_observation": "SELECT * EXCLUDE (k, _source_file) FROM omop_observation",
    "lineage_audit": "SELECT * FROM audit",
    "trace_lineage": """
        SELECT _source_file, _lineage_id, omop_table FROM audit
        WHERE _source_file IN (SELECT _source_file FROM audit GROUP BY 1 HAVING count(*) > 1)
        OR _source_file IN ('bundles/event/' || (SELECT max(event_id) FROM events WHERE event_type = 'purchase' AND event_id % 17 = 0),
            'bundles/order/' || (SELECT max(o_orderkey) FROM orders))""",
    "cdm_contract_violations": """
        SELECT 'person' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS violations FROM person
        UNION ALL SELECT replace(table_name, 'omop_', ''), count(*), count(*) FILTER (WHERE NOT person_known)
        FROM facts GROUP BY 1""",
    "cdm_dead_letters": """
        , judged AS (
            SELECT replace(table_name, 'omop_', '') AS t, CASE WHEN NOT person_known THEN 'required:person_id' END AS one,
                CAST(NULL AS VARCHAR) AS two FROM facts WHERE table_name <> 'omop_drug_exposure'
            UNION ALL SELECT 'drug_exposure', CASE WHEN NOT person_known THEN 'required:person_id' END,
                CASE WHEN CAST(drug_source_code AS BIGINT) % 10 = 0 THEN 'dates_ordered' END FROM drug
            UNION ALL SELECT 'person', CASE WHEN day_of_birth = 13 THEN 'required:person_id' END, NULL FROM person
            UNION ALL SELECT 'concept', CASE WHEN concept_id % 9 = 0 THEN 'required:concept_name' END, NULL FROM raw_concept
            UNION ALL SELECT 'concept_relationship', CASE WHEN concept_id_1 % 7 = 0 THEN 'dates_ordered' END, NULL FROM relationship
            UNION ALL SELECT 'care_site', NULL, NULL FROM (SELECT DISTINCT hfr_facility_code FROM encounter WHERE hfr_facility_code IS NOT NULL)
            UNION ALL SELECT 'location', CASE WHEN CAST(postal_code AS BIGINT) % 2 = 1 THEN 'type:country_concept_id' END, NULL
                FROM (SELECT DISTINCT state, postal_code FROM patient)
            UNION ALL SELECT 'provider', NULL, NULL FROM (SELECT DISTINCT o % 50 FROM encounter WHERE o % 3 = 0))
        SELECT t AS table_name, rule, count(*) AS rows FROM (
            SELECT t, one AS rule FROM judged WHERE one IS NOT NULL UNION ALL SELECT t, two FROM judged WHERE two IS NOT NULL)
        GROUP BY 1, 2
        UNION ALL SELECT t, 'kept', count(*) FILTER (WHERE one IS NULL AND two IS NULL) FROM judged GROUP BY 1""",
    # -- tables
    "upsert_latest": """
        SELECT fhir_encounter_id, CASE WHEN o % 5 = 0 THEN 'amended' WHEN o % 3 = 0 THEN 'corrected' ELSE status END AS status,
            encounter_class FROM encounter""",
    "upsert_out_of_order": """
        SELECT fhir_encounter_id, CASE WHEN o % 5 = 0 THEN 'amended' WHEN o % 3 = 0 THEN 'corrected' ELSE status END AS status,
            encounter_class FROM encounter""",
    "upsert_null_key_replay": """
        SELECT o % 7 = 0 AS nameless, encounter_class, count(*) AS count FROM encounter GROUP BY 1, 2""",
    "upsert_snapshot": """
        SELECT CASE WHEN o % 5 = 0 THEN 'amended' WHEN o % 3 = 0 THEN 'corrected' ELSE status END AS status,
            encounter_class, count(*) AS count FROM encounter GROUP BY 1, 2""",
    "upsert_buckets": """
        SELECT CASE WHEN o = (SELECT max(o) FROM encounter) THEN 'closed' WHEN o % 5 = 0 THEN 'amended' WHEN o % 3 = 0 THEN 'corrected'
            ELSE status END AS status, encounter_class, count(*) AS count, CAST(1 AS BIGINT) AS rewritten_buckets FROM encounter GROUP BY 1, 2""",
    "land_manifest": """
        SELECT 'landed' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) + CAST(sum(CAST(c_custkey % 4 = 0 AS INT)) AS BIGINT)
            + CAST(sum(CAST(c_custkey % 13 = 0 AS INT)) AS BIGINT) AS resources, CAST(0 AS BIGINT) AS damaged_files FROM customer
        UNION ALL SELECT 'damaged', 'not valid JSON', 0, count(*) FILTER (WHERE n_nationkey % 2 = 1) FROM nation
        UNION ALL SELECT 'empty', 'empty file', 0, count(*) FILTER (WHERE n_nationkey % 2 = 0) FROM nation""",
    # A resource id that comes twice is one row of its silver table.
    "gold_incremental_equals_full": " UNION ALL ".join(
        f"""SELECT 'omop_{name}' AS table_name, count(DISTINCT _lineage_id) AS row_count,
            count(DISTINCT CASE WHEN {known} THEN _lineage_id END) AS with_person, CAST(0 AS BIGINT) AS differing FROM {table}"""
        for name, table, known in [
            ("person", "person", "true"), ("visit_occurrence", "visit", "person_known"), ("condition_occurrence", "cond", "person_known"),
            ("drug_exposure", "drug", "person_known"), ("measurement", "measurement", "person_known"),
            ("observation", "omop_observation", "person_known"),
        ]
    ),
    "since_watermark": """
        SELECT 'corrected' AS status, count(*) AS count FROM encounter WHERE o % 3 = 0 OR o % 5 = 0
        UNION ALL SELECT 'amended', count(*) FROM encounter WHERE o % 5 = 0""",
    "partition_by_year": """
        SELECT year_start, count(*) AS visits, count(visit_end_date) AS ended FROM visit
        WHERE year_start BETWEEN 1996 AND 1998 GROUP BY 1""",
    "cluster_by_keys": """
        SELECT fhir_patient_id, count(*) AS encounters, min(CAST(period_start AS DATE)) AS first_day,
            max(CAST(period_start AS DATE)) AS last_day FROM encounter GROUP BY 1""",
    "cluster_z_order": "SELECT count(*) AS encounters, true AS patient_skips, true AS day_skips FROM encounter",
    "table_create_replace": "SELECT gender_code, count(*) AS patients FROM patient GROUP BY 1",
    "vocab_tsv_inferred": """
        SELECT 'bigint' AS id_type, 'string' AS name_type, true AS absent_is_none, count(*) AS concepts FROM raw_concept""",
    # -- streaming
    "stream_bronze": """
        SELECT 'Patient' AS resource_type, 'cust-' || c_custkey AS fhir_resource_id FROM customer
        UNION ALL SELECT 'Consent', 'consent-' || c_custkey FROM customer WHERE c_custkey % 4 = 0
        UNION ALL SELECT 'Basic', NULL FROM customer WHERE c_custkey % 13 = 0""",
    "stream_upsert": "SELECT fhir_patient_id, birth_date, gender_code, abha_id, is_deceased FROM all_patient",
    # -- quality
    "quality_bronze_nulls": """
        SELECT count(*) AS total, CAST(0 AS BIGINT) AS null_resource_type,
            count(*) FILTER (WHERE fhir_resource_id IS NULL) AS null_fhir_resource_id, CAST(0 AS BIGINT) AS null_lineage_id
        FROM resources""",
    "quality_consent_count": "SELECT count(*) AS consent_count FROM resources WHERE resource_type = 'Consent'",
    "quality_person_required": """
        SELECT person_source_value FROM person WHERE k % 9 = 0""",
    "quality_drug_dates_ordered": """
        SELECT _lineage_id FROM drug WHERE stop_reason = 'Stopped'""",
    "quality_condition_coverage": f"""
        SELECT count(*) AS total, count(*) FILTER (WHERE condition_concept_id > 0) AS mapped,
            count(*) FILTER (WHERE condition_concept_id = 0) AS unmapped, {_pct('condition_concept_id > 0')} AS coverage_pct
        FROM cond""",
    "quality_mapping_rates": f"""
        SELECT table_name, count(*) FILTER (WHERE c > 0) AS mapped, count(*) AS total, {_pct('c > 0')} AS pct
        FROM mapped GROUP BY 1""",
    "quality_row_counts": """
        SELECT 'omop_' || omop_table AS table_name, count(*) AS row_count FROM audit GROUP BY 1
        UNION ALL SELECT 'TOTAL', count(*) FROM audit""",
    "quality_silver_counts": """
        SELECT 'silver_patient' AS table_name, count(*) AS row_count, CAST(14 AS BIGINT) AS column_count FROM patient
        UNION ALL SELECT 'silver_encounter', count(*), 15 FROM encounter
        UNION ALL SELECT 'silver_condition', count(*), 12 FROM condition
        UNION ALL SELECT 'silver_medication_request', count(*), 14 FROM medication
        UNION ALL SELECT 'silver_observation', count(*), 20 FROM observation""",
    "quality_abha_coverage": f"""
        SELECT count(*) AS total_patients, count(abha_id) AS with_abha, count(*) - count(abha_id) AS without_abha,
            {_pct('abha_id IS NOT NULL')} AS abha_coverage_pct FROM patient""",
    "quality_hfr_coverage": f"""
        SELECT 'HFR Facility Code' AS field, count(hfr_facility_code) AS present, count(*) AS total,
            {_pct('hfr_facility_code IS NOT NULL')} AS coverage_pct FROM encounter""",
    "quality_abha_format": f"""
        SELECT fhir_patient_id, abha_id, CAST(length(replace(abha_id, '-', '')) AS INTEGER) AS digit_count,
            CASE WHEN abha_id IS NULL THEN 'Missing' WHEN {_valid('abha_id')} THEN 'Valid' ELSE 'Invalid' END AS abha_status
        FROM patient""",
    "quality_person_source_uniqueness": """
        SELECT count(*) AS total_persons, count(DISTINCT person_source_value) AS unique_person_sources,
            count(*) - count(DISTINCT person_source_value) AS duplicate_sources FROM person""",
    "quality_abha_persons": f"""
        SELECT person_source_value, gender_source_value, year_of_birth, _source_file FROM person
        WHERE {_valid('person_source_value')}""",
    "quality_abha_fallback": f"""
        SELECT count(*) AS fallback_persons, count(DISTINCT _lineage_id) AS unique_bundles FROM person
        WHERE NOT {_valid('person_source_value')}""",
    "quality_value_type_distribution": """
        SELECT CASE WHEN value_quantity IS NOT NULL THEN 'valueQuantity' WHEN value_concept_code IS NOT NULL
            THEN 'valueCodeableConcept' WHEN value_string IS NOT NULL THEN 'valueString' ELSE 'no_value' END AS value_type,
            category, count(*) AS count FROM observation GROUP BY 1, 2""",
    "quality_unresolved_references": """
        SELECT table_name, count(*) AS total, count(*) FILTER (WHERE NOT person_known) AS without_person,
            CAST(0 AS BIGINT) AS dangling FROM facts GROUP BY 1""",
    # -- reports
    "report_bronze_type_distribution": "SELECT resource_type, count(*) AS record_count FROM resources GROUP BY 1",
    "report_patient_spot_check": """
        SELECT fhir_patient_id AS patient_id, CAST(birth_date AS VARCHAR) AS birth_date, gender_code AS gender,
            CASE WHEN abha_id IS NULL THEN 'urn:clinlake:registration'
                 WHEN k % 2 = 0 THEN 'https://healthid.ndhm.gov.in, urn:clinlake:registration'
                 ELSE 'urn:clinlake:registration, https://healthid.ndhm.gov.in' END AS identifier_systems
        FROM patient ORDER BY fhir_patient_id LIMIT 5""",
    "report_person_stats": """
        SELECT count(*) AS total_persons, count(DISTINCT k) AS unique_persons,
            count(*) FILTER (WHERE gender_concept_id > 0) AS persons_with_gender,
            count(*) FILTER (WHERE race_concept_id > 0) AS persons_with_race,
            count(year_of_birth) AS persons_with_birth_year FROM person""",
    "report_gender_coverage": _counts("person", "gender_source_value, gender_concept_id"),
    "report_race_coverage": _counts(
        "person", "race_source_value, race_concept_id", "race_source_value IS NOT NULL OR race_concept_id > 0"
    ),
    "report_person_sample": """
        SELECT person_source_value, year_of_birth, gender_source_value FROM person ORDER BY person_source_value LIMIT 10""",
    "report_condition_stats": f"""
        SELECT count(*) AS total_conditions, count(*) FILTER (WHERE condition_concept_id > 0) AS mapped_conditions,
            {_pct('condition_concept_id > 0')} AS coverage_pct,
            count(*) FILTER (WHERE condition_concept_id = 0) AS unmapped_conditions FROM cond""",
    "report_top_conditions": _counts(
        "cond", "condition_source_code, condition_source_display, condition_concept_id", "condition_concept_id > 0", 10
    ),
    "report_condition_status": _counts("cond", "condition_status_source_value"),
    "report_top_unmapped_conditions": _counts(
        "cond", "condition_source_code, condition_source_display", "condition_concept_id = 0", 10
    ),
    "report_drug_stats": f"""
        SELECT count(*) AS total_drug_exposures, count(*) FILTER (WHERE drug_concept_id > 0) AS mapped_drugs,
            {_pct('drug_concept_id > 0')} AS coverage_pct,
            count(*) FILTER (WHERE drug_concept_id = 0) AS unmapped_drugs FROM drug""",
    "report_top_drugs": _counts(
        "drug", "drug_source_code, drug_source_display, drug_concept_id", "drug_concept_id > 0", 10
    ),
    "report_stop_reasons": _counts("drug", "stop_reason"),
    "report_dosage_groups": _counts(
        "drug", "drug_source_display, quantity, dose_unit_source_value, effective_drug_dose", "quantity IS NOT NULL", 10
    ),
    "report_top_unmapped_drugs": _counts("drug", "drug_source_code, drug_source_display", "drug_concept_id = 0", 10),
    "report_measurement_stats": f"""
        SELECT count(*) AS total_measurements, count(*) FILTER (WHERE measurement_concept_id > 0) AS mapped_measurements,
            {_pct('measurement_concept_id > 0')} AS coverage_pct,
            count(DISTINCT observation_source_code) AS unique_measurement_codes FROM measurement""",
    # The mean of cents, rounded half up in integers.
    "report_top_measurements": """
        SELECT observation_source_code, observation_source_display, unit_source_value, n AS count,
            ((2 * cents + n) // (2 * n)) / 100.0 AS avg_value
        FROM (SELECT observation_source_code, observation_source_display, unit_source_value, count(*) AS n,
                CAST(sum(CAST(round(value_as_number * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM measurement WHERE measurement_concept_id > 0 GROUP BY 1, 2, 3)
        ORDER BY n DESC, 1, 2, 3 LIMIT 10""",
    "report_observation_stats": f"""
        SELECT count(*) AS total_observations, count(*) FILTER (WHERE observation_concept_id > 0) AS mapped_observations,
            {_pct('observation_concept_id > 0')} AS coverage_pct, count(value_as_string) AS text_observations,
            count(*) FILTER (WHERE value_as_concept_id > 0) AS coded_observations FROM omop_observation""",
    "report_top_coded_observations": _counts(
        "omop_observation", "observation_source_code, observation_source_display, value_as_string",
        "value_as_concept_id > 0", 10,
    ),
    "report_top_text_observations": _counts(
        "omop_observation", "observation_source_code, observation_source_display, value_as_string",
        "value_as_string IS NOT NULL", 10,
    ),
    "report_visit_stats": """
        SELECT count(*) AS total_visits, count(DISTINCT CASE WHEN person_known THEN k END) AS unique_persons,
            round(avg(duration_minutes), 1) AS avg_duration_minutes,
            count(*) FILTER (WHERE visit_type_concept_id > 0) AS mapped_visit_types FROM visit""",
    "report_visit_types": """
        SELECT visit_source_value AS encounter_class, visit_type_concept_id, count(*) AS count FROM visit GROUP BY 1, 2""",
    "report_visit_dates": """
        SELECT CAST(visit_start_date AS VARCHAR) AS start_date, CAST(visit_end_date AS VARCHAR) AS end_date,
            CAST(date_diff('day', visit_start_date, visit_end_date) * 1440 AS INTEGER) AS duration_minutes,
            encounter_type_display FROM visit ORDER BY visit_start_datetime, _lineage_id LIMIT 20""",
    "report_facility_visits": """
        SELECT hfr_facility_code, facility_name, count(*) AS visit_count FROM visit WHERE hfr_facility_code IS NOT NULL
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "report_mapped_samples": " UNION ALL ".join(
        [
            _SAMPLE.format(kind="condition", prefix="condition", concept="condition_concept_id", table="cond"),
            _SAMPLE.format(kind="drug", prefix="drug", concept="drug_concept_id", table="drug"),
            _SAMPLE.format(
                kind="measurement", prefix="observation", concept="measurement_concept_id", table="measurement"
            ),
        ]
    ),
    "report_visit_record_counts": """
        SELECT coalesce(c.n, 0) AS condition_count, coalesce(d.n, 0) AS drug_count, v.o IS NOT NULL AS has_visit,
            count(*) AS pairs
        FROM person p LEFT JOIN visit v ON p.k = v.k
        LEFT JOIN (SELECT k, count(DISTINCT _lineage_id) AS n FROM cond GROUP BY k) c ON p.k = c.k
        LEFT JOIN (SELECT k, count(DISTINCT _lineage_id) AS n FROM drug GROUP BY k) d ON p.k = d.k GROUP BY 1, 2, 3""",
    # -- extensions
    "ext_consent_audit": f"""
        SELECT 'consent-' || k AS fhir_consent_id, 'cust-' || k AS fhir_patient_id,
            CASE WHEN k % 16 = 0 THEN 'inactive' ELSE 'active' END AS status, 'HIPS' AS scope_code,
            TIMESTAMP '2023-12-31 18:30:00' AS consent_datetime, 'org-' || k % 7 AS organization_id,
            'https://example.org/privacy-policy' AS policy_uri, {_lineage('file', "'consent-' || k")} AS _lineage_id
        FROM whole WHERE k % 8 = 0""",
    "ext_care_site": """
        SELECT hfr_facility_code AS care_site_source_value, min(facility_name) AS care_site_name FROM encounter
        WHERE hfr_facility_code IS NOT NULL GROUP BY 1""",
    "ext_care_site_id": "SELECT fhir_encounter_id, hfr_facility_code IS NOT NULL AS has_care_site FROM encounter",
    "ext_visit_references": """
        SELECT _lineage_id, hfr_facility_code AS care_site_source_value,
            CASE WHEN hfr_facility_code IS NOT NULL THEN min(facility_name) OVER (PARTITION BY hfr_facility_code) END AS care_site_name,
            practitioner_code AS provider_source_value,
            CASE WHEN practitioner_code IS NOT NULL THEN 'Dr ' || o % 50 END AS provider_name,
            hfr_facility_code IS NOT NULL AS has_care_site, practitioner_code IS NOT NULL AS has_provider
        FROM encounter""",
    "ext_person_locations": """
        SELECT _lineage_id, state, postal_code AS zip, coalesce(state, postal_code) IS NOT NULL AS has_location FROM patient""",
    "ext_location": "SELECT DISTINCT state, postal_code AS zip FROM patient",
    "ext_location_id": "SELECT state, postal_code AS zip, count(*) AS patients FROM patient GROUP BY 1, 2",
    "ext_provider": """
        SELECT DISTINCT 'HPR_' || o % 50 AS provider_source_value, 'Dr ' || o % 50 AS provider_name FROM encounter
        WHERE o % 3 = 0""",
    "ext_map_source_to_standard": """
        SELECT fhir_condition_id, coalesce(m.id, 0) AS standard_concept_id FROM condition LEFT JOIN (
            SELECT s.concept_code, min(t.concept_id) AS id FROM raw_concept s
            JOIN relationship r ON s.concept_id = r.concept_id_1 JOIN raw_concept t ON t.concept_id = r.concept_id_2
            WHERE s.vocabulary_id = 'ICD10' AND r.relationship_id = 'Maps to' AND t.standard_concept = 'S'
                AND r.valid_end_date = DATE '2099-12-31' GROUP BY 1) m
            ON condition_source_code = m.concept_code AND condition_source_vocabulary = 'http://hl7.org/fhir/sid/icd-10'""",
    "ext_drug_name_normalize": """
        SELECT fhir_medication_request_id, lower(trim(b.p_name)) AS ingredient, coalesce(i.id, 0) AS ingredient_concept_id,
            coalesce(i.id, 0) = 0 AS is_unmapped
        FROM medication m LEFT JOIN part b ON b.p_partkey = m.p
        LEFT JOIN (SELECT lower(trim(concept_name)) AS name, min(concept_id) AS id FROM standard
            WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension') GROUP BY 1) i ON i.name = lower(trim(b.p_name))""",
    "ext_abha_dedup": f"""
        SELECT count(*) AS patients, count(DISTINCT CASE WHEN {_valid('abha_id')} THEN abha_id ELSE fhir_patient_id END) AS persons
        FROM patient""",
    "ext_identity_components": f"""
        , held AS (
            SELECT fhir_patient_id AS p, 'n' || abha_id AS i FROM patient WHERE {_valid('abha_id')}
            UNION SELECT fhir_patient_id, 'i' || k // 4 FROM patient WHERE k % 4 <> 3
            UNION SELECT fhir_patient_id, 'i' || (k // 4 - 1) FROM patient WHERE k % 4 = 0 AND k % 40 <> 0),
        reach AS (
            SELECT fhir_patient_id AS p, fhir_patient_id AS q FROM patient
            UNION SELECT r.p, b.p FROM reach r JOIN held a ON a.p = r.q JOIN held b ON b.i = a.i)
        SELECT p AS fhir_patient_id, min(q) AS holder FROM reach GROUP BY 1""",
    "ext_map_source_to_standards": """
        , edge AS (
            SELECT concept_id_1 AS a, concept_id_2 AS b FROM relationship
            WHERE relationship_id = 'Maps to' AND valid_end_date = DATE '2099-12-31'
            UNION SELECT 4000000000 + p_partkey, 500000000 + p_partkey FROM part WHERE p_partkey % 4 = 0),
        target AS (
            SELECT DISTINCT s.concept_code, t.concept_id FROM raw_concept s JOIN edge ON s.concept_id = a
            JOIN raw_concept t ON t.concept_id = b
            WHERE s.vocabulary_id = 'ICD10' AND t.standard_concept = 'S'),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY concept_code ORDER BY concept_id) AS number,
                count(*) OVER (PARTITION BY concept_code) AS n FROM target)
        SELECT fhir_condition_id, coalesce(concept_id, 0) AS standard_concept_id, coalesce(number, 1) AS target_no,
            coalesce(n, 0) AS target_count
        FROM condition LEFT JOIN numbered
            ON condition_source_code = concept_code AND condition_source_vocabulary = 'http://hl7.org/fhir/sid/icd-10'""",
    "ext_drug_ingredients": r"""
        , stands AS (
            SELECT p_partkey AS p, lower(trim(p_name)) AS ingredient FROM part
            UNION SELECT p_partkey, lower(trim(p_type)) FROM part WHERE p_partkey % 3 = 0),
        named AS (
            SELECT m.p, min(s.p) AS place, s.ingredient
            FROM (SELECT DISTINCT p FROM medication) m JOIN stands s ON s.p IN (m.p, m.p + 1) GROUP BY ALL),
        known AS (
            SELECT lower(trim(concept_name)) AS ingredient, min(concept_id) AS concept FROM standard
            WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension') GROUP BY 1),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY place, ingredient) AS number FROM named)
        SELECT m.fhir_medication_request_id, coalesce(number, 1) AS ingredient_no,
            n.ingredient, coalesce(concept, 0) AS ingredient_concept_id, concept IS NULL AS is_unmapped,
            CASE WHEN m.p IN (SELECT p_partkey FROM part) THEN 0 ELSE 2 END
                + CAST(CASE WHEN m.p + 1 IN (SELECT p_partkey FROM part) THEN 0 ELSE 2 END AS BIGINT) AS unmatched_words
        FROM medication m LEFT JOIN numbered n ON n.p = m.p LEFT JOIN known USING (ingredient)""",
    "ext_abha_duplicates": f"""
        SELECT abha_id, count(*) AS patients FROM patient WHERE {_valid('abha_id')} GROUP BY 1 HAVING count(*) > 1""",
    # -- scalar functions
    "functions_scalar": """
        SELECT fhir_observation_id AS id, CASE WHEN value_quantity IS NOT NULL THEN 'valueQuantity'
            WHEN value_concept_code IS NOT NULL THEN 'valueCodeableConcept' WHEN value_string IS NOT NULL THEN 'valueString'
            ELSE 'no_value' END AS value_type, length(replace(fhir_observation_id, '-', '')) AS digits FROM observation""",
    "functions_has_profile": """
        SELECT resource_type, is_consent, count(*) AS count FROM (
            SELECT 'Patient' AS resource_type, false AS is_consent FROM whole
            UNION ALL SELECT 'Basic', false FROM whole WHERE k % 13 = 0
            UNION ALL SELECT 'Consent', k % 8 = 0 FROM whole WHERE k % 4 = 0) GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    shared = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    return {name: f"WITH RECURSIVE {shared}\n{body}" for name, body in _BODIES.items()}
