"""Clinical bundles and a vocabulary derived from the driver's relational tables.

The driver's tables hold no clinical data. Here every customer becomes a patient, every order
an encounter, every order line a condition or a prescription, every event an observation and
every part a set of concepts. Each source row gives one bundle text, by expressions on that row
alone, so the derivation is a narrow map at any size and no group of rows is ever gathered.
Only order lines need one join, to learn their patient.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import bronze, gold, joins, silver, vocab
from clinlake.sources import tables

# SQL texts of the derivation. One text is one call to the JVM, where a tree of column
# objects would be hundreds.

def _entry(resource: str) -> str:
    return f"concat('{{\"resource\":', to_json({resource}), '}}')"


def _bundle(entries: str) -> str:
    """Bundle text of the entries that are not null. ``array_join`` leaves nulls out; a filter by a lambda would keep all of the text from being compiled."""
    return f"concat('{{\"resourceType\":\"Bundle\",\"type\":\"transaction\",\"entry\":[', array_join({entries}, ','), ']}}')"


def _iso(ts: str) -> str:
    """Wall-clock text of a timestamp with the source's offset."""
    return f"concat(replace(CAST({ts} AS STRING), ' ', 'T'), '+05:30')"


def _coding(system: str, code: str, display: str) -> str:
    return (
        f"named_struct('coding', array(named_struct('system', {system}, 'code', CAST({code} AS STRING), "
        f"'display', {display})))"
    )


# Customers 9 of 60 are a second registration of the patient three keys before.
HOLDER = "IF(c_custkey % 60 = 9, c_custkey - 3, c_custkey)"
HEALTH_ID = f"""CASE WHEN c_custkey % 30 = 0 THEN concat('ABHA', c_custkey) ELSE concat(
    '91-', lpad(CAST({HOLDER} % 10000 AS STRING), 4, '0'),
    '-', lpad(CAST({HOLDER} * 7 % 10000 AS STRING), 4, '0'),
    '-', lpad(CAST({HOLDER} * 13 % 10000 AS STRING), 4, '0')) END"""
IDENTIFIERS = f"""transform(
    CASE WHEN c_custkey % 3 <> 0 THEN array('mrn') WHEN c_custkey % 2 = 0 THEN array('health', 'mrn')
         ELSE array('mrn', 'health') END,
    kind -> IF(kind = 'mrn',
        named_struct('system', 'urn:clinlake:registration', 'value', concat('MRN-', c_custkey)),
        named_struct('system', '{config.HEALTH_ID_SYSTEM}', 'value', {HEALTH_ID})))"""
EXTENSIONS = f"""transform(
    IF(c_custkey % 2 = 0, array('race'), array('other', 'race')),
    kind -> named_struct(
        'url', IF(kind = 'race', '{config.RACE_EXTENSION}', 'http://hl7.org/fhir/StructureDefinition/patient-religion'),
        'extension', array(named_struct('url', kind, 'valueCoding', named_struct(
            'code', CASE WHEN kind = 'race' THEN IF(c_nationkey % 10 = 0, '2028-9', '9999-9') END)))))"""
PATIENT = f"""named_struct(
    'resourceType', 'Patient', 'id', concat('cust-', c_custkey),
    'identifier', {IDENTIFIERS},
    'name', array(named_struct('family', c_name)),
    'gender', CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END,
    'birthDate', CAST(date_add(DATE'1940-01-01', CAST(c_custkey * 17 % 25000 AS INT)) AS STRING),
    'address', array(named_struct(
        'state', concat('STATE_', c_nationkey), 'postalCode', CAST(c_custkey % 900 + 100000 AS STRING))),
    'extension', CASE WHEN c_nationkey % 5 = 0 THEN {EXTENSIONS} END,
    'deceasedBoolean', CASE c_custkey % 10 WHEN 1 THEN true WHEN 3 THEN false END,
    'deceasedDateTime', CASE WHEN c_custkey % 10 = 2 THEN
        concat(date_add(DATE'2021-01-01', CAST(c_custkey % 365 AS INT)), 'T01:00:00+05:30') END)"""
CONSENT = f"""named_struct(
    'resourceType', 'Consent', 'id', concat('consent-', c_custkey),
    'meta', named_struct('profile', array(IF(c_custkey % 8 = 0, '{config.CONSENT_PROFILE}', 'http://example.org/consent'))),
    'status', IF(c_custkey % 16 = 0, 'inactive', 'active'),
    'scope', named_struct('coding', array(named_struct('system', 'http://example.org/scope', 'code', 'HIPS'))),
    'patient', named_struct('reference', concat('Patient/cust-', c_custkey)),
    'dateTime', '2024-01-01T00:00:00+05:30',
    'organization', array(named_struct('reference', concat('Organization/org-', c_custkey % 7))),
    'policy', array(named_struct('uri', 'https://example.org/privacy-policy')))"""
# Besides the patient: a consent, and entries that carry nothing to route.
PATIENT_ENTRIES = f"""array(
    {_entry(PATIENT)},
    CASE WHEN c_custkey % 4 = 0 THEN {_entry(CONSENT)} END,
    CASE WHEN c_custkey % 7 = 0 THEN '{{"fullUrl":"urn:uuid:none"}}' END,
    CASE WHEN c_custkey % 11 = 0 THEN '{{"resource":{{"id":"untyped"}}}}' END,
    CASE WHEN c_custkey % 13 = 0 THEN '{{"resource":{{"resourceType":"Basic"}}}}' END,
    CASE WHEN c_custkey % 17 = 0 THEN '5' END)"""
PATIENT_BUNDLE = _bundle(PATIENT_ENTRIES)
# Besides every customer's whole bundle, a damaged copy of some: cut off, empty, or followed by more text.
DAMAGED_BUNDLE = f"""CASE c_custkey % 50 WHEN 49 THEN substring({PATIENT_BUNDLE}, 1, 200) WHEN 24 THEN ' \n'
    WHEN 7 THEN concat({PATIENT_BUNDLE}, ' more') END"""

START = "CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, CAST(o_orderkey % 1440 AS INT))"
ENCOUNTER = f"""named_struct(
    'resourceType', 'Encounter', 'id', concat('ord-', o_orderkey),
    'subject', named_struct('reference', concat('Patient/cust-', o_custkey)),
    'status', IF(o_orderstatus = 'O', 'in-progress', 'finished'),
    'class', named_struct('code', CASE substring(o_orderpriority, 1, 1)
        WHEN '1' THEN 'EMER' WHEN '2' THEN 'IMP' WHEN '3' THEN 'AMB' WHEN '4' THEN 'HH' ELSE 'VR' END),
    'type', array(named_struct('coding', array(named_struct(
        'code', concat('T', o_orderkey % 20), 'display', concat('Type ', o_orderkey % 20))))),
    'period', named_struct('start', {_iso(START)}, 'end', CASE WHEN o_orderstatus <> 'O' THEN
        {_iso(f"({START} + make_dt_interval(0, 0, CAST(o_orderkey % 240 AS INT)))")} END),
    'participant', CASE WHEN o_orderkey % 3 = 0 THEN array(named_struct('individual', named_struct(
        'display', concat('Dr ', o_orderkey % 50),
        'identifier', named_struct('system', '{config.PRACTITIONER_SYSTEM}', 'value', concat('HPR_', o_orderkey % 50))))) END,
    'serviceProvider', CASE WHEN o_custkey % 10 <> 1 THEN named_struct(
        'display', concat('Facility ', o_custkey % 100),
        'identifier', named_struct(
            'system', IF(o_custkey % 2 = 0, '{config.FACILITY_SYSTEM}', 'https://other-registry.example.org'),
            'value', concat(IF(o_custkey % 2 = 0, 'HFR_', 'OTHER_'), o_custkey % 100))) END)"""

# Order key and line number alone are not unique.
LINE_ID = "concat('{}-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"
CONDITION_ID, MEDICATION_ID = LINE_ID.format("cond"), LINE_ID.format("med")
SHIPPED = "CAST(l_shipdate AS DATE)"
CONDITION_SYSTEM = """CASE l_suppkey % 10 WHEN 0 THEN 'http://hl7.org/fhir/sid/icd-10' WHEN 1 THEN NULL
    ELSE 'http://snomed.info/sct' END"""
CONDITION = f"""named_struct(
    'resourceType', 'Condition', 'id', {CONDITION_ID},
    'subject', named_struct('reference', concat('Patient/cust-', o_custkey)),
    'code', {_coding(CONDITION_SYSTEM, "l_partkey", "concat('Part ', l_partkey)")},
    'onsetDateTime', CASE WHEN l_linenumber % 3 = 0 THEN CAST({SHIPPED} AS STRING) END,
    'onsetPeriod', CASE WHEN l_linenumber % 3 = 1 THEN named_struct('start', CAST({SHIPPED} AS STRING)) END,
    'recordedDate', CAST(date_add({SHIPPED}, 1) AS STRING),
    'clinicalStatus', named_struct('coding', array(named_struct('code', IF(l_linestatus = 'F', 'resolved', 'active')))),
    'verificationStatus', named_struct('coding', array(named_struct('code', 'confirmed'))))"""
MEDICATION = f"""named_struct(
    'resourceType', 'MedicationRequest', 'id', {MEDICATION_ID},
    'subject', named_struct('reference', concat('Patient/cust-', o_custkey)),
    'medicationCodeableConcept',
        {_coding("'http://www.nlm.nih.gov/research/umls/rxnorm'", "l_partkey", "concat('Part ', l_partkey)")},
    'authoredOn', CAST({SHIPPED} AS STRING),
    'status', CASE l_linenumber WHEN 1 THEN 'stopped' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'on-hold' ELSE 'active' END,
    'intent', 'order',
    'dosageInstruction', CASE WHEN l_linenumber <> 7 THEN array(named_struct(
        'timing', named_struct('repeat', named_struct(
            'frequency', l_linenumber, 'period', l_suppkey % 3, 'periodUnit', IF(l_suppkey % 5 = 0, 'h', 'd'))),
        'doseAndRate', array(named_struct('doseQuantity', named_struct('value', l_quantity, 'unit', 'mg'))))) END)"""

CODE = "get_json_object(props, '$.k')"
OBSERVATION = f"""named_struct(
    'resourceType', 'Observation', 'id', concat('evt-', event_id),
    'subject', named_struct('reference', concat('Patient/cust-', user_id)),
    'encounter', CASE WHEN event_id % 2 = 0 THEN named_struct('reference', concat('Encounter/ord-', event_id * 2)) END,
    'status', IF(event_type = 'error', 'registered', 'final'),
    'category', array(named_struct('coding', array(named_struct('code', CASE
        WHEN event_type IN ('purchase', 'view') THEN 'vital-signs' WHEN event_type = 'click' THEN 'laboratory'
        ELSE 'social-history' END)))),
    'code', {_coding("IF(event_id % 5 = 0, 'http://snomed.info/sct', 'http://loinc.org')", CODE, f"concat('Code ', {CODE})")},
    'effectiveDateTime', CASE WHEN event_id % 4 <> 1 THEN {_iso("CAST(ts AS TIMESTAMP_NTZ)")} END,
    'effectivePeriod', CASE WHEN event_id % 4 = 1 THEN named_struct('start', {_iso("CAST(ts AS TIMESTAMP_NTZ)")}) END,
    'valueQuantity', CASE
        WHEN event_type = 'view' THEN named_struct('value', value, 'unit', 'beats/minute', 'code', '/min')
        WHEN event_type = 'purchase' THEN named_struct('value', value, 'unit', 'milligrams', 'code', 'mg') END,
    'valueCodeableConcept', CASE WHEN event_type = 'click' OR (event_type = 'purchase' AND event_id % 17 = 0) THEN
        named_struct('coding', array(named_struct('code', {CODE}, 'display', concat('Value ', {CODE})))) END,
    'valueString', CASE WHEN event_type = 'signup' THEN concat('text ', event_id % 5) END,
    'referenceRange', CASE WHEN event_id % 3 = 0 THEN array(named_struct(
        'low', named_struct('value', 10.5D), 'high', named_struct('value', 100D))) END)"""


def _concept(present: str, base: int, vocabulary: str, domain: str, standard: str) -> str:
    return f"""CASE WHEN {present} THEN named_struct(
        'concept_id', {base}L + p_partkey, 'concept_name', p_name, 'domain_id', {domain},
        'vocabulary_id', '{vocabulary}', 'concept_class_id', p_type, 'standard_concept', {standard},
        'concept_code', CAST(p_partkey AS STRING), 'valid_start_date', DATE'1970-01-01',
        'valid_end_date', IF(p_partkey % 13 = 0, DATE'2015-12-31', DATE'{config.OPEN_END_DATE}'),
        'invalid_reason', CASE WHEN p_partkey % 13 = 0 THEN 'D' END) END"""


# The concepts a part stands for; the same code appears in several vocabularies.
CONCEPTS = f"""filter(array(
    {_concept("p_partkey % 3 <> 0", 500_000_000, "LOINC", "IF(p_partkey % 2 = 0, 'Measurement', 'Observation')", "'S'")},
    {_concept("p_partkey % 5 <> 0", 1_000_000_000, "SNOMED", "IF(p_size % 10 = 0, 'Procedure', 'Condition')",
              "CASE WHEN p_partkey % 11 <> 0 THEN 'S' END")},
    {_concept("p_partkey % 4 <> 0", 2_000_000_000, "RxNorm", "IF(p_size % 7 = 0, 'Device', 'Drug')", "'S'")},
    {_concept("p_partkey % 6 = 0", 3_000_000_000, "RxNorm Extension", "'Drug'", "'S'")},
    {_concept("p_partkey % 2 = 0", 4_000_000_000, "ICD10", "'Condition'", "CAST(NULL AS STRING)")}
), c -> c IS NOT NULL)"""


# Concepts of the demographic vocabularies (id, name, vocabulary, code).
DEMOGRAPHIC_CONCEPTS = [
    (8507, "MALE", "Gender", "M"),
    (8532, "FEMALE", "Gender", "F"),
    (8515, "Asian", "Race", "2028-9"),
    (8527, "White", "Race", "2106-3"),
]


#: Orders of at most so many are broadcast to their lines: two numbers each, 45 bytes a row in the driver.
FEW_ORDERS = 1_000_000


class Workload:
    """Lazy frames of one data folder, from bundle texts to gold tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self.loaded_at = F.lit("2024-02-01T00:00:00Z").cast("timestamp")
        self.transformed_at = F.lit("2024-02-02T00:00:00Z").cast("timestamp")

    def table(self, name: str) -> DataFrame:
        """A driver table. One that lies in fewer pieces than there are cores is dealt over
        them, since building and parsing JSON costs far more than moving the narrow rows."""
        if name not in self._tables:
            df = self._read(name)
            cores = self.spark.sparkContext.defaultParallelism
            self._tables[name] = df.repartition(cores) if self._pieces(df) < cores else df
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _pieces(df: DataFrame) -> int:
        """Scan partitions that can hold rows: no more than the files allow."""
        return min(df.rdd.getNumPartitions(), 8 * len(df.inputFiles()))

    # -- bundles --------------------------------------------------------------------

    def _bundles(self, rows: DataFrame, folder: str, key: str, bundle_json: str) -> DataFrame:
        named = rows.selectExpr(f"{bundle_json} AS bundle_json", f"concat('bundles/{folder}/', {key}) AS _source_file")
        return named.select(
            "bundle_json", "_source_file", self.loaded_at.alias("_loaded_at"),
            X.content_hash(F.col("bundle_json")).alias("_content_hash"),
        )

    def _single(self, rows: DataFrame, folder: str, key: str, resource: str) -> DataFrame:
        return self._bundles(rows, folder, key, _bundle(f"array({_entry(resource)})"))

    @cached_property
    def customer_bundles(self) -> DataFrame:
        """Patients and consents."""
        return self._bundles(self.table("customer"), "customer", "c_custkey", PATIENT_BUNDLE)

    @cached_property
    def damaged_bundles(self) -> DataFrame:
        """Copies of patient bundles that give nothing."""
        damaged = self._bundles(self.table("customer"), "damaged", "c_custkey", DAMAGED_BUNDLE)
        return damaged.filter("bundle_json IS NOT NULL")

    @cached_property
    def order_bundles(self) -> DataFrame:
        return self._single(self.table("orders"), "order", "o_orderkey", ENCOUNTER)

    def _lines(self, flags: str) -> DataFrame:
        """Order lines with their patient, dealt out after the join and not before it.

        Adaptive execution gives a join about one partition more than there are cores, and building and parsing JSON there
        would run as two waves of tasks, the second nearly empty. Several tasks a core keep all of them busy.
        """
        orders = self._read("orders").select("o_orderkey", "o_custkey")
        orders = F.broadcast(orders) if orders.count() <= FEW_ORDERS else joins.not_broadcast(orders)
        lines = self._read("lineitem").filter(f"l_returnflag IN ({flags})")
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.repartition(4 * self.spark.sparkContext.defaultParallelism)

    @cached_property
    def condition_bundles(self) -> DataFrame:
        return self._single(self._lines("'R', 'A'"), "line", CONDITION_ID, CONDITION)

    @cached_property
    def medication_bundles(self) -> DataFrame:
        return self._single(self._lines("'N'"), "line", MEDICATION_ID, MEDICATION)

    @cached_property
    def event_bundles(self) -> DataFrame:
        return self._single(self.table("events"), "event", "event_id", OBSERVATION)

    @property
    def all_bundles(self) -> DataFrame:
        parts = [self.damaged_bundles, self.order_bundles, self.condition_bundles, self.medication_bundles, self.event_bundles]
        out = self.customer_bundles
        for part in parts:
            out = out.unionByName(part)
        return out

    def write_patient_files(self, per_file: int = 100) -> str:
        """Patient bundles as files, one folder each, at most ``per_file`` customers in a file.

        Rows are numbered within their scan partition and cut into runs of that length, so no
        file outgrows the bound whatever the keys are.
        """
        entries = f"array_join({PATIENT_ENTRIES}, ',')"
        rows = self.table("customer").selectExpr(
            f"monotonically_increasing_id() DIV {per_file} AS chunk",
            f"named_struct('k', c_custkey, 'e', {entries}) AS row",
        )
        grouped = rows.groupBy("chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        whole = F.concat(
            F.lit('{"resourceType":"Bundle","type":"transaction","entry":[\n'),
            F.array_join(F.col("rows.e"), ",\n"),
            F.lit("\n]}"),
        )
        path = f"{tables.work_dir(self.spark)}/bundles-{uuid.uuid4().hex}"
        grouped.select("chunk", whole.alias("value")).write.partitionBy("chunk").text(path)
        return path

    # -- bronze and silver ------------------------------------------------------------

    @cached_property
    def patient_bronze(self) -> DataFrame:
        return bronze.build_bronze(self.customer_bundles)

    @cached_property
    def encounter_bronze(self) -> DataFrame:
        return bronze.build_bronze(self.order_bundles)

    @cached_property
    def all_bronze(self) -> DataFrame:
        return bronze.build_bronze(self.all_bundles)

    @cached_property
    def patient(self) -> DataFrame:
        return silver.silver_patient(self.patient_bronze)

    @cached_property
    def encounter(self) -> DataFrame:
        return silver.silver_encounter(self.encounter_bronze)

    @cached_property
    def condition(self) -> DataFrame:
        return silver.silver_condition(bronze.build_bronze(self.condition_bundles))

    @cached_property
    def medication(self) -> DataFrame:
        return silver.silver_medication_request(bronze.build_bronze(self.medication_bundles))

    @cached_property
    def observation(self) -> DataFrame:
        return silver.silver_observation(bronze.build_bronze(self.event_bundles))

    # -- vocabulary ---------------------------------------------------------------------

    @cached_property
    def raw_concept(self) -> DataFrame:
        parts = self.table("part").selectExpr(f"inline({CONCEPTS})")
        rows = ", ".join(str(row) for row in DEMOGRAPHIC_CONCEPTS)
        demographic = self.spark.sql(
            f"""SELECT CAST(concept_id AS BIGINT) AS concept_id, concept_name, vocabulary_id AS domain_id, vocabulary_id,
                vocabulary_id AS concept_class_id, 'S' AS standard_concept, concept_code,
                DATE'1970-01-01' AS valid_start_date, DATE'{config.OPEN_END_DATE}' AS valid_end_date,
                CAST(NULL AS STRING) AS invalid_reason
            FROM VALUES {rows} AS v(concept_id, concept_name, vocabulary_id, concept_code)"""
        )
        return parts.unionByName(demographic)

    @cached_property
    def relationship(self) -> DataFrame:
        """ICD10 concepts map to the SNOMED concept of the same part, which may not exist."""
        return self.table("part").filter("p_partkey % 2 = 0").selectExpr(
            "4000000000L + p_partkey AS concept_id_1",
            "1000000000L + p_partkey AS concept_id_2",
            "IF(p_partkey % 8 = 0, 'Mapped from', 'Maps to') AS relationship_id",
            "DATE'1970-01-01' AS valid_start_date",
            f"IF(p_partkey % 17 = 0, DATE'2020-01-01', DATE'{config.OPEN_END_DATE}') AS valid_end_date",
        )

    @cached_property
    def concept(self) -> DataFrame:
        return vocab.load_concept(self.raw_concept)

    # -- gold -----------------------------------------------------------------------------

    # A customer gives one patient and an order one encounter at most; their number is in the files' footers.

    @cached_property
    def persons(self) -> joins.Lookup:
        return joins.person_crosswalk(self.patient, self.table("customer").count())

    @cached_property
    def visits(self) -> joins.Lookup:
        return joins.visit_crosswalk(self.encounter, self.table("orders").count())

    @cached_property
    def lookups(self) -> dict[str, joins.Lookup]:
        return gold.build_lookups(self.concept)

    @cached_property
    def person(self) -> DataFrame:
        return gold.omop_person(self.patient, self.lookups["gender"], self.lookups["race"], self.transformed_at)

    @cached_property
    def visit_occurrence(self) -> DataFrame:
        return gold.omop_visit_occurrence(self.encounter, self.persons, self.transformed_at)

    @cached_property
    def condition_occurrence(self) -> DataFrame:
        return gold.omop_condition_occurrence(
            self.condition, self.persons, self.lookups["condition"], self.transformed_at
        )

    @cached_property
    def drug_exposure(self) -> DataFrame:
        return gold.omop_drug_exposure(self.medication, self.persons, self.lookups["drug"], self.transformed_at)

    @cached_property
    def measurement(self) -> DataFrame:
        return gold.omop_measurement(
            self.observation, self.persons, self.visits, self.lookups["measurement"], self.transformed_at
        )

    @cached_property
    def omop_observation(self) -> DataFrame:
        return gold.omop_observation(
            self.observation, self.persons, self.visits,
            self.lookups["observation"], self.lookups["value"], self.transformed_at,
        )

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return {
            "omop_person": self.person,
            "omop_visit_occurrence": self.visit_occurrence,
            "omop_condition_occurrence": self.condition_occurrence,
            "omop_drug_exposure": self.drug_exposure,
            "omop_measurement": self.measurement,
            "omop_observation": self.omop_observation,
        }

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {
            "silver_patient": self.patient,
            "silver_encounter": self.encounter,
            "silver_condition": self.condition,
            "silver_medication_request": self.medication,
            "silver_observation": self.observation,
        }
