"""Joins that must not pass through the driver, texts built and parsed once, frames kept only while they are read."""

import os

import pytest
from pyspark.sql import functions as F

from clinlake import config
from clinlake.operators import bronze, gold, joins, quality
from clinlake.operators.joins import Lookup, left_lookup
from clinlake.plans.workload import Workload
from clinlake.sources import tables


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def facts(spark):
    rows = [("p1", "a"), ("p2", "b"), (None, "c"), ("p9", "d")]
    return spark.createDataFrame(rows, "fhir_patient_id string, _lineage_id string")


def test_an_uncounted_lookup_is_not_broadcast_by_an_estimate(spark, facts):
    lookup = Lookup(spark.createDataFrame([("p1", 1)], "k string, x int"), ("k",))
    joined = left_lookup(facts, lookup, [F.col("fhir_patient_id")], F.col("_lineage_id"))
    assert "BroadcastHashJoin" not in physical(joined) and "SortMergeJoin" in physical(joined)
    assert {r["_lineage_id"]: r["x"] for r in joined.collect()} == {"a": 1, "b": None, "c": None, "d": None}


def test_a_counted_crosswalk_is_broadcast_within_the_bounds_only(spark, facts, monkeypatch):
    patients = spark.createDataFrame([("p1",), ("p2",), ("p1",), (None,)], "fhir_patient_id string")
    few = joins.person_crosswalk(patients, patients.count())
    assert few.small and not joins.person_crosswalk(patients).small
    monkeypatch.setattr(config, "BROADCAST_MAX_ROWS", 3)
    many = joins.person_crosswalk(patients, patients.count())
    assert not many.small and not joins.visit_crosswalk(patients.withColumnRenamed("fhir_patient_id", "fhir_encounter_id"), 4).small
    a, b = (sorted(map(str, joins.resolve_person(facts, x).collect())) for x in (few, many))
    assert a == b and len(a) == 4


def test_unresolved_references_does_not_broadcast_persons(spark):
    frames = {"omop_person": spark.range(3).toDF("person_id"), "omop_drug_exposure": spark.range(2, 5).toDF("person_id")}
    found = quality.unresolved_references(frames)
    assert "BroadcastHashJoin" not in physical(found)
    assert [tuple(r) for r in found.collect()] == [("omop_drug_exposure", 3, 0, 2)]


def test_rollup_counts_once_and_keeps_persons_without_visits(spark, tmp_path):
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    person = stored("p", spark.createDataFrame([(1,), (1,), (2,), (None,)], "person_id bigint"))
    visit = stored("v", spark.createDataFrame([(1, 10), (1, 10), (1, None), (7, 70), (None, 80)], "person_id bigint, visit_occurrence_id bigint"))
    condition = stored("c", spark.createDataFrame([(1, 5), (1, 6), (1, 6), (None, 7)], "person_id bigint, condition_occurrence_id bigint"))
    drug = stored("d", spark.createDataFrame([(2, 8)], "person_id bigint, drug_exposure_id bigint"))
    rollup = joins.person_rollup(person, visit, condition, drug)
    got = rollup.select("person_id", "visit_occurrence_id", "condition_count", "drug_count").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 10, 2, 0), (1, None, 2, 0), (2, None, 0, 1), (None, None, 0, 0)], key=repr)
    assert optimized(rollup).count("condition_occurrence_id#") and optimized(rollup).count("Relation [person_id#") <= 6
    assert "BroadcastHashJoin" not in physical(rollup)


def test_row_counts_reads_a_table_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    counted = quality.row_counts({"t": spark.read.parquet(str(tmp_path / "t")), "u": spark.range(2)})
    assert optimized(counted).count("Relation [") == 1
    assert sorted(map(tuple, counted.collect())) == [("TOTAL", 7), ("t", 5), ("u", 2)]


def test_quarantine_and_skipped_entries_parse_a_text_once(spark, bundles, tmp_path):
    made = bundles('{"entry":[{"resource":{"resourceType":"Basic"}},5]}', "", None, '{"entry":[', "{}", "[]", '{"entry":[]} more')
    made.write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    built = stored.withColumn("bundle_json", F.concat("bundle_json", F.lit("\n")))
    assert optimized(bronze.quarantine(built)).count("from_json(") == 1
    # Of the bundle, of it again where an entry is no object (twice in one expression), of the head of a resource.
    assert optimized(bronze.skipped_entries(built)).count("from_json(") <= 4
    reasons = {r["_source_file"]: r["reason"] for r in bronze.quarantine(stored).collect()}
    assert reasons == {
        "file-1.json": "empty file", "file-2.json": "empty file", "file-3.json": "not valid JSON", "file-4.json": "no entry list",
        "file-5.json": "not valid JSON", "file-6.json": "not valid JSON",
    }
    assert [tuple(r) for r in bronze.skipped_entries(stored).collect()] == [("file-0.json", 1)]


def test_bundle_texts_are_built_by_compiled_code(spark):
    w = Workload(spark, "/root/testdata/sf0.001")
    for frame in (w.order_bundles, w.condition_bundles, w.event_bundles):
        assert "lambda" not in optimized(frame.select("bundle_json"))


def test_latest_per_key_reads_its_rows_once(spark, tmp_path):
    rows = [("a", "x", 1), ("a", "y", 2), (None, "z", 1), (None, "z", 1), (None, "w", 3), (None, None, 3), (None, None, 3)]
    spark.createDataFrame(rows, "k string, v string, _loaded_at int").write.parquet(str(tmp_path / "t"))
    latest = tables.latest_per_key(spark.read.parquet(str(tmp_path / "t")), "k")
    assert optimized(latest).count("Relation [") == 1
    assert sorted(map(tuple, latest.collect()), key=repr) == sorted(rows[1:], key=repr)


def test_a_kept_frame_goes_with_its_block(spark):
    with tables.kept(spark.range(10)) as ten:
        folder = os.path.dirname(ten.inputFiles()[0].removeprefix("file:").replace("///", "/"))
        assert os.path.isdir(folder) and ten.count() == 10
    assert not os.path.exists(folder)


def test_records_per_file(spark):
    audit = spark.createDataFrame([("f", "1"), ("f", "2"), ("g", "3"), (None, "4")], "_source_file string, _lineage_id string")
    counted = gold.records_per_file(audit)
    assert sorted(map(tuple, counted.collect())) == [("f", "1", 2), ("f", "2", 2), ("g", "3", 1)]


def test_new_files_are_whole_again(spark):
    from clinlake.plans import registry

    found = {r[0] for r in registry.queries()["bronze_new_files"](spark, "/root/testdata/sf0.001").collect()}
    assert {"bundles/customer/1", "bundles/damaged/24", "bundles/damaged/49"} <= found and "bundles/customer/2" not in found


def test_a_join_that_gives_no_used_column_is_left_out(spark, facts, tmp_path):
    ids = spark.createDataFrame([("p1",), ("p2",), ("p1",), (None,)], "fhir_patient_id string")
    persons = joins.person_crosswalk(ids)
    assert not persons.small
    resolved = joins.resolve_person(facts, persons)
    assert "Join" not in optimized(resolved.agg(F.count("*"))) and resolved.count() == 4
    # The shuffled join itself stays as it was: a hot key is split, a null key matches nothing.
    assert "SortMergeJoin" in physical(resolved) and resolved.columns == ["fhir_patient_id", "_lineage_id", "person_id"]
    known = {r["_lineage_id"]: r["person_id"] is not None for r in resolved.collect()}
    assert known == {"a": True, "b": True, "c": False, "d": False}


def test_a_number_key_is_looked_up_by_a_shuffle(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "site bigint, _lineage_id string")
    lookup = Lookup(spark.createDataFrame([(1, "x"), (None, "y")], "_id bigint, name string"), ("_id",))
    joined = left_lookup(facts, lookup, [F.col("site")], F.col("_lineage_id"))
    assert sorted(map(tuple, joined.select("_lineage_id", "name").collect())) == [("a", "x"), ("b", None), ("c", None)]


def test_a_million_ids_are_too_many_for_the_driver(spark):
    patients = spark.createDataFrame([("p1",)], "fhir_patient_id string")
    assert joins.person_crosswalk(patients, 150_000).small and not joins.person_crosswalk(patients, 900_000).small


def test_order_lines_are_dealt_out_after_their_join(spark):
    w = Workload(spark, "/root/testdata/sf0.001")
    plan = physical(w.condition_bundles)
    deal = f"RoundRobinPartitioning({4 * spark.sparkContext.defaultParallelism})"
    assert plan.count("RoundRobinPartitioning") == 1 and plan.index(deal) < plan.index("HashJoin")


def test_counted_conditions_are_not_parsed(spark):
    w = Workload(spark, "/root/testdata/sf0.001")
    assert "onsetPeriod,StructType" in optimized(w.condition).split("to_json")[0]
    assert "clinicalStatus,StructType(StructField(coding,ArrayType(StructType(StructField(system" not in optimized(w.condition.agg(F.count("*")))


def test_references_evaluate_a_dimension_once(spark, tmp_path):
    from clinlake.operators import extensions

    visits = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "care_site_id bigint, provider_id bigint, _lineage_id string")
    tried = spark.sparkContext.accumulator(0)

    def counted(value):
        tried.add(1)
        return value

    count = F.udf(counted, "string").asNondeterministic()
    sites = spark.createDataFrame([(1, "S", "Site")], "care_site_id bigint, care_site_source_value string, care_site_name string")
    providers = spark.createDataFrame([(5, "P", "Dr")], "provider_id bigint, provider_source_value string, provider_name string")
    sites = sites.withColumn("care_site_name", count("care_site_name"))
    found = extensions.visit_references(visits, sites, providers)
    assert {r["_lineage_id"]: (r["care_site_name"], r["provider_name"]) for r in found.collect()} == {"a": ("Site", None), "b": (None, "Dr")}
    assert tried.value == 1


# F3 to F13: with every count beyond its bound, as at 60 times sf0.1, nothing may pass through the driver, whatever the optimizer estimates.
UNBOUNDED = [
    "report_measurement_stats", "report_observation_stats", "report_top_coded_observations", "report_top_measurements",
    "report_top_text_observations", "quality_row_counts", "quality_unresolved_references", "gold_observation", "join_resolve_visit",
    "lineage_audit", "trace_lineage",
]


@pytest.mark.parametrize("name", UNBOUNDED)
def test_tables_beyond_the_bounds_do_not_pass_through_the_driver(spark, monkeypatch, name):
    from clinlake.plans import registry, workload

    monkeypatch.setattr(config, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(workload, "FEW_ORDERS", 0)
    assert "Broadcast" not in physical(registry.queries()[name](spark, "/root/testdata/sf0.001"))
