"""What must hold when one key has a third of all rows, or the data outgrow a bound."""

import re

import pytest
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import bronze, gold, joins, quality, vocab
from clinlake.operators.joins import Lookup, left_lookup
from clinlake.sources import tables

N = 60_000


@pytest.fixture
def shuffled(spark):
    """No join small enough to broadcast, and a low bar for a partition to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """Rows and final plan of one run."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def facts(spark):
    """A third of the rows name one patient, a third none, the rest many."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.col("id") % 5000))
    return spark.range(0, N, 1, 8).select(
        key.alias("fhir_patient_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("_lineage_id"),
        F.sha2((F.col("id") + 7).cast("string"), 512).alias("payload"),
    )


@pytest.fixture
def patients(spark):
    return spark.range(5000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("fhir_patient_id"),
        F.lit(None).cast("string").alias("abha_id"),
    )


def test_hot_patient_is_split_and_nulls_are_dealt_out(shuffled, facts, patients):
    joined = joins.resolve_person(facts, joins.person_crosswalk(patients))
    carried = F.max("payload").alias("payload")
    rows, plan = executed(joined.agg(F.count("*").alias("n"), F.count("person_id").alias("known"), carried))
    assert "skew=true" in plan, plan
    total = rows[0]
    p0 = facts.filter("fhir_patient_id = 'p0'").count()
    assert (total.n, total.known) == (N, facts.filter("fhir_patient_id IS NOT NULL").count() - p0)


def test_null_keys_do_not_share_a_partition(shuffled, facts, patients):
    nothing = facts.withColumn("fhir_patient_id", F.lit(None).cast("string"))
    shuffled.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joins.resolve_person(nothing, joins.person_crosswalk(patients)).groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in sizes.collect()]
    finally:
        shuffled.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(counts) == N and max(counts) < N / 4


def test_hot_code_is_split_when_the_vocabulary_is_large(shuffled, spark, facts):
    codes = spark.range(5000).select(F.lit("*").alias("vocabulary"), F.concat(F.lit("p"), "id").alias("concept_code"), "id")
    keys = codes.withColumnRenamed("id", "concept_id").union(
        spark.createDataFrame([("*", "hot", 99999)], "vocabulary string, concept_code string, concept_id bigint")
    )
    mapped = joins.map_concept(facts, Lookup(keys, ("vocabulary", "concept_code")), "fhir_patient_id", "c")
    rows, plan = executed(mapped.groupBy("c").agg(F.count("*").alias("count"), F.max("payload")).filter("c IN (0, 99999)"))
    assert "skew=true" in plan
    counts = {r.c: r["count"] for r in rows}
    assert counts[99999] == N / 3 and counts[0] >= N / 3


def test_large_and_small_lookup_give_the_same(spark, facts, patients):
    crosswalk = joins.person_crosswalk(patients)
    small = Lookup(crosswalk.df, crosswalk.key, small=True)
    a = joins.resolve_person(facts, crosswalk).drop("payload")
    b = joins.resolve_person(facts, small).drop("payload").select(a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "BroadcastHashJoin" in b._jdf.queryExecution().executedPlan().toString()


def test_rollup_splits_a_person_with_very_many_visits(shuffled, spark):
    visit = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("person_id"),
        F.col("id").alias("visit_occurrence_id"),
    )
    person = spark.range(6000).select(F.col("id").alias("person_id"))
    condition = spark.range(0, 9000).select((F.col("id") % 100).alias("person_id"), (F.col("id") % 4500).alias("condition_occurrence_id"))
    drug = spark.range(0, 50).select(F.col("id").alias("person_id"), F.col("id").alias("drug_exposure_id"))
    rollup = joins.person_rollup(person, visit, condition, drug)
    rows, plan = executed(rollup.groupBy("condition_count", "drug_count").agg(F.count("*").alias("count"), F.max("visit_occurrence_id")))
    assert "skew=true" in plan, plan
    without = person.join(visit, "person_id", "left_anti").count()
    assert sum(r["count"] for r in rows) == visit.distinct().count() + without

    # The same as joining everything, on a slice small enough for that.
    few = visit.filter("visit_occurrence_id < 300")
    some = person.filter("person_id < 60")
    joined = (
        some.join(few, "person_id", "left").join(condition, "person_id", "left").join(drug, "person_id", "left")
        .groupBy("person_id", "visit_occurrence_id")
        .agg(F.countDistinct("condition_occurrence_id").alias("c"), F.countDistinct("drug_exposure_id").alias("d"))
    )
    quick = joins.person_rollup(some, few, condition, drug).select("person_id", "visit_occurrence_id", "condition_count", "drug_count")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, quick.collect()), key=repr)


def test_upsert_splits_a_hot_key(shuffled, spark, monkeypatch):
    monkeypatch.setattr(tables, "fits_broadcast", lambda df: False)
    target = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
        F.lit("2024-01-01").cast("timestamp").alias("_loaded_at"),
    )
    source = target.filter("k <> 'hot'").withColumn("v", F.lit("new"))
    rows, plan = executed(tables.merge_latest(target, source, "k").groupBy(F.col("v") == "new").agg(F.count("*").alias("count")))
    assert "skew=true" in plan, plan
    assert sorted(r["count"] for r in rows) == [N / 3, 2 * N / 3]


def test_reports_combine_before_the_shuffle(facts):
    from clinlake.operators import reports

    plan = reports.counts_by(facts, ["fhir_patient_id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "TakeOrderedAndProject" in plan


def test_lookups_beyond_the_bound_are_not_broadcast(concept, monkeypatch):
    assert all(lookup.small for lookup in gold.build_lookups(concept).values())
    monkeypatch.setattr(config, "BROADCAST_MAX_ROWS", 4)
    small = {name for name, lookup in gold.build_lookups(concept).items() if lookup.small}
    assert small == {"gender", "race", "drug", "measurement"}


def test_broadcast_check_counts_rows_and_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert joins.fits_broadcast(wide)
    assert not joins.fits_broadcast(wide, max_rows=99)
    assert not joins.fits_broadcast(wide, max_bytes=50_000)


def test_no_query_uses_a_python_worker_or_a_cross_join(spark):
    from clinlake.plans import registry

    banned = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin")
    for name in ["gold_observation", "report_visit_record_counts", "quality_unresolved_references", "bronze_resources"]:
        df = registry.queries()[name](spark, "/root/testdata/sf0.001")
        assert not banned.search(df._jdf.queryExecution().executedPlan().toString()), name


def test_type_filter_and_columns_reach_a_stored_bronze(spark, bundles, tmp_path):
    from conftest import CONDITION, PATIENT, bundle_of

    path = str(tmp_path / "raw")
    bronze.build_bronze(bundles(bundle_of(PATIENT, CONDITION))).write.partitionBy("resource_type").parquet(path)
    plan = bronze.route(spark.read.parquet(path), "Patient").select("_lineage_id")._jdf.queryExecution().executedPlan().toString()
    assert "resource_type" in re.search(r"PartitionFilters: \[([^\]]*)", plan).group(1)
    assert re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1) == "_lineage_id:string"


def test_vocabulary_filter_reaches_the_scan(spark, concept, tmp_path):
    path = str(tmp_path / "concept")
    concept.write.parquet(path)
    plan = vocab.concept_subset(spark.read.parquet(path), ["SNOMED"], "Condition")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f"IsNotNull({c})" in pushed for c in ["vocabulary_id", "domain_id", "standard_concept"]), pushed


def test_unresolved_references_finds_dangling_persons(spark):
    tables_ = {
        "omop_person": spark.createDataFrame([(1,)], "person_id bigint"),
        "omop_drug_exposure": spark.createDataFrame([(1,), (2,), (None,)], "person_id bigint"),
    }
    assert [tuple(r) for r in quality.unresolved_references(tables_).collect()] == [("omop_drug_exposure", 3, 1, 1)]


def test_surrogate_key_null_is_not_a_value(spark):
    df = spark.createDataFrame([(None,), ("a",)], "x string")
    assert df.filter(X.surrogate_key(F.col("x")).isNull()).count() == 1


def test_work_dir_is_the_clusters_folder(spark):
    assert tables.work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_left_lookup_keeps_every_row_once(spark, facts):
    lookup = Lookup(spark.createDataFrame([("hot", 1)], "k string, x int"), ("k",))
    joined = left_lookup(facts, lookup, [F.col("fhir_patient_id")], F.col("_lineage_id"))
    assert joined.count() == N and joined.columns == [*facts.columns, "x"]
