import datetime as dt
import json
import os
import uuid

import pytest
from conftest import CONDITION, ENCOUNTER, MEDICATION, OBSERVATION, PATIENT, bundle_of, one, without
from pyspark.sql import functions as F

from clinlake.operators import quality, silver
from clinlake.operators.silver import SILVER_TABLES
from clinlake.plans import build
from clinlake.plans.build import Layers
from clinlake.sources import contracts, files, tables
from clinlake.streaming import ingest


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex[:10]}"


SCHEMA = "k string, v int, _loaded_at timestamp"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.select("k", "v").collect()), key=repr)


# -- upsert ----------------------------------------------------------------------------------

def test_latest_per_key(spark):
    df = frame(spark, ("a", 1, day(1)), ("a", 2, day(3)), ("a", 3, day(2)), ("b", 4, day(1)), (None, 5, day(1)), (None, 6, day(1)))
    assert content(tables.latest_per_key(df, "k")) == [("a", 2), ("b", 4), (None, 5), (None, 6)]


def test_latest_per_key_settles_ties_the_same_way(spark):
    rows = [("a", v, day(1)) for v in range(50)]
    picked = {content(tables.latest_per_key(frame(spark, *r).repartition(n), "k"))[0] for r in (rows, rows[::-1]) for n in (1, 7)}
    assert len(picked) == 1


def test_latest_per_key_combines_before_the_shuffle(spark):
    plan = tables.latest_per_key(frame(spark, ("a", 1, day(1))), "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_merge_replaces_matches_and_keeps_the_rest(spark):
    target = frame(spark, ("a", 1, day(1)), ("b", 2, day(1)), (None, 3, day(1)))
    source = frame(spark, ("b", 20, day(2)), ("b", 21, day(3)), ("c", 30, day(2)), (None, 40, day(2)))
    merged = tables.merge_latest(target, source, "k")
    assert content(merged) == [("a", 1), ("b", 21), ("c", 30), (None, 3), (None, 40)]


def with_lineage(spark, *rows):
    return spark.createDataFrame(list(rows), f"{SCHEMA}, _lineage_id string")


def test_rows_without_a_key_are_merged_by_lineage(spark, name):
    delivery = with_lineage(spark, (None, 1, day(1), "x"), (None, 2, day(1), "y"), ("a", 3, day(1), "z"))
    for _ in range(3):
        tables.upsert(delivery, name, "k")
        assert content(spark.table(name)) == [("a", 3), (None, 1), (None, 2)]
    tables.upsert(with_lineage(spark, (None, 5, day(2), "y")), name, "k")
    assert content(spark.table(name)) == [("a", 3), (None, 1), (None, 5)]


def test_an_older_row_does_not_replace_a_newer_one(spark, name):
    tables.upsert(frame(spark, ("a", 1, day(5)), ("b", 2, day(1))), name, "k")
    tables.upsert(frame(spark, ("a", 9, day(4)), ("b", 8, day(2)), ("c", 7, day(1))), name, "k")
    assert content(spark.table(name)) == [("a", 1), ("b", 8), ("c", 7)]


def test_dropped_snapshots_leave_no_files(spark, name, tmp_path):
    for v in range(4):
        tables.publish(frame(spark, ("a", v, day(1))), name, location=str(tmp_path))
    assert len(list(tmp_path.iterdir())) == 2 and content(spark.table(name)) == [("a", 3)]


def test_upsert_creates_then_merges_and_is_idempotent(spark, name):
    first, second = frame(spark, ("a", 1, day(1)), ("a", 2, day(2))), frame(spark, ("a", 5, day(3)), ("b", 6, day(3)))
    tables.upsert(first, name, "k")
    assert content(spark.table(name)) == [("a", 2)]
    for _ in range(2):
        tables.upsert(second, name, "k")
        assert content(spark.table(name)) == [("a", 5), ("b", 6)]


def test_upsert_from_a_stored_source_is_scanned_without_the_targets_shuffle(spark, name):
    target = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(day(1)).alias("_loaded_at"))
    merged = tables.merge_latest(target, frame(spark, ("5", 2, day(2))), "k")
    assert merged.count() == 1000
    assert "BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()


def test_publish_swaps_and_drops_old_snapshots(spark, name):
    for v in range(4):
        tables.publish(frame(spark, ("a", v, day(1))), name)
        assert content(spark.table(name)) == [("a", v)]
    kept = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v")]
    assert len(kept) == 2


def test_publish_may_read_the_table_it_replaces(spark, name):
    tables.publish(frame(spark, ("a", 1, day(1))), name)
    tables.publish(spark.table(name).withColumn("v", F.col("v") + 1), name)
    assert content(spark.table(name)) == [("a", 2)]


def test_failed_publish_leaves_the_old_content(spark, name):
    tables.publish(frame(spark, ("a", 1, day(1))), name)
    broken = frame(spark, ("a", 1, day(1))).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(broken, name)
    assert content(spark.table(name)) == [("a", 1)]


def test_write_overwrite_changes_columns(spark, name):
    tables.write_overwrite(spark.range(3), name)
    tables.write_overwrite(spark.range(2).withColumn("x", F.lit(1)), name)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 2
    tables.drop_table(spark, name)
    assert tables.target_or_none(spark, name) is None


@pytest.mark.parametrize("few", [0, 10_000])
def test_both_merges_give_the_same(spark, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW_ROWS", few)
    target = with_lineage(spark, ("a", 1, day(2), "1"), ("b", 2, day(2), "2"), (None, 3, day(2), "3"), (None, 4, day(2), None), ("t", None, day(1), "5"))
    source = with_lineage(
        spark, ("a", 9, day(1), "6"), ("b", 8, day(3), "7"), ("c", 7, day(1), "8"), (None, 6, day(3), "3"), (None, 5, day(2), None), ("t", 4, day(1), "5")
    )
    want = [("a", 1), ("b", 8), ("c", 7), ("t", 4), (None, 4), (None, 5), (None, 6)]
    assert content(tables.merge_latest(target, source, "k")) == sorted(want, key=repr)


def test_a_large_delivery_is_merged_in_one_pass_over_the_target(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tables, "FEW_ROWS", 0)
    frame(spark, *[(str(i), i, day(1)) for i in range(100)]).write.parquet(str(tmp_path / "t"))
    merged = tables.merge_latest(spark.read.parquet(str(tmp_path / "t")), frame(spark, ("5", 2, day(2))), "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 100 and plan.count("FileScan parquet") == 1


# -- upsert by buckets -------------------------------------------------------------------------

def bucket_files(spark, table):
    rows = spark.table(table).select("_bucket", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    found = {}
    for r in rows:
        found.setdefault(r[0], set()).add(tuple(r[1:]))
    return found


def test_upsert_buckets_leaves_other_buckets_alone(spark, name, tmp_path):
    many = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"), F.lit(day(1)).alias("_loaded_at"))
    assert len(tables.upsert_buckets(many, name, "k", 64, str(tmp_path))) == 64
    before = bucket_files(spark, name)
    touched = tables.upsert_buckets(frame(spark, ("k7", 2, day(2)), ("k8", 3, day(1)), ("new", 4, day(1))), name, "k", location=str(tmp_path))
    after = bucket_files(spark, name)
    assert 1 <= len(touched) <= 3
    assert {b: f for b, f in after.items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
    assert all(not (after[b] & before.get(b, set())) for b in touched)
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert len(got) == 501 and (got["k7"], got["k8"], got["new"], got["k9"]) == (2, 3, 4, 1)


def test_upsert_buckets_equals_upsert(spark, name, tmp_path):
    deliveries = [
        with_lineage(spark, ("a", 1, day(1), "1"), ("b", 2, day(3), "2"), (None, 3, day(1), "3"), ("a", 4, day(2), "4")),
        with_lineage(spark, ("b", 9, day(2), "5"), (None, 7, day(2), "3"), (None, 8, day(1), "6"), ("c", 5, day(1), "7")),
        with_lineage(spark, ("c", 6, day(4), "8")),
    ]
    for delivery in [*deliveries, deliveries[1], deliveries[0].limit(0)]:
        tables.upsert(delivery, f"{name}_a", "k")
        tables.upsert_buckets(delivery, f"{name}_b", "k", 7)
    assert content(spark.table(f"{name}_a")) == content(spark.table(f"{name}_b"))
    assert content(spark.table(f"{name}_b")) == [("a", 4), ("b", 2), ("c", 6), (None, 7), (None, 8)]


def test_an_interrupted_upsert_is_finished_by_the_next(spark, name, monkeypatch):
    tables.upsert_buckets(frame(spark, ("a", 1, day(1)), ("b", 2, day(1))), name, "k", 4)
    with monkeypatch.context() as m:
        calls = []
        m.setattr(tables, "_finish", lambda *a: calls.append(a))
        tables.upsert_buckets(frame(spark, ("a", 5, day(2))), name, "k")
        assert len(calls) == 2
    assert content(spark.table(name)) == [("a", 1), ("b", 2)]
    tables.upsert_buckets(frame(spark, ("c", 3, day(1))), name, "k")
    assert content(spark.table(name)) == [("a", 5), ("b", 2), ("c", 3)]


def test_merge_is_one_equality(spark, name):
    frame(spark, ("a", 1, day(1))).withColumn("_lineage_id", F.lit("x")).createOrReplaceTempView(f"{name}_s")
    statement = tables.merge_statement(f"{name}_s", f"{name}_s", "k", True)
    condition = statement.split(" ON ")[1].split(" WHEN ")[0]
    joined = spark.sql(f"SELECT * FROM {name}_s t JOIN {name}_s s ON {condition}")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert " OR " not in condition and joined.count() == 1
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString() and "Join Inner" in plan


# -- incremental ------------------------------------------------------------------------------

def test_since_watermark(spark):
    df = frame(spark, ("a", 1, day(1)), ("b", 2, day(2)), ("c", 3, day(3)))
    assert content(tables.since_watermark(df, frame(spark, ("x", 0, day(2))))) == [("c", 3)]
    assert tables.since_watermark(df, None).count() == 3
    assert tables.since_watermark(df, df.limit(0)).count() == 3


def test_not_consumed_takes_late_files_of_earlier_loads(spark):
    schema = "_source_file string, _loaded_at timestamp, v int"
    raw = spark.createDataFrame([("f1", day(2), 1), ("f2", day(1), 2), ("f2", day(1), 3), ("f1", day(3), 4)], schema)
    taken = spark.createDataFrame([("f1", day(2), 1)], schema)
    fresh = tables.not_consumed(raw, taken)
    assert fresh.columns == raw.columns and sorted(r.v for r in fresh.collect()) == [2, 3, 4]
    assert tables.not_consumed(raw, None).count() == 4


# -- layout -----------------------------------------------------------------------------------

def test_partition_and_cluster(spark, tmp_path):
    days = spark.range(3000).select(
        (F.col("id") % 7).alias("person_id"),
        F.date_add(F.lit("2019-06-01").cast("date"), (F.col("id") % 900).cast("int")).alias("d"),
        F.col("id").cast("string").alias("_lineage_id"),
    )
    clustered = tables.cluster_by_keys(tables.partition_by_year(days, "d"), ["person_id", "d"], "year_start")
    clustered.write.partitionBy("year_start").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    pruned = stored.filter("year_start = 2020")
    assert pruned.count() == days.filter(F.year("d") == 2020).count()
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_start" in scan
    assert stored.count() == 3000


def test_z_order_skips_files_by_either_column(spark, tmp_path):
    points = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.col("id").cast("string").alias("_lineage_id"))
    odd = spark.createDataFrame([(None, None, "n"), (3, None, "m")], "a bigint, b bigint, _lineage_id string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for name, ordered in (("z", tables.z_order(points.unionByName(odd), ["a", "b"], 6)), ("r", tables.cluster_by_keys(points, ["a", "b"]))):
            ordered.write.parquet(str(tmp_path / name))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def read(name, column):
        stored = spark.read.parquet(str(tmp_path / name)).groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        files = stored.collect()
        return sum(r.lo is not None and r.lo <= 20 <= r.hi for r in files) / len(files)

    assert spark.read.parquet(str(tmp_path / "z")).count() == 4098
    assert read("z", "a") <= 0.4 and read("z", "b") <= 0.4 and read("r", "b") >= 0.9


def test_one_hot_person_and_day_is_split_over_tasks(spark):
    hot = spark.range(20000).select(F.lit(1).alias("person_id"), F.lit("2020-01-01").alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("_lineage_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = tables.cluster_by_keys(hot, ["person_id", "d"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 6000


# -- vocabulary files -------------------------------------------------------------------------

HEADER = (
    "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\t"
    "valid_start_date\tvalid_end_date\tinvalid_reason\n"
)


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "CONCEPT.csv"
    path.write_text(
        HEADER
        + '1\t5" needle\tDevice\tSNOMED\tX\tS\t0012\t19700101\t20991231\t\n'
        + "2\tIso dates\tDevice\tSNOMED\tX\t\tc2\t1970-01-01\t2099-12-31\tD\n"
        + "3\tBad date\tDevice\tSNOMED\tX\tS\tc3\tnever\t20151231\t\n"
    )
    rows = {r.concept_id: r for r in files.read_vocab_tsv(spark, str(path)).collect()}
    assert rows[1].concept_name == '5" needle' and rows[1].concept_code == "0012"
    assert rows[1].valid_end_date == rows[2].valid_end_date == dt.date(2099, 12, 31)
    assert rows[2].standard_concept is None and rows[2].invalid_reason == "D"
    assert rows[3].valid_start_date is None


def test_missing_vocabulary_file_is_none_but_other_errors_are_raised(spark, tmp_path):
    assert files.optional_vocab(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(Exception):
        files.optional_vocab(spark, "nosuchscheme://x/y.csv")


def test_inferred_vocabulary_file(spark, tmp_path):
    path = tmp_path / "V.csv"
    path.write_text("id\tname\n1\ta\n2\tb\n")
    assert dict(files.read_vocab_tsv(spark, str(path), schema=None).dtypes) == {"id": "int", "name": "string"}


# -- the layers end to end -----------------------------------------------------------------------

def write_bundles(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for file, text in texts.items():
        (folder / f"{file}.json").write_text(text)


@pytest.fixture
def layers(tmp_path, name):
    return Layers(f"{name}_b", f"{name}_s", f"{name}_g", location=str(tmp_path / "lake"))


def load(spark, layers, folder, raw_concept, at):
    build.land(spark, str(folder), layers, F.lit(at))
    build.load_vocabulary(spark, raw_concept, None, layers)
    build.refresh_silver(spark, layers)
    return build.refresh_gold(spark, layers, F.lit(day(9)))


def snapshot(stored):
    return {t: sorted(map(repr, df.drop("_loaded_at", "_transformed_at").collect())) for t, df in stored.items()}


def test_layers_from_files_to_gold(spark, layers, tmp_path, raw_concept):
    folder = tmp_path / "in"
    write_bundles(
        folder,
        a=json.dumps(json.loads(bundle_of(PATIENT, ENCOUNTER, CONDITION, MEDICATION, OBSERVATION)), indent=1),
        b=bundle_of(without(PATIENT, id="pat-2", identifier=[]), without(CONDITION, id="con-2", subject={"reference": "Patient/pat-2"})),
        broken="{cut",
    )
    stored = load(spark, layers, folder, raw_concept, day(1))
    counts = {t: df.count() for t, df in stored.items()}
    assert counts == {
        "omop_person": 2, "omop_visit_occurrence": 1, "omop_condition_occurrence": 2,
        "omop_drug_exposure": 1, "omop_measurement": 1, "omop_observation": 0,
    }
    build.check(spark, layers)
    unresolved = quality.unresolved_references(stored).collect()
    assert all((r.without_person, r.dangling) == (0, 0) for r in unresolved)
    assert spark.table("lineage_audit").count() == 7

    # The same files again change nothing.
    before = snapshot(stored)
    assert snapshot(load(spark, layers, folder, raw_concept, day(2))) == before
    assert spark.table(layers.raw).count() == 7

    # A new file with a corrected condition updates it, and adds a new patient.
    corrected = without(CONDITION, clinicalStatus={"coding": [{"code": "resolved"}]})
    write_bundles(folder, c=bundle_of(corrected, without(PATIENT, id="pat-3")))
    stored = load(spark, layers, folder, raw_concept, day(3))
    assert stored["omop_person"].count() == 3 and stored["omop_condition_occurrence"].count() == 2
    assert stored["omop_condition_occurrence"].filter("stop_reason = 'Resolved'").count() == 1


def test_overlapping_loads_lose_nothing(spark, layers, tmp_path, raw_concept):
    everyone = (PATIENT, ENCOUNTER, CONDITION, MEDICATION, OBSERVATION)
    write_bundles(tmp_path / "in", a=bundle_of(*everyone))
    load(spark, layers, tmp_path / "in", raw_concept, day(5))
    write_bundles(tmp_path / "in", late=bundle_of(without(PATIENT, id="pat-late")))
    stored = load(spark, layers, tmp_path / "in", raw_concept, day(4))
    assert stored["omop_person"].count() == 2


def statuses(spark, layers):
    rows = spark.table(layers.manifest).filter("status <> 'started'").collect()
    return sorted((r._source_file.rsplit("/", 1)[1], r.status, r.n_resources) for r in rows)


def test_the_manifest_remembers_every_file(spark, layers, tmp_path):
    folder = tmp_path / "in"
    write_bundles(folder, good=bundle_of(PATIENT, CONDITION), empty="\n ", cut='{"entry":[{"resource"', list="[]", none='{"entry":[]}')
    build.land(spark, str(folder), layers, F.lit(day(1)))
    first = [("cut.json", "damaged", 0), ("empty.json", "empty", 0), ("good.json", "landed", 2), ("list.json", "damaged", 0), ("none.json", "landed", 0)]
    assert statuses(spark, layers) == first
    reasons = {r._source_file.rsplit("/", 1)[1]: r.reason for r in spark.newSession().table(f"{layers.bronze}.quarantine").collect()}
    assert reasons == {"cut.json": "not valid JSON", "empty.json": "empty file", "list.json": "not valid JSON"}
    # Nothing is new, damaged files included: no file is read.
    build.land(spark, str(folder), layers, F.lit(day(2)))
    assert statuses(spark, layers) == first
    # A mended file is new; one that is only touched is read and found unchanged.
    write_bundles(folder, cut=bundle_of(ENCOUNTER))
    os.utime(folder / "good.json", (1, 1))
    build.land(spark, str(folder), layers, F.lit(day(3)))
    assert sorted(set(statuses(spark, layers)) - set(first)) == [("cut.json", "landed", 1), ("good.json", "unchanged", 2)]
    assert spark.table(layers.raw).count() == 3


def test_listing_reads_no_content_and_shuffles_no_text(spark, layers, tmp_path):
    write_bundles(tmp_path / "in", a=bundle_of(PATIENT))
    build.land(spark, str(tmp_path / "in"), layers, F.lit(day(1)))
    from clinlake.sources import manifest

    fresh = manifest.new_files(files.list_files(spark, str(tmp_path / "in")), spark.table(layers.manifest))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert fresh.count() == 0 and "content:" not in plan and "ReadSchema: struct<path:string>" in plan


@pytest.mark.parametrize("raw_written", [True, False])
def test_an_interrupted_landing_is_made_good(spark, layers, tmp_path, raw_written, monkeypatch):
    from clinlake.sources import manifest

    write_bundles(tmp_path / "in", a=bundle_of(PATIENT, CONDITION), b=bundle_of(ENCOUNTER))
    append, calls = manifest._append, []

    def dies(df, table, *rest):
        calls.append(table)
        if len(calls) == (3 if raw_written else 2):
            raise RuntimeError("lost")
        append(df, table, *rest)

    with monkeypatch.context() as m:
        m.setattr(manifest, "_append", dies)
        with pytest.raises(RuntimeError, match="lost"):
            build.land(spark, str(tmp_path / "in"), layers, F.lit(day(1)))
    for n in (2, 3):
        build.land(spark, str(tmp_path / "in"), layers, F.lit(day(n)))
        assert sorted(r.resource_type for r in spark.table(layers.raw).collect()) == ["Condition", "Encounter", "Patient"]


def test_loads_are_taken_once(spark, layers, tmp_path, raw_concept):
    folder = tmp_path / "in"
    write_bundles(folder, a=bundle_of(PATIENT, CONDITION))
    load(spark, layers, folder, raw_concept, day(1))
    write_bundles(folder, b=bundle_of(without(PATIENT, gender="female")))
    load(spark, layers, folder, raw_concept, day(2))
    from clinlake.sources import manifest

    # All rows of the first file's patient are replaced, and still its load is not read again.
    fresh, loads = manifest.not_taken(spark.table(layers.raw), spark.table(layers.manifest), spark.table(layers.taken), "Patient")
    assert fresh.count() == 0 and loads.count() == 0
    assert one(spark.table(layers.silver_table("Patient"))).gender_code == "female"


def test_layers_by_buckets_equal_plain_ones(spark, layers, tmp_path, raw_concept, name):
    import dataclasses

    bucketed = dataclasses.replace(layers, bronze=f"{name}_b2", silver=f"{name}_s2", gold=f"{name}_g2", buckets=8)
    for n, texts in enumerate(({"a": bundle_of(PATIENT, CONDITION, ENCOUNTER, OBSERVATION, MEDICATION)}, {"b": bundle_of(without(CONDITION, id="x"), without(PATIENT, gender="other"))}), 1):
        write_bundles(tmp_path / "in", **texts)
        plain = load(spark, layers, tmp_path / "in", raw_concept, day(n))
        by_bucket = load(spark, bucketed, tmp_path / "in", raw_concept, day(n))
        assert snapshot(plain) == snapshot(by_bucket)


def test_stored_lineage_is_readable_in_a_new_session(spark, layers, tmp_path, raw_concept):
    write_bundles(tmp_path / "in", a=bundle_of(PATIENT, CONDITION, ENCOUNTER, OBSERVATION, MEDICATION))
    load(spark, layers, tmp_path / "in", raw_concept, day(1))
    stored = spark.newSession().table(layers.gold_table("lineage_audit"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, spark.table("lineage_audit").collect())) and stored.count() == 5


def test_other_time_zones_are_refused(spark, layers):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for step in (build.refresh_silver, build.refresh_gold):
            with pytest.raises(ValueError, match="UTC"):
                step(spark, layers)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_gates_raise(spark, layers, tmp_path, raw_concept):
    write_bundles(tmp_path / "in", a=bundle_of(without(PATIENT, "birthDate"), CONDITION, ENCOUNTER, MEDICATION, OBSERVATION))
    load(spark, layers, tmp_path / "in", raw_concept, day(1))
    with pytest.raises(quality.QualityError, match="person_required"):
        build.check(spark, layers)


# -- streams --------------------------------------------------------------------------------------

def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path, name):
    source, sink = tmp_path / "in", str(tmp_path / "bronze")
    write_bundles(source, a=bundle_of(PATIENT, CONDITION), b=bundle_of(ENCOUNTER))

    def run():
        ingest.stream_bronze(
            spark, str(source), sink, str(tmp_path / "c1"), max_files=1, loaded_at=F.lit(day(1))
        ).awaitTermination()
        return spark.read.parquet(sink)

    from clinlake.operators import bronze

    batch = bronze.build_bronze(files.scan_bundles(spark, str(source), F.lit(day(1))))
    columns = contracts.BRONZE.fieldNames()
    assert sorted(run().select(columns).collect()) == sorted(batch.select(columns).collect())
    assert run().count() == 3
    write_bundles(source, c=bundle_of(without(CONDITION, clinicalStatus={"coding": [{"code": "resolved"}]})))
    assert run().count() == 4


def test_stream_lands_in_two_sinks_and_a_replayed_batch_adds_nothing(spark, layers, tmp_path):
    source = tmp_path / "in"
    build.tables.ensure_schema(spark, layers.bronze)

    def run(checkpoint):
        ingest.stream_land(spark, str(source), layers.raw, layers.manifest, str(tmp_path / checkpoint), layers.location, max_files=1).awaitTermination()

    write_bundles(source, a=bundle_of(PATIENT, CONDITION), b="{cut")
    run("c1")
    want = [("a.json", "landed", 2), ("b.json", "damaged", 0)]
    assert statuses(spark, layers) == want and spark.table(layers.raw).count() == 2
    # A lost checkpoint replays every batch.
    run("c2")
    assert spark.table(layers.raw).count() == 2
    write_bundles(source, c=bundle_of(ENCOUNTER))
    run("c1")
    assert spark.table(layers.raw).count() == 3


def test_stream_upsert_keeps_the_latest(spark, tmp_path, name):
    source, sink = tmp_path / "in", str(tmp_path / "bronze")
    _, key = SILVER_TABLES["Condition"]
    for n, status in enumerate(["active", "resolved"], start=1):
        changed = without(CONDITION, clinicalStatus={"coding": [{"code": status}]})
        write_bundles(source, **{f"f{n}": bundle_of(changed, PATIENT)})
        ingest.stream_bronze(spark, str(source), sink, str(tmp_path / "c1"), loaded_at=F.lit(day(n))).awaitTermination()
        ingest.stream_upsert(spark, sink, "Condition", name, str(tmp_path / "c2"), str(tmp_path / "t")).awaitTermination()
        row = one(spark.table(name))
        assert (row[key], row.clinical_status) == ("c-9", status)
    assert spark.table(name).columns == silver.silver_condition(spark.read.schema(contracts.BRONZE).parquet(sink)).columns
