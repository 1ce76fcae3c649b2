"""The incremental gold refresh beside full builds, with everything arriving late once."""

import dataclasses

from conftest import CONDITION, ENCOUNTER, MEDICATION, OBSERVATION, PATIENT, at, bundle_of, one, without
from pyspark.sql import functions as F
from test_tables import day, frame, content, layers, name, write_bundles  # noqa: F401

from clinlake.plans import build, incremental
from clinlake.sources import tables


def rows_of(df):
    return sorted(map(repr, (r.asDict() for r in df.drop("_transformed_at", "_bucket").collect())))


def check(spark, layers, concept, n, compare=True):
    """One incremental refresh, compared with a full build of the same silver tables."""
    build.load_vocabulary(spark, concept, None, layers)
    build.refresh_silver(spark, layers)
    mapped = incremental.refresh_gold_incremental(spark, layers, F.lit(day(n)), buckets=4)
    if not compare:
        return mapped
    full = dataclasses.replace(layers, gold=f"{layers.gold}_full")
    build.load_vocabulary(spark, concept, None, full)
    for table, stored in build.refresh_gold(spark, full, F.lit(day(n))).items():
        assert rows_of(spark.table(layers.gold_table(table)).select(*stored.drop("_transformed_at").columns)) == rows_of(stored), table
    return mapped


def test_late_arrivals_and_changes(spark, layers, tmp_path, raw_concept):
    folder = tmp_path / "in"

    def land(n, **texts):
        write_bundles(folder, **texts)
        build.land(spark, str(folder), layers, F.lit(day(n)))

    other = without(CONDITION, id="c-other", subject=at("Patient", "p-other"))
    some = raw_concept.filter("concept_id NOT IN (3004249, 317009)")
    land(1, facts=bundle_of(CONDITION, MEDICATION, OBSERVATION, other), who=bundle_of(without(PATIENT, id="p-other")))
    assert check(spark, layers, some, 1, compare=False)["omop_condition_occurrence"] == 2
    assert one(spark.table(layers.gold_table("omop_measurement"))).person_id is None
    # The patient and the encounter come after the facts.
    land(2, late=bundle_of(PATIENT, ENCOUNTER))
    assert check(spark, layers, some, 2, compare=False) == {
        "omop_person": 1, "omop_visit_occurrence": 1, "omop_condition_occurrence": 1, "omop_drug_exposure": 1,
        "omop_measurement": 1, "omop_observation": 1,
    }
    found = one(spark.table(layers.gold_table("omop_measurement")))
    assert found.person_id is not None and found.visit_occurrence_id != 0
    # Concepts come; a number becomes a text, so that its fact moves from one table to the other.
    land(3, moved=bundle_of(without(OBSERVATION, "valueQuantity", valueString="high")))
    mapped = check(spark, layers, raw_concept, 3)
    assert (mapped["omop_condition_occurrence"], mapped["omop_drug_exposure"]) == (2, 0)
    assert {r.condition_concept_id for r in spark.table(layers.gold_table("omop_condition_occurrence")).collect()} == {317009}
    assert spark.table(layers.gold_table("omop_measurement")).count() == 0
    assert spark.table(layers.gold_table("omop_observation")).count() == 1
    # Concepts go again; nothing else is new.
    mapped = check(spark, layers, some, 4, compare=False)
    assert (mapped["omop_condition_occurrence"], mapped["omop_person"], mapped["omop_drug_exposure"]) == (2, 0, 0)
    assert {r.condition_concept_id for r in spark.table(layers.gold_table("omop_condition_occurrence")).collect()} == {0}
    assert spark.newSession().table(layers.gold_table("lineage_audit")).count() == 7


def test_changed_words(spark):
    schema = "lookup string, vocabulary string, word string, concept_id bigint"
    before = spark.createDataFrame([("a", "", "same", 1), ("a", "", "other", 2), ("a", "", "gone", 3)], schema)
    now = spark.createDataFrame([("a", "", "same", 1), ("a", "", "other", 9), ("a", "", "new", 4)], schema)
    assert sorted(r.word for r in incremental.changed_words(now, before).collect()) == ["gone", "new", "other"]
    assert incremental.changed_words(now, None).count() == 3


def test_a_fact_with_several_changed_keys_is_one_row(spark):
    facts = spark.createDataFrame([("1", "p", "c"), ("2", "q", "c"), ("3", None, None)], "_lineage_id string, a string, b string")
    keys = lambda *v: incremental.changed_keys(spark.createDataFrame([(x,) for x in v], "k string"))
    got = incremental.affected(facts, [(F.col("a"), keys("p", "p", None)), (F.col("b"), keys("c")), (F.col("a"), keys())])
    assert got.columns == facts.columns and sorted(r[0] for r in got.collect()) == ["1", "2"]
    assert incremental.affected(facts, []).count() == 0


def test_rows_are_taken_out_of_their_buckets(spark, name, tmp_path):  # noqa: F811
    tables.upsert_buckets(frame(spark, ("a", 1, day(1)), ("b", 2, day(1)), ("c", 3, day(1))), name, "k", 64, str(tmp_path))
    tables.upsert_buckets(frame(spark, ("b", 4, day(2))), name, "k", location=str(tmp_path), gone=frame(spark, ("a", 0, day(1)), ("x", 0, day(1))))
    assert content(spark.table(name)) == [("b", 4), ("c", 3)]
    tables.upsert_buckets(frame(spark, ("a", 5, day(1))), name, "k", location=str(tmp_path))
    assert content(spark.table(name)) == [("a", 5), ("b", 4), ("c", 3)]
