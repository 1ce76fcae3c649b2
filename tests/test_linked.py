"""Persons by shared identifiers, several targets of a code, several ingredients of a text."""

import random

import pytest
from conftest import HEALTH_ID, ICD10, PATIENT, bundle_of

from clinlake.operators import extensions, identity, silver, vocab
from clinlake.plans import build, incremental
from clinlake.plans.build import Layers
from clinlake.sources import tables


def holders(spark, rows, patients=None):
    held = spark.createDataFrame(rows, "fhir_patient_id string, system string, value string")
    names = patients if patients is not None else sorted({r[0] for r in rows if r[0]})
    frame = spark.createDataFrame([(n,) for n in names], "fhir_patient_id string")
    return {r.fhir_patient_id: r.holder for r in identity.person_identity(frame, held).collect()}


def test_a_record_with_two_ids_joins_the_records_of_both(spark):
    rows = [("b", "s", "1"), ("c", "s", "1"), ("c", "s", "2"), ("d", "s", "2"), ("e", "t", "2"), ("f", "s", None), ("g", "s", " "), ("h", None, "1")]
    assert holders(spark, rows) == {"b": "b", "c": "b", "d": "b", "e": "e", "f": "f", "g": "g", "h": "h"}


def test_ids_of_unknown_records_and_no_ids_at_all(spark):
    assert holders(spark, [("a", "s", "1"), ("b", "s", "1")], ["b", "c", None]) == {"b": "b", "c": "c"}
    assert holders(spark, [], ["x"]) == {"x": "x"}


def test_components_equal_a_search_over_random_graphs_and_long_chains(spark):
    rng = random.Random(5)
    links = [(f"n{rng.randrange(900):04d}", f"n{rng.randrange(900):04d}") for _ in range(420)]
    links += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(130)] + [("hub", f"h{i:03d}") for i in range(400)]
    rng.shuffle(links)
    parent = {n: n for e in links for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r.node: r.holder for r in identity.connected(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {n: root(n) for e in links if e[0] != e[1] for n in e}


def test_build_with_shared_identity_makes_one_person_of_connected_records(spark, concept, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    other = {"system": "https://healthid.ndhm.gov.in", "value": "77-0001-0002-0003"}
    first, second = PATIENT, {**PATIENT, "id": "p-32", "identifier": [*PATIENT["identifier"], other]}
    third, alone = {**PATIENT, "id": "p-33", "identifier": [other]}, {**PATIENT, "id": "p-34", "identifier": []}
    (folder / "a.json").write_text(bundle_of(first, second, third, alone))
    layers = Layers("same_bronze", "same_silver", "same_gold", location=str(tmp_path), shared_identity=True)
    build.land(spark, str(folder), layers)
    build.load_vocabulary(spark, concept, None, layers)
    build.refresh_silver(spark, layers)
    persons = build.refresh_gold(spark, layers)["omop_person"].collect()
    assert sorted(p.person_source_value for p in persons) == [HEALTH_ID, "p-34"]
    crosswalk = identity.identity_crosswalk(spark.table("same_gold.person_identity")).df
    assert crosswalk.select("person_id").distinct().count() == 2 and crosswalk.count() == 4
    assert {p.person_id for p in persons} == {r.person_id for r in crosswalk.collect()}
    with pytest.raises(ValueError, match="shared national ids"):
        incremental.refresh_gold_incremental(spark, layers)


def test_a_code_with_two_targets_gives_two_numbered_rows(spark, raw, raw_concept):
    from conftest import CONDITION, codings

    edges = spark.createDataFrame([(90000004, 317009, "Maps to"), (90000004, 90000001, "Maps to"), (90000004, 90000001, "Maps to"), (90000004, 8507, "Is a")],
                                  "concept_id_1 bigint, concept_id_2 bigint, relationship_id string")
    targets = vocab.source_to_standard_targets(raw_concept, edges)
    facts = silver.silver_condition(raw({**CONDITION, "code": codings(("J45", ICD10, ""))}, CONDITION, {**CONDITION, "code": None}))
    rows = extensions.map_source_to_standards(facts, targets, "condition_source_vocabulary", "condition_source_code", "c").collect()
    assert sorted((r._lineage_id, r.target_no, r.c, r.target_count) for r in rows) == [
        ("lin-0", 1, 317009, 2), ("lin-0", 2, 90000001, 2), ("lin-1", 1, 0, 0), ("lin-2", 1, 0, 0)
    ]
    assert len({r.target_key for r in rows}) == 4
    empty = extensions.map_source_to_standards(facts, targets.limit(0), "condition_source_vocabulary", "condition_source_code", "c")
    assert [r.c for r in empty.collect()] == [0, 0, 0]


BRANDS = [("Calmex", "amlodipine"), ("Calmex Plus", "Amlodipine"), ("Calmex Plus", "losartan"), ("Nil", None), (None, "x")]
NAMED = [
    ("CALMEX plus 5 mg", [("amlodipine", 11), ("losartan", 12)], 2),
    ("Calmex + Losartan", [("amlodipine", 11), ("losartan", 12)], 0),
    ("losartan/amlodipine losartan", [("losartan", 12), ("amlodipine", 11)], 0),
    ("plus Calmex", [("amlodipine", 11)], 1),
    ("folic acid tablet", [("folic acid", 13)], 1),
    ("acid folic", [(None, 0)], 2),
    ("Nil", [(None, 0)], 1),
    ("", [(None, 0)], 0),
    (None, [(None, 0)], None),
]


def test_longest_names_first_and_all_ingredients(spark):
    concept = spark.createDataFrame(
        [(11, "Amlodipine", "RxNorm", "S"), (12, "losartan", "RxNorm", "S"), (13, "Folic  Acid", "RxNorm Extension", "S"), (9, "losartan", "RxNorm", None), (3, "acid", "SNOMED", "S")],
        "concept_id bigint, concept_name string, vocabulary_id string, standard_concept string",
    )
    brands = spark.createDataFrame(BRANDS, "brand_name string, ingredient string")
    meds = spark.createDataFrame([(f"l{i}", t) for i, (t, _, _) in enumerate(NAMED)] * 2, "_lineage_id string, drug_source_display string")
    rows = extensions.drug_ingredients(meds.withColumn("n", vocab.F.lit(1)), brands, concept).collect()
    want = [(f"l{i}", k + 1, name, number, number == 0, left) for i, (_, found, left) in enumerate(NAMED) for k, (name, number) in enumerate(found)]
    got = [(r._lineage_id, r.ingredient_no, r.ingredient, r.ingredient_concept_id, r.is_unmapped, r.unmatched_words) for r in rows]
    assert sorted(got, key=repr) == sorted(want * 2, key=repr)
    none = extensions.drug_ingredients(meds, brands.limit(0), concept.limit(0))
    assert {(r.ingredient_no, r.is_unmapped) for r in none.collect()} == {(1, True)}


def test_a_hot_identifier_is_split(spark):
    """A number held by a third of all records: links stay as many as holdings."""
    rows = spark.range(3000).selectExpr("concat('p', id) AS fhir_patient_id", "'s' AS system", "IF(id % 3 = 0, 'hot', concat('v', id)) AS value")
    links = tables.staged(identity.shared_links(rows))
    assert links.count() == 999
    assert links.select("b").distinct().count() == 1
