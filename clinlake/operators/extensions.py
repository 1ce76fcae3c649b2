"""Frames named by the data model or its national profile beyond the six clinical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake import config
from clinlake.functions import exprs as X
from clinlake.operators import joins
from clinlake.operators.bronze import route
from clinlake.operators.joins import Lookup, left_lookup
from clinlake.operators.silver import LINEAGE
from clinlake.sources.contracts import CDM, conform
from clinlake.sources.tables import staged


def consent_audit(bronze: DataFrame) -> DataFrame:
    """Consent resources of the national profile."""
    shape = (
        "id string, status string, scope struct<coding:array<struct<system:string,code:string>>>, "
        "patient struct<reference:string>, dateTime string, "
        "organization array<struct<reference:string>>, policy array<struct<uri:string>>"
    )
    consents = bronze.filter(F.lower("resource_type") == "consent").filter(X.has_profile("resource_json"))
    parsed = consents.select(F.from_json("resource_json", shape).alias("r"), *LINEAGE)
    return parsed.select(
        F.col("r.id").alias("fhir_consent_id"),
        X.strip_reference(F.col("r.patient.reference"), "Patient").alias("fhir_patient_id"),
        F.col("r.status").alias("status"),
        X.first_coding(F.col("r.scope"))["code"].alias("scope_code"),
        X.to_timestamp(F.col("r.dateTime")).alias("consent_datetime"),
        X.strip_reference(X.safe_get(F.col("r.organization"))["reference"], "Organization").alias("organization_id"),
        X.safe_get(F.col("r.policy"))["uri"].alias("policy_uri"),
        *LINEAGE,
    )


# -- care sites, locations, providers ----------------------------------------------------------

def care_site(encounter: DataFrame) -> DataFrame:
    """One row per facility-registry code. A facility under several names keeps the first by name."""
    sites = encounter.filter(F.col("hfr_facility_code").isNotNull()).groupBy("hfr_facility_code")
    named = sites.agg(F.min("facility_name").alias("care_site_name"))
    keyed = named.select(
        X.surrogate_key(F.col("hfr_facility_code")).alias("care_site_id"),
        "care_site_name",
        F.col("hfr_facility_code").alias("care_site_source_value"),
    )
    return conform(keyed, CDM["care_site"])


def care_site_id(encounter: DataFrame) -> DataFrame:
    """Encounters with the id of their care site. The id is made of the registry code, so no join is needed."""
    return encounter.withColumn("care_site_id", X.surrogate_key(F.col("hfr_facility_code")))


def _said(name: str) -> Column:
    """A text column with empty texts as null."""
    return F.when(F.col(name) != "", F.col(name))


def location(patient: DataFrame) -> DataFrame:
    """One row per state and postal code; an empty text is a missing one, so that no two rows share an id."""
    distinct = patient.select(_said("state").alias("state"), _said("postal_code").alias("postal_code")).distinct()
    distinct = distinct.filter(F.col("state").isNotNull() | F.col("postal_code").isNotNull())
    keyed = distinct.select(
        X.place_key(F.col("state"), F.col("postal_code")).alias("location_id"), "state", F.col("postal_code").alias("zip")
    )
    return conform(keyed, CDM["location"])


def location_id(patient: DataFrame) -> DataFrame:
    """Patients with the id of their location. The id is made of the place, so no join is needed."""
    return patient.withColumn("location_id", X.place_key(F.col("state"), F.col("postal_code")))


def provider(bronze: DataFrame) -> DataFrame:
    """One row per practitioner-registry code named by an encounter."""
    shape = (
        "participant array<struct<individual:struct<display:string,"
        "identifier:struct<system:string,value:string>>>>"
    )
    parsed = route(bronze, "Encounter").select(F.from_json("resource_json", shape)["participant"].alias("p"))
    people = parsed.select(F.explode("p").alias("p")).select("p.individual.*")
    coded = people.filter(F.col("identifier.system") == config.PRACTITIONER_SYSTEM)
    named = coded.groupBy(F.col("identifier.value").alias("provider_source_value")).agg(
        F.min("display").alias("provider_name")
    )
    keyed = named.withColumn("provider_id", X.surrogate_key(F.col("provider_source_value")))
    return conform(keyed, CDM["provider"])


def visit_references(visits: DataFrame, sites: DataFrame, providers: DataFrame) -> DataFrame:
    """Gold visits with the source value and name of their care site and provider, found by id; null where an id leads nowhere.

    The sites and the providers are read for their size and for their rows, so each is staged first.
    """
    sites = sites.select("care_site_id", "care_site_source_value", "care_site_name")
    providers = providers.select("provider_id", "provider_source_value", "provider_name")
    for dimension, key in ((staged(sites), "care_site_id"), (staged(providers), "provider_id")):
        lookup = Lookup(dimension.withColumnRenamed(key, "_id"), ("_id",), joins.fits_broadcast(dimension))
        visits = left_lookup(visits, lookup, [F.col(key)], F.col("_lineage_id"))
    return visits


def person_locations(persons: DataFrame, locations: DataFrame) -> DataFrame:
    """Gold persons with the state and postal code of their location, found by id."""
    places = staged(locations.select(F.col("location_id").alias("_id"), "state", "zip"))
    return left_lookup(persons, Lookup(places, ("_id",), joins.fits_broadcast(places)), [F.col("location_id")], F.col("_lineage_id"))


# -- source codes and drug names -----------------------------------------------------------------

def map_source_to_standard(facts: DataFrame, keys: DataFrame, system: str, code: str, out: str) -> DataFrame:
    """Adds the standard concept a source code maps to; ``keys`` from ``source_to_standard_keys``."""
    lookup = Lookup(keys, ("vocabulary", "concept_code"), joins.fits_broadcast(keys))
    joined = left_lookup(facts, lookup, [X.vocabulary_of(F.col(system)), F.col(code)], F.col("_lineage_id"))
    return joined.withColumnRenamed("concept_id", out).withColumn(out, F.coalesce(out, X.bigint(config.UNMAPPED)))


def map_source_to_standards(facts: DataFrame, targets: DataFrame, system: str, code: str, out: str) -> DataFrame:
    """One row per fact and standard concept its source code maps to; ``targets`` from ``source_to_standard_targets``.

    Adds the concept ``out``, ``target_no`` from 1 in the order of concept ids, ``target_count`` and ``target_key``, a
    surrogate key of lineage and number. A fact without a target keeps one row: concept 0, number 1, count 0. The lookup has one
    row per code, so facts meet it like any other lookup and fan out only afterwards, each in its own task.
    """
    names = facts.columns
    small = joins.fits_broadcast(targets.select("vocabulary", "concept_code", F.explode("targets")))
    lookup = Lookup(targets, ("vocabulary", "concept_code"), small)
    joined = left_lookup(facts, lookup, [X.vocabulary_of(F.col(system)), F.col(code)], F.col("_lineage_id"))
    known = F.coalesce("targets", F.array(X.bigint(config.UNMAPPED)))
    counted = F.coalesce(F.size("targets"), F.lit(0)).cast("bigint").alias("target_count")
    rows = joined.select(*names, counted, F.posexplode(known).alias("target_no", out))
    rows = rows.withColumn("target_no", (F.col("target_no") + 1).cast("bigint"))
    key = F.concat_ws("|", "_lineage_id", F.col("target_no").cast("string"))
    return rows.withColumn("target_key", X.surrogate_key(key))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def ingredient_index(brands: DataFrame, concept: DataFrame) -> DataFrame:
    """name (words joined by spaces), n (words), ingredients (ingredient, ingredient_concept_id): one row per name.

    Names are brands, which stand for all of their ingredients, and ingredients themselves. An ingredient that no standard
    drug concept is named by has concept 0.
    """
    said = lambda c: F.array_join(_words(F.col(c)), " ")
    drugs = concept.filter(F.col("vocabulary_id").isin(config.DRUG_VOCABULARIES) & (F.col("standard_concept") == "S"))
    known = drugs.groupBy(said("concept_name").alias("ingredient")).agg(F.min("concept_id").alias("id")).filter("ingredient <> ''")
    parts = brands.select(said("brand_name").alias("name"), said("ingredient").alias("ingredient"))
    parts = parts.unionByName(known.select(F.col("ingredient").alias("name"), "ingredient")).filter("name <> '' AND ingredient <> ''")
    named = parts.distinct().join(known, "ingredient", "left")
    one = F.struct("ingredient", F.coalesce("id", X.bigint(config.UNMAPPED)).alias("ingredient_concept_id"))
    listed = named.groupBy("name").agg(F.array_sort(F.collect_set(one)).alias("ingredients"))
    return listed.withColumn("n", F.size(F.split("name", " ")))


def found_ingredients(texts: DataFrame, index: DataFrame) -> DataFrame:
    """text, ingredients, unmatched_words: what each text of the column ``text`` names.

    Runs of words as long as any name of the index are looked up by equality, leftmost first, longest first, without overlap:
    in `a b + c` the name `a b` wins over `a`. An ingredient named twice is listed once, at its first place.
    """
    # At most as many lengths as the longest name has words.
    lengths = sorted(r["n"] for r in index.select("n").distinct().collect())
    words = texts.select("text", _words(F.col("text")).alias("words"))
    runs = [
        F.expr(
            f"CASE WHEN size(words) >= {n} THEN transform(sequence(0, size(words) - {n}), "
            f"i -> named_struct('at', i, 'n', {n}, 'name', array_join(slice(words, i + 1, {n}), ' '))) "
            "ELSE cast(array() AS array<struct<at int, n int, name string>>) END"
        )
        for n in lengths
    ]
    if not runs:
        nothing = F.array().cast("array<struct<ingredient:string,ingredient_concept_id:bigint>>")
        return words.select("text", nothing.alias("ingredients"), F.size("words").cast("bigint").alias("unmatched_words"))
    each = words.select("text", F.explode(F.concat(*runs)).alias("r")).select("text", "r.*")
    names = index.select(joins.own_shuffle(F.col("name")).alias("_k"), "ingredients")
    if joins.fits_broadcast(index.select("name", F.explode("ingredients.ingredient"))):
        names = F.broadcast(names)
    hits = each.withColumn("_k", joins.own_shuffle(F.col("name"))).join(names, "_k")
    hits = hits.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("shorter"), "ingredients"))).alias("hits"))
    chosen = F.expr(
        """aggregate(hits, named_struct('past', 0, 'kept', slice(hits, 1, 0)),
        (s, h) -> CASE WHEN h.at >= s.past THEN named_struct('past', h.at - h.shorter, 'kept', array_append(s.kept, h)) ELSE s END,
        s -> s.kept)"""
    )
    hits = hits.select("text", chosen.alias("kept"))
    covered = F.expr("aggregate(kept, 0, (n, h) -> n - h.shorter)").alias("covered")
    hits = hits.select("text", F.array_distinct(F.flatten("kept.ingredients")).alias("ingredients"), covered)
    left = (F.size("words") - F.coalesce("covered", F.lit(0))).cast("bigint").alias("unmatched_words")
    return words.join(hits, "text", "left").select("text", "ingredients", left)


def drug_ingredients(medication: DataFrame, brands: DataFrame, concept: DataFrame) -> DataFrame:
    """One row per prescription and ingredient its text names: brands, ingredients and combinations of them (`A + B`).

    Adds ``ingredient_no`` from 1, ``ingredient``, ``ingredient_concept_id`` (0 where no concept is named so), ``is_unmapped`` and
    ``unmatched_words``, the words of the text in no name. A text that names nothing, and a missing one, keeps one row without
    an ingredient. Each distinct text is searched once. ``brands`` has ``brand_name, ingredient``, one row per ingredient.
    """
    names = medication.columns
    texts = medication.select(F.col("drug_source_display").alias("text")).filter("text IS NOT NULL").distinct()
    # Searched once, for its size and for the join.
    found = staged(found_ingredients(texts, ingredient_index(brands, concept)))
    small = joins.fits_broadcast(found.select("text", F.explode_outer("ingredients.ingredient")))
    joined = left_lookup(medication, Lookup(found, ("text",), small), [F.col("drug_source_display")], F.col("_lineage_id"))
    rows = joined.select(*names, "unmatched_words", F.posexplode_outer("ingredients").alias("ingredient_no", "i"))
    concept_id = F.coalesce("i.ingredient_concept_id", X.bigint(config.UNMAPPED))
    number = (F.coalesce("ingredient_no", F.lit(0)) + 1).cast("bigint").alias("ingredient_no")
    return rows.select(
        *names, number, F.col("i.ingredient").alias("ingredient"), concept_id.alias("ingredient_concept_id"),
        (concept_id == 0).alias("is_unmapped"), "unmatched_words",
    )


def drug_name_normalize(medication: DataFrame, brands: DataFrame, concept: DataFrame) -> DataFrame:
    """Adds ingredient and drug concept of a brand name, and whether it stays unmapped.

    ``brands`` has ``brand_name, ingredient``. An ingredient is found by concept name.
    """
    words = lambda name: F.lower(F.trim(F.col(name)))
    ingredients = (
        concept.filter(F.col("vocabulary_id").isin(config.DRUG_VOCABULARIES) & (F.col("standard_concept") == "S"))
        .groupBy(words("concept_name").alias("ingredient"))
        .agg(F.min("concept_id").alias("ingredient_concept_id"))
    )
    brand_keys = brands.groupBy(words("brand_name").alias("brand")).agg(F.min(words("ingredient")).alias("ingredient"))
    keys = brand_keys.join(ingredients, "ingredient", "left")
    lookup = Lookup(keys, ("brand",), joins.fits_broadcast(brands))
    joined = left_lookup(medication, lookup, [words("drug_source_display")], F.col("_lineage_id"))
    concept_id = F.coalesce("ingredient_concept_id", X.bigint(config.UNMAPPED))
    return joined.withColumn("ingredient_concept_id", concept_id).withColumn("is_unmapped", concept_id == 0)


# -- one person for several patient ids ------------------------------------------------------------

def abha_crosswalk(patient: DataFrame) -> Lookup:
    """Patient id to person id, where patients that share a well-formed national id are one person.

    Usable in place of ``person_crosswalk``. The person id is made of the shared id itself, so
    no group of patients is gathered to choose it.
    """
    shared = F.when(F.col("abha_id").rlike(config.HEALTH_ID_PATTERN), F.col("abha_id"))
    ids = patient.filter(F.col("fhir_patient_id").isNotNull()).groupBy("fhir_patient_id")
    keyed = ids.agg(F.min(shared).alias("abha_id"))
    person = X.surrogate_key(F.coalesce("abha_id", "fhir_patient_id"))
    return Lookup(keyed.select("fhir_patient_id", person.alias("person_id")), ("fhir_patient_id",))


def abha_duplicates(patient: DataFrame) -> DataFrame:
    """National ids held by more than one patient id, with how many."""
    held = patient.filter(F.col("abha_id").rlike(config.HEALTH_ID_PATTERN))
    counted = held.groupBy("abha_id").agg(F.countDistinct("fhir_patient_id").alias("patients"))
    return counted.filter(F.col("patients") > 1)
