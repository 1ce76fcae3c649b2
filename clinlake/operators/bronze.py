"""Bundles to raw resources: one row per resource, its JSON kept as text.

All of it is a narrow map over files: parse, explode, hash. No Python worker, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.functions import exprs as X
from clinlake.sources.contracts import BRONZE

_STRICT = {"allowSingleQuotes": "false"}


def _documents(bundle_json: Column, entry_type: str) -> Column:
    """The text as a list of documents.

    The text is read inside brackets, so that anything after the closing brace makes it
    invalid, as for a strict parser; a lone object gives a list of one.
    """
    shape = f"array<struct<entry:array<{entry_type}>>>"
    return F.from_json(F.concat(F.lit("["), bundle_json, F.lit("]")), shape, _STRICT)


def _only(documents: Column) -> Column:
    return F.when(F.size(documents) == 1, X.safe_get(documents)).getField("entry")


def _once(bundles: DataFrame, value: Column, name: str) -> DataFrame:
    """Bundles with a column that is evaluated once per bundle.

    It comes out of a generator and not a projection: a later filter on it would be moved below a projection, down to
    the scan, and evaluate it, and the text it is taken from, once more for each mention.
    """
    return bundles.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def bundle_resources(bundles: DataFrame) -> DataFrame:
    """Bundles with the list of their resource texts; null unless the text is one JSON object.

    One parse gives the texts where every entry is an object. An entry that is none would
    void the whole list, so such a bundle is read again with its entries as plain texts.
    Each parse is a column of its own, so that it runs once per bundle.
    """
    text = F.col("bundle_json")
    parsed = bundles.withColumn("_documents", _documents(text, "struct<resource:string>"))
    entries = _only(_documents(text, "string"))
    slow = F.transform(entries, lambda e: X.json_path(e, "$.resource"))
    fast = _only(F.col("_documents")).getField("resource")
    return _once(parsed, F.coalesce(fast, slow), "resources").drop("_documents")


def _routed(resources: Column) -> Column:
    """Each resource text with its type and id."""
    return F.transform(
        resources,
        lambda r: F.struct(r.alias("resource_json"), F.from_json(r, "resourceType string, id string").alias("head")),
    )


def _has_type(routed: Column) -> Column:
    return F.coalesce(routed["head"]["resourceType"], F.lit("")) != ""


def build_bronze(bundles: DataFrame) -> DataFrame:
    """The raw-resource table. Entries without a resource or a resource type are skipped,
    resources without an id are kept."""
    return resource_rows(bundle_resources(bundles))


def resource_rows(parsed: DataFrame) -> DataFrame:
    """One row per routable resource of bundles with their ``resources``."""
    lineage = ["_source_file", "_loaded_at", "_content_hash"]
    routed = F.filter(_routed(F.col("resources")), _has_type)
    resources = parsed.select(F.inline(routed), *lineage)
    resource_id = F.col("head.id")
    return resources.select(
        "resource_json",
        F.col("head.resourceType").alias("resource_type"),
        resource_id.alias("fhir_resource_id"),
        X.lineage_id(F.col("_source_file"), resource_id, F.col("resource_json")).alias("_lineage_id"),
        *lineage,
    )


def _reason(documents: Column) -> Column:
    return (
        F.when(F.coalesce(F.col("bundle_json"), F.lit("")).rlike(r"^\s*$"), "empty file")
        .when(documents.isNull() | (F.size(documents) != 1), "not valid JSON")
        .when(X.safe_get(documents).isNull(), "not an object")
        .when(X.safe_get(documents).getField("entry").isNull(), "no entry list")
    )


def quarantine(bundles: DataFrame) -> DataFrame:
    """Files that give no entries, with the reason, so that none is lost silently."""
    parsed = _once(bundles, _documents(F.col("bundle_json"), "string"), "_documents")
    reason = _reason(F.col("_documents")).alias("reason")
    return parsed.select("_source_file", "_content_hash", "_loaded_at", reason).filter(F.col("reason").isNotNull())


def parsed_files(bundles: DataFrame) -> DataFrame:
    """Bundles without their text: their resources, or why they have none. The text of good bundles is parsed once."""
    parsed = bundle_resources(bundles)
    again = _documents(F.col("bundle_json"), "string")
    reason = F.when(F.col("resources").isNull(), F.coalesce(_reason(again), F.lit("no entry list")))
    routed = F.size(F.filter(_routed(F.col("resources")), _has_type))
    return parsed.withColumns({"reason": reason, "n_resources": F.coalesce(routed, F.lit(0)).cast("bigint")}).drop("bundle_json")


def skipped_entries(bundles: DataFrame) -> DataFrame:
    """Files with entries that carry no routable resource, and how many."""
    skipped = F.size(F.filter(_routed(F.col("resources")), lambda r: ~_has_type(r)))
    counted = _once(bundle_resources(bundles), skipped, "skipped").select("_source_file", "skipped")
    return counted.filter(F.col("skipped") > 0)


def route(bronze: DataFrame, resource_type: str) -> DataFrame:
    """Resources of one type. On a table partitioned by type this prunes the scan."""
    return bronze.filter(F.col("resource_type") == resource_type)


def new_files(bundles: DataFrame, bronze: DataFrame) -> DataFrame:
    """Bundles not yet landed, by path and content: an append-only load adds only these."""
    landed = bronze.select("_source_file", "_content_hash").distinct()
    return bundles.join(landed, ["_source_file", "_content_hash"], "left_anti")


def identifiers_exploded(bronze: DataFrame) -> DataFrame:
    """Every identifier of every patient, one per row."""
    identifiers = X.parse_json_array(X.json_path("resource_json", "$.identifier"))
    return (
        route(bronze, "Patient")
        .select(X.json_path("resource_json", "$.id").alias("fhir_patient_id"), F.explode(identifiers).alias("i"))
        .select("fhir_patient_id", F.col("i.system").alias("system"), F.col("i.value").alias("value"))
    )


BRONZE_COLUMNS = BRONZE.fieldNames()
