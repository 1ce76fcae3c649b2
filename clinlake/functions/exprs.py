"""Column builders shared by the operators. Everything here stays inside the JVM.

ANSI mode may stay on: text is converted with ``try_cast`` and so gives null, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake import config

IDENTIFIER_LIST = "array<struct<system:string,value:string>>"


# -- JSON ---------------------------------------------------------------------------

def json_path(json: Column | str, path: str) -> Column:
    """One value of a JSON text by path; null when absent."""
    return F.get_json_object(json, path)


def parse_json_array(json: Column | str, ddl: str = IDENTIFIER_LIST) -> Column:
    return F.from_json(json, ddl)


def safe_get(array: Column, index: int = 0) -> Column:
    """Array element, null when out of range (``[i]`` raises under ANSI)."""
    return F.get(array, F.lit(index))


def identifier_by_system(identifiers: Column, system: str, negate: bool = False) -> Column:
    """Value of the first identifier of (or, negated, not of) ``system``."""
    keep = (lambda x: x["system"] != system) if negate else (lambda x: x["system"] == system)
    return safe_get(F.filter(identifiers, keep)).getField("value")


def first_coding(concept: Column) -> Column:
    """First coding of a codeable concept."""
    return safe_get(concept["coding"])


def has_profile(json: Column | str, profile: str = config.CONSENT_PROFILE) -> Column:
    """Whether ``meta.profile`` of a resource lists ``profile``; false when it has none."""
    profiles = F.from_json(F.get_json_object(json, "$.meta.profile"), "array<string>")
    return F.coalesce(F.array_contains(profiles, F.lit(profile)), F.lit(False))


# -- text to value ----------------------------------------------------------------------

def to_date(text: Column) -> Column:
    """Date of an ISO text. A partial date (``2020``, ``2020-05``) gives its first day."""
    return text.try_cast("date")


def to_timestamp(text: Column) -> Column:
    """Instant of an ISO text with or without an offset; the offset itself is not kept."""
    return text.try_cast("timestamp")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def strip_reference(reference: Column, resource_type: str) -> Column:
    """``Patient/123`` to ``123``."""
    return F.regexp_replace(reference, f"^{resource_type}/", "")


# -- derived values ------------------------------------------------------------------------

def duration_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two timestamps; null while either is missing."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).try_cast("int")


def days_as_minutes(start: Column, end: Column) -> Column:
    return F.datediff(end, start) * 1440


def doses_per_day(frequency: Column, period: Column, unit: Column) -> Column:
    """Frequency over period, only where the period is counted in days."""
    return F.when(unit == "d", F.try_divide(frequency, period))


def deceased(flag: Column, date_time: Column) -> Column:
    return F.when(flag == "true", True).when(date_time.isNotNull(), True).otherwise(False)


def value_type(quantity: Column, code: Column, text: Column) -> Column:
    """Which of the value variants an observation carries."""
    return (
        F.when(quantity.isNotNull(), "valueQuantity")
        .when(code.isNotNull(), "valueCodeableConcept")
        .when(text.isNotNull(), "valueString")
        .otherwise("no_value")
    )


def health_id_status(health_id: Column) -> Column:
    return (
        F.when(health_id.isNull(), "Missing")
        .when(health_id.rlike(config.HEALTH_ID_PATTERN), "Valid")
        .otherwise("Invalid")
    )


def digit_count(text: Column) -> Column:
    return F.length(F.replace(text, F.lit("-"), F.lit("")))


def vocabulary_of(system: Column) -> Column:
    """Vocabulary name of a code-system URL; null when the system is absent or unknown."""
    pairs = [F.lit(x) for pair in config.SYSTEM_VOCABULARY.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), system)


# -- keys and hashes --------------------------------------------------------------------

def surrogate_key(natural_key: Column) -> Column:
    """Non-negative BIGINT key of a source id; null for a null id.

    ``abs`` of the 64-bit hash, with the one value ``abs`` cannot represent mapped to 0.
    """
    h = F.xxhash64(natural_key)
    lowest = F.lit(-(2**63)).cast("bigint")
    return F.when(natural_key.isNotNull(), F.when(h == lowest, F.lit(0).cast("bigint")).otherwise(F.abs(h)))


def place_key(state: Column, postal_code: Column) -> Column:
    """Key of a state and postal code, where an empty text is a missing one; null where both are missing."""
    state, postal_code = F.when(state != "", state), F.when(postal_code != "", postal_code)
    place = F.concat_ws("|", F.coalesce(state, F.lit("")), F.coalesce(postal_code, F.lit("")))
    return F.when(state.isNotNull() | postal_code.isNotNull(), surrogate_key(place))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def lineage_id(source_file: Column, resource_id: Column, resource_json: Column) -> Column:
    """Stable id of a resource in a file. A resource without id is named by its own hash."""
    return F.sha2(F.concat_ws("|", source_file, F.coalesce(resource_id, F.sha2(resource_json, 256))), 256)


# -- constants and shares ------------------------------------------------------------------

def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def bigint(value: int) -> Column:
    return F.lit(value).cast("bigint")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded share in percent; null for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def exact_avg(value: Column, digits: int) -> Column:
    """Rounded mean of all values of a DOUBLE column, summed as decimals.

    Floating sums depend on the order in which partitions arrive; this one does not. Where a
    value is no decimal of six digits (huge, tiny, infinite or NaN), it is the floating mean.
    """
    exact = value.try_cast("decimal(28,6)")
    beyond = value.isNotNull() & (exact.isNull() | (exact.cast("double") != value))
    mean = F.when(F.coalesce(F.bool_or(beyond), F.lit(False)), F.avg(value)).otherwise(F.avg(exact).cast("double"))
    return F.round(mean, digits)
