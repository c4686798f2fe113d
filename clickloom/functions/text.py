"""Times, id lists, JSON fields and the string helpers of the product job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
# One `H` also reads hours written without a leading zero.
TIME_PATTERN = "yyyy-MM-dd H:mm:ss[.SSSSSS]"


def parse_time(value: Column) -> Column:
    """Time of day after a space or a `T`, with or without a fraction; NULL if unreadable."""
    return F.try_to_timestamp(F.replace(value, F.lit("T"), F.lit(" ")), F.lit(TIME_PATTERN))


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def date_hour(value: Column) -> Column:
    """`yyyy-MM-dd_HH` key of a timestamp."""
    return F.date_format(value, "yyyy-MM-dd_HH")


def id_list(value: Column) -> Column:
    """Comma list to an array of its parts; NULL stays NULL."""
    return F.split(value, ",")


def trim_commas(value: Column) -> Column:
    """Remove one comma at either end."""
    return F.regexp_replace(value, "^,|,$", "")


def json_field(document: Column, field: str) -> Column:
    """Top-level field of a JSON document as text; NULL when missing or malformed."""
    return F.get_json_object(document, f"$['{field}']")


def parsed_document(document: Column) -> Column:
    """A JSON text as a VARIANT, parsed once for all fields read of it; NULL when malformed."""
    return F.try_parse_json(document)


def variant_field(document: Column, path: str, kind: str = "string") -> Column:
    """A field of a parsed document, as in `$.a.b[0]`; NULL when missing or of another kind."""
    return F.try_variant_get(document, path, kind)


def concat_long_string(number: Column, text: Column, separator) -> Column:
    """`number + separator + text`; a NULL prints as "null"."""
    missing = F.lit("null")
    return F.concat(
        F.coalesce(number.cast("string"), missing),
        separator if isinstance(separator, Column) else F.lit(separator),
        F.coalesce(text, missing),
    )


def random_prefix(value: Column, count, seed: int | None = None) -> Column:
    """`<0..count-1>_value`. For skew handling prefer `operators.skew`, whose salts are repeatable."""
    return F.concat(F.floor(F.rand(seed) * count).cast("int").cast("string"), F.lit("_"), value)


def remove_random_prefix(value: Column) -> Column:
    return F.regexp_replace(value, "^[0-9]+_", "")


def group_concat_distinct(value: Column) -> Column:
    """Aggregate: sorted distinct values as a comma list (empty string when there are none)."""
    return F.array_join(F.array_sort(F.collect_set(value)), ",")
