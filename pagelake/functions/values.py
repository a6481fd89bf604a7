"""Scalar, array and map expressions used by the row transforms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake.functions.jsonpath import is_json_object

# The keys an attribute entry may hold its scalar under, in order.
SCALAR_KEYS = (
    "value",
    "email_address",
    "domain",
    "full_name",
    "original_phone_number",
    "formatted_address",
    "currency_value",
    "referenced_actor_id",
    "target_record_id",
)

_MAP = "map<string,string>"


def entry_scalar(entry: Column) -> Column:
    """Scalar of one attribute entry given as a map of JSON texts.

    The first key of ``SCALAR_KEYS`` that is present decides, also when its value is
    null; without any of them it is the title of an object under ``status``.
    """
    present = F.filter(F.lit(list(SCALAR_KEYS)), lambda k: F.map_contains_key(entry, k))
    status = F.try_element_at(entry, F.lit("status"))
    return F.when(F.size(present) > 0, F.try_element_at(entry, F.get(present, 0))).otherwise(
        F.when(is_json_object(status), F.get_json_object(status, "$.title"))
    )


def scalar_of_json_entry(entry_json: Column) -> Column:
    """Same as :func:`entry_scalar` for an entry given as JSON text."""
    return F.get(F.transform(F.array(F.from_json(entry_json, _MAP)), entry_scalar), 0)


def active_value(entries_json: Column) -> Column:
    """Scalar of the first entry without an ``active_until`` in a JSON list of entries."""
    texts = F.filter(F.from_json(entries_json, "array<string>"), lambda e: F.ltrim(e).startswith("{"))
    maps = F.transform(texts, lambda e: F.from_json(e, _MAP))
    current = F.filter(
        maps, lambda m: m.isNotNull() & F.try_element_at(m, F.lit("active_until")).isNull()
    )
    # As a lambda, so that the entries are parsed once and not once per use.
    return F.get(F.transform(current, entry_scalar), 0)


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds (whole or fractional number) as a UTC timestamp."""
    return F.timestamp_seconds(seconds)


def iso_to_ts(text: Column) -> Column:
    """ISO-8601 text with an offset as a timestamp; anything else is NULL."""
    return text.cast("string").try_cast("timestamp")


def cursor_text(value: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` form of an ISO cursor text."""
    spaced = F.replace(value, F.lit("T"), F.lit(" "))
    return F.substring(F.rtrim(spaced, F.lit("Z")), 1, 19)


def first_value(entries: Column) -> Column:
    """``value`` of element 0 of an array of structs; NULL for an empty or missing array."""
    return F.get(entries, 0)["value"]


def ref_to_id(ref: Column) -> Column:
    """Id of a reference that is either a scalar or an object (given as raw JSON text)."""
    return F.coalesce(
        ref.try_cast("bigint"), F.get_json_object(ref, "$.id").try_cast("bigint")
    )


def joined_key(*parts: Column | str) -> Column:
    """Parts joined by ``:``; NULL if any part is NULL."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(whole, F.concat_ws(":", *cols))


def name_or(name: Column, default: str) -> Column:
    """The name, or ``default`` for a missing or empty one."""
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(default))


def encode_content(content: Column) -> Column:
    """File bytes as one line of base64 text."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))
