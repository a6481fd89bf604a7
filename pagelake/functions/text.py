"""Text folding and name normalisation."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _folds() -> dict[str, str]:
    """Characters whose case fold is not their lower case, from the Unicode rule itself.

    Capital sigma is added because its lower case depends on its place in the word.
    """
    points = [*range(0x80, 0xD800), *range(0xE000, 0x10000)]
    table = {c: c.casefold() for c in map(chr, points) if c.casefold() != c.lower()}
    table["Σ"] = "σ"
    return table


def _char_class(chars: list[str]) -> str:
    """Regex class of the characters, neighbours joined to ranges."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in ranges) + "]"


# Latin text has folds of its own only for these two letters.
_MAY_FOLD = r"[\xb5\xdf\x{130}-\x{ffff}]"


def casefold(value: Column) -> Column:
    """Unicode case folding.

    Plain text takes the ``lower`` path. One-to-one folds and sharp s are put in before
    lowering; only text with a rarer fold is mapped character by character.
    """
    folds = _folds()
    single = [c for c, f in folds.items() if len(f) == 1 and f.lower() == f]
    rare = [c for c in folds if c not in single and c != "ß"]
    # One literal that Spark folds to a map, instead of hundreds of plan nodes.
    mapping = F.str_to_map(
        F.lit(",".join(f"{c}={f}" for c, f in folds.items())), F.lit(","), F.lit("=")
    )
    by_char = F.transform(
        F.split(value, ""), lambda c: F.coalesce(F.try_element_at(mapping, c), F.lower(c))
    )
    swapped = F.translate(value, "".join(single), "".join(folds[c] for c in single))
    return (
        F.when(~value.rlike(_MAY_FOLD), F.lower(value))
        .when(value.rlike(_char_class(rare)), F.array_join(by_char, ""))
        .otherwise(F.lower(F.replace(swapped, F.lit("ß"), F.lit("ss"))))
    )


def collapse_spaces(value: Column) -> Column:
    """Runs of white space as one space, none at either end."""
    return F.trim(F.regexp_replace(value, r"(?U)[\s\x1c-\x1f]+", " "))


def snake_case(name: str) -> str:
    """Column name: words of a camel or Pascal case name joined by ``_``, lower case."""
    name = re.sub(r"[^0-9A-Za-z_]+", "_", name.strip())
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    return name.strip("_").lower() or "_"


def email_domain(address: Column) -> Column:
    """Folded text after the last ``@``; NULL without one."""
    tail = F.substring_index(address, "@", -1)
    return F.when(F.contains(address, F.lit("@")), F.nullif(casefold(tail), F.lit("")))
