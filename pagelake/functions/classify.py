"""Classification of documents by mail thread position and by file name."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake.functions.text import casefold, collapse_spaces

# Thread index layout in bytes.
INDEX_HEADER_BYTES = 22
INDEX_REPLY_BYTES = 5

# File name parts of a teaser.
TEASER_TOKENS = (
    "teaser",
    "teaser-deck",
    "cim",
    "one-pager",
    "onepager",
    "flyer",
    "overview",
)

# File name parts of a returned document.
RETURN_TOKENS = (
    "return",
    "returned",
    "redline",
    "redlined",
    "markup",
    "marked-up",
    "markedup",
    "counter",
    "countersigned",
    "revised",
    "comments",
    "tracked",
)

# Roles.
FRESH = "fresh_nda"
RETURNED = "counterparty_return"
TEASER = "teaser"

FIRST_RETURN_ROUND = 2

# The reply or forward prefix of a subject, and a round number in a file name.
_SPACE = r"[\s\x1c-\x1f]*"
_PREFIX = rf"{_SPACE}(?:re|fw|fwd|aw|wg|antw|tr|rv|res|sv|vs){_SPACE}(?:\[\d+\])?{_SPACE}:"
_ROUND = r"(?i)(?:^|[ _\-.])(?:version|round|draft|iteration|iter|rev|v|r)[ _\-.]*(\d{1,3})(?!\d)"


def conversation_depth(index: Column) -> Column:
    """Depth of a message from its base64 thread index.

    The byte length follows from the text length and its padding, so nothing is
    decoded; text that strict base64 would refuse counts as depth 0.
    """
    valid = index.rlike(r"\A[A-Za-z0-9+/]*={0,2}\z") & (F.length(index) % 4 == 0)
    padding = F.length(index) - F.length(F.rtrim(index, F.lit("=")))
    size = (F.length(index) / 4 * 3).cast("int") - padding
    depth = F.floor((size - INDEX_HEADER_BYTES) / INDEX_REPLY_BYTES).cast("int")
    return F.when(valid & (size > INDEX_HEADER_BYTES), depth).otherwise(F.lit(0))


def subject_is_reply(subject: Column) -> Column:
    """True for a subject with a reply or forward prefix."""
    return F.coalesce(subject.rlike(rf"(?iU)\A{_PREFIX}"), F.lit(False))


def normalize_subject(subject: Column) -> Column:
    """Subject without its prefixes, white space collapsed, case folded; NULL gives ``''``."""
    bare = F.regexp_replace(subject, rf"(?iU)\A(?:{_PREFIX}{_SPACE})+", "")
    return F.coalesce(casefold(collapse_spaces(bare)), F.lit(""))


def has_token(name: Column, tokens: tuple[str, ...]) -> Column:
    """True where the folded name contains one of the tokens anywhere."""
    return F.coalesce(casefold(name).rlike("|".join(map(re.escape, tokens))), F.lit(False))


def round_from_filename(name: Column) -> Column:
    """Largest round number a file name states; NULL without one."""
    numbers = F.regexp_extract_all(name, F.lit(_ROUND), F.lit(1))
    return F.array_max(F.transform(numbers, lambda n: n.cast("int")))


def round_from_thread(is_reply: Column, depth: Column) -> Column:
    """Round a thread position stands for; a reply is at least the first return."""
    base = depth + 1
    return F.when(is_reply, F.greatest(base, F.lit(FIRST_RETURN_ROUND))).otherwise(base)


def classify_mail(filename: Column, subject: Column, index: Column) -> Column:
    """Struct (doc_role, round_no) of a mail attachment."""
    depth = conversation_depth(index)
    is_reply = (depth > 0) | subject_is_reply(subject)
    role = (
        F.when(has_token(filename, TEASER_TOKENS), TEASER)
        .when(is_reply, RETURNED)
        .otherwise(FRESH)
    )
    return F.struct(
        role.alias("doc_role"), round_from_thread(is_reply, depth).cast("bigint").alias("round_no")
    )


def classify_file(filename: Column) -> Column:
    """Struct (doc_role, round_no) of a library file; a stated round 0 counts as none."""
    teaser = has_token(filename, TEASER_TOKENS)
    returned = has_token(filename, RETURN_TOKENS)
    role = F.when(teaser, TEASER).when(returned, RETURNED).otherwise(FRESH)
    default = F.when(~teaser & returned, FIRST_RETURN_ROUND).otherwise(1)
    stated = F.nullif(round_from_filename(filename), F.lit(0))
    return F.struct(
        role.alias("doc_role"), F.coalesce(stated, default).cast("bigint").alias("round_no")
    )


def thread_key(conversation_id: Column, subject: Column) -> Column:
    """Thread id, or the normalised subject where there is none."""
    return F.coalesce(conversation_id, normalize_subject(subject))
