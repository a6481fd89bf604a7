"""JSON expressions over page bodies and raw JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds survive a round trip only with an explicit format; null fields only
# when they are not dropped.
WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def as_type(schema: T.DataType | str) -> T.DataType:
    """A Spark type from a type or a DDL text (``a string, b bigint`` or ``array<...>``)."""
    if isinstance(schema, T.DataType):
        return schema
    return T.DataType.fromDDL(schema)


def json_field(body: Column | str, path: str) -> Column:
    """Text of the value at a dotted path; NULL for JSON null or a missing key."""
    return F.get_json_object(_col(body), json_path(path))


def json_path(path: str) -> str:
    """``a.b`` as a JSON path; a part that is not a plain name is quoted."""
    if path == "":
        return "$"
    steps = []
    for part in path.split("/") if "/" in path else path.split("."):
        if "[" in part and part.endswith("]"):
            name, index = part[:-1].split("[")
            steps.append(f"['{name}'][{index}]")
        else:
            steps.append(f"['{part}']")
    return "$" + "".join(steps)


def has_key(body: Column | str, path: str, key: str) -> Column:
    """True where the object at ``path`` has ``key``, even with a null value."""
    inner = _col(body) if path == "" else json_field(body, path)
    return F.coalesce(F.array_contains(F.json_object_keys(inner), key), F.lit(False))


def json_truthy(value: Column) -> Column:
    """True for JSON text that is neither missing, null, false, zero nor empty."""
    falsy = ["false", "0", "0.0", "", "[]", "{}"]
    return F.coalesce(~F.trim(value).isin(falsy), F.lit(False))


def json_size(value: Column) -> Column:
    """Length of a JSON array text; 0 where it is missing or no array."""
    return F.coalesce(F.json_array_length(value), F.lit(0))


def to_json_text(value: Column, *, default_empty: bool = True) -> Column:
    """Array (or struct) as JSON text with null fields kept; a missing array is ``[]``."""
    text = F.to_json(value, WRITE_OPTIONS)
    return F.coalesce(text, F.lit("[]")) if default_empty else text


def _selector_steps(selector: str) -> list[tuple[str, bool]]:
    steps = []
    for part in selector.split(".") if selector else []:
        if part.endswith("[*]"):
            steps.append((part[:-3], True))
        else:
            steps.append((part, False))
    return steps


def _nest(steps: list[tuple[str, bool]], leaf: T.DataType) -> T.DataType:
    for name, many in reversed(steps):
        leaf = T.StructType([T.StructField(name, T.ArrayType(leaf) if many else leaf)])
    return leaf


def _walk(value: Column, steps: list[tuple[str, bool]], leaf: T.DataType) -> Column:
    for i, (name, many) in enumerate(steps):
        value = value[name]
        if many:
            rest = steps[i + 1 :]
            empty = F.from_json(F.lit("[]"), leaf)
            # flatten() of a list holding a null list is null, so those become empty.
            inner = F.transform(value, lambda x: F.coalesce(_walk(x, rest, leaf), empty))
            return F.flatten(inner)
    return value


def _has_gap(value: Column, steps: list[tuple[str, bool]]) -> Column:
    """True where some array on the way to the records is null."""
    for i, (name, many) in enumerate(steps):
        value = value[name]
        if many:
            rest = steps[i + 1 :]
            return F.coalesce(F.exists(value, lambda x: _has_gap(x, rest)), F.lit(True))
    return value.isNull()


def records(body: Column, selector: str, record: T.DataType) -> Column:
    """Array of the records an envelope holds.

    ``selector`` is a dotted path, with ``[*]`` after a name that is itself an array;
    the empty selector means the body is the array (or one object). The typed parse
    is tried first. A single element that is no object makes that parse yield NULL
    for the whole array, so in that case the elements are taken as raw text and the
    objects among them are parsed one by one: no page loses rows. A body that is no
    JSON fails the job; that check, too, runs only where nothing was found.
    """
    listed = T.ArrayType(record)
    steps = _selector_steps(selector)
    raw = record_texts(body, selector)
    one_by_one = F.transform(F.filter(raw, _starts_object), lambda x: F.from_json(x, record))
    broken = (F.trim(body) != "") & F.try_parse_json(body).isNull()
    message = F.concat(F.lit("page body is no JSON: "), F.substring(body, 1, 80))
    failed = F.when(broken, F.raise_error(message).cast(listed))
    if not steps:
        found = F.when(_starts_object(body) | _starts_array(body), F.from_json(body, listed))
        found = F.coalesce(found, one_by_one, failed)
    elif not any(many for _, many in steps):
        found = F.coalesce(
            _walk(F.from_json(body, _nest(steps, listed)), steps, listed), one_by_one, failed
        )
    else:

        def choose(parsed: Column) -> Column:
            typed = _walk(parsed, steps, listed)
            # Only a page with a gap can have lost records to a failed inner parse.
            better = F.coalesce(F.size(raw) > F.coalesce(F.size(typed), F.lit(0)), F.lit(False))
            rescued = F.when(better, one_by_one).otherwise(F.coalesce(typed, failed))
            return F.when(_has_gap(parsed, steps), rescued).otherwise(typed)

        # As a lambda, so that the body is parsed once and not once per use.
        parsed = F.from_json(body, _nest(steps, listed))
        found = F.get(F.transform(F.array(parsed), choose), 0)
    return F.filter(found, lambda x: x.isNotNull())


def record_texts(body: Column, selector: str) -> Column:
    """Array of the records an envelope holds, each as JSON text."""
    texts = T.ArrayType(T.StringType())
    steps = _selector_steps(selector)
    if not steps:
        return F.when(is_json_object(body), F.array(body)).otherwise(F.from_json(body, texts))
    return _walk(F.from_json(body, _nest(steps, texts)), steps, texts)


def _starts_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


def _starts_array(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def is_json_object(text: Column) -> Column:
    """True for text that is a JSON object."""
    return F.coalesce(_starts_object(text) & F.json_object_keys(text).isNotNull(), F.lit(False))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
