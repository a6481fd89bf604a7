"""Nested rows: hoisting, flattening and child tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions import values as V
from pagelake.functions.jsonpath import WRITE_OPTIONS, is_json_object, to_json_text
from pagelake.functions.text import snake_case


def promote_nested_key(df: DataFrame, column: str, key: str) -> DataFrame:
    """Hoist ``column.key`` to ``key``. A column that is no object leaves ``key`` alone."""
    kind = df.schema[column].dataType
    old = F.col(key) if key in df.columns else F.lit(None).cast("string")
    if isinstance(kind, T.StructType):
        return df.withColumn(key, F.when(F.col(column).isNotNull(), F.col(column)[key]))
    text = F.col(column)
    return df.withColumn(
        key,
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(is_json_object(text), F.get_json_object(text, f"$.{key}"))
        .otherwise(old),
    )


def promote_active(df: DataFrame, attributes: Sequence[str], column: str = "values") -> DataFrame:
    """Current scalar of each attribute in the JSON object ``column`` as its own column.

    The value a row already has under that name wins.
    """
    # A step of its own: Spark parses the object once, not once per attribute.
    parsed = df.withColumn("_entries", F.from_json(F.col(column), "map<string,string>"))
    found = {a: V.active_value(F.try_element_at("_entries", F.lit(a))) for a in attributes}
    return parsed.withColumns(
        {a: F.coalesce(F.col(a), v) if a in df.columns else v for a, v in found.items()}
    ).drop("_entries")


def promote_found(df: DataFrame, known: Sequence[str] = (), column: str = "values") -> DataFrame:
    """:func:`promote_active` for the known attributes and any other the rows hold.

    The attribute names come back from a distributed distinct over the object keys.
    """
    names = df.select(F.explode(F.json_object_keys(column)).alias("n")).distinct()
    found = sorted(r["n"] for r in names.collect())
    extra = [n for n in found if n not in known and snake_case(n) not in known]
    return promote_active(df, [*known, *extra], column)


def hoist_if_null(df: DataFrame, column: str, path: str) -> DataFrame:
    """Fill ``column`` from a nested path where it is null."""
    old = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(old, F.col(path)))


def replace_nested(df: DataFrame, path: str, change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to the field at a dotted path; its siblings stay."""
    top, _, rest = path.partition(".")
    if not rest:
        return df.withColumn(top, change(F.col(top)))
    return df.withColumn(top, F.col(top).withField(rest, change(F.col(path))))


def epoch_column(df: DataFrame, column: str) -> DataFrame:
    """A numeric epoch column as timestamps."""
    return df.withColumn(column, V.epoch_to_ts(F.col(column)))


def iso_column(df: DataFrame, path: str) -> DataFrame:
    """An ISO text column, or nested field, as timestamps."""
    return replace_nested(df, path, V.iso_to_ts)


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Constant (or computed) columns, replacing any of the same name."""
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()}
    )


def alias_column(df: DataFrame, column: str, name: str) -> DataFrame:
    """A second name for a column."""
    return df.withColumn(name, F.col(column))


def json_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Arrays as JSON text, a missing one as ``[]``."""
    return df.withColumns({n: to_json_text(F.col(n)) for n in names})


def first_values(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """First entry's value of each array column: ``{"email": "email_primary"}``."""
    return df.withColumns({new: V.first_value(F.col(old)) for old, new in names.items()})


def refs_to_ids(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """References as plain ids."""
    return df.withColumns({n: V.ref_to_id(F.col(n)) for n in names})


# Association lists of an engagement and the columns they become.
ASSOCIATIONS = {
    "contactIds": "associations__contact_ids",
    "companyIds": "associations__company_ids",
    "dealIds": "associations__deal_ids",
}


def flatten_engagement(df: DataFrame) -> DataFrame:
    """Fields of ``engagement`` at the top plus the association lists as JSON text."""
    keep = [c for c in df.columns if c.startswith("_")]
    lists = [to_json_text(F.col(f"associations.{k}")).alias(v) for k, v in ASSOCIATIONS.items()]
    return df.select(*keep, "engagement.*", *lists)


def project_properties(df: DataFrame, names: Sequence[str], column: str = "properties") -> DataFrame:
    """The listed properties as ``properties__<name>`` text columns in place of the struct."""
    have = {f.name for f in df.schema[column].dataType.fields}
    picked = {
        f"{column}__{n}": (F.col(f"{column}.{n}") if n in have else F.lit(None)).cast("string")
        for n in names
    }
    return df.withColumns(picked).drop(column)


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The requested fields; dotted ones keep their last name."""
    return df.select(*[F.col(f).alias(f.split(".")[-1]) for f in fields])


def flatten_structs(df: DataFrame, sep: str = "__") -> DataFrame:
    """Structs as columns ``a__b``, all names in snake case.

    Columns starting with ``_`` are left alone. Two fields that end up with one name
    are an error.
    """
    out: dict[str, Column] = {}

    def add(name: str, value: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                add(f"{name}{sep}{snake_case(field.name)}", value[field.name], field.dataType)
            return
        if name in out:
            raise ValueError(f"two fields become column {name}")
        out[name] = value

    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name.startswith("_"):
            out[field.name] = value
        else:
            name = field.name if sep in field.name else snake_case(field.name)
            add(name, value, field.dataType)
    return df.select(*[value.alias(name) for name, value in out.items()])


def array_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold arrays of structs."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    ]


def child_table(
    df: DataFrame,
    array_column: str,
    parent_key: Sequence[str] = ("id",),
    *,
    inline_arrays: bool = True,
    sep: str = "__",
) -> DataFrame:
    """One row per element of an array of structs.

    Columns: the parent key as ``parent_<key>``, the index ``list_idx``, and the
    element's fields flattened. With ``inline_arrays`` arrays inside the element stay
    in it as JSON text (nesting stops here); otherwise they stay arrays.
    """
    keys = [F.col(k).alias(f"parent_{k}") for k in parent_key]
    rows = df.select(*keys, F.posexplode(array_column).alias("list_idx", "_element"))
    kept = [f"parent_{k}" for k in parent_key] + ["list_idx"]
    flat = flatten_structs(rows.select(*kept, "_element.*"), sep)
    return arrays_to_json(flat) if inline_arrays else flat


def arrays_to_json(df: DataFrame) -> DataFrame:
    """Array and map columns as JSON text."""
    nested = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ArrayType, T.MapType)) and not f.name.startswith("_")
    ]
    return df.withColumns({n: F.to_json(F.col(n), WRITE_OPTIONS) for n in nested})


def child_tables(
    df: DataFrame, parent_key: Sequence[str] = ("id",), *, max_nesting: int | None = None
) -> dict[str, DataFrame]:
    """Every child table of a flattened table, by name ``array__inner``.

    ``max_nesting`` limits the depth; arrays below it stay as JSON text.
    """
    out: dict[str, DataFrame] = {}

    def visit(rows: DataFrame, prefix: str, keys: Sequence[str], depth: int) -> None:
        for name in array_columns(rows):
            last = max_nesting is not None and depth >= max_nesting
            child = child_table(rows, name, keys, inline_arrays=last)
            table = f"{prefix}{name}"
            inner_keys = [*[f"parent_{k}" for k in keys], "list_idx"]
            if not last:
                visit(child, f"{table}__", inner_keys, depth + 1)
                child = child.drop(*array_columns(child))
            out[table] = child

    visit(df, "", parent_key, 1)
    return out
