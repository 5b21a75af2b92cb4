"""Nested and JSON columns: messages, documents, maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsight.functions.scalar import col


def decode_message(data: Column | str, schema: T.StructType | str) -> Column:
    """Base64 JSON payload to a struct; a payload that does not parse gives NULL fields."""
    return F.from_json(F.unbase64(col(data)).cast("string"), schema)


def encode_message(*fields: Column | str) -> Column:
    payload = fields[0] if len(fields) == 1 else F.struct(*fields)
    return F.base64(F.to_json(col(payload) if isinstance(payload, str) else payload).cast("binary"))


def json_pick(text: Column | str, keys: Sequence[str]) -> Column:
    """Sub-object with the listed keys in the listed order; ``{}`` for anything unparsable."""
    picked = F.from_json(col(text), T.StructType([T.StructField(k, T.StringType()) for k in keys]))
    return F.coalesce(F.to_json(picked), F.lit("{}"))


def first_target_resource(groups: Column | str) -> Column:
    """First non-empty ``resource`` in ``groups[].operations[]``."""
    resources = F.transform(F.flatten(F.transform(col(groups), lambda g: g["operations"])), lambda o: o["resource"])
    return F.get(F.filter(resources, lambda r: r.isNotNull() & (r != "")), F.lit(0))


def operations_summary(groups: Column | str) -> Column:
    """JSON list of action, path and value of every operation."""
    operations = F.flatten(F.transform(col(groups), lambda g: g["operations"]))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.coalesce(
        F.to_json(
            F.transform(
                operations,
                lambda o: F.struct(
                    blank(o["action"]).alias("action"), blank(o["path"]).alias("path"), blank(o["value"]).alias("value")
                ),
            )
        ),
        F.lit("[]"),
    )


def map_diff(before: Column | str, after: Column | str, undefined: str = "<undefined>") -> Column:
    """Sorted ``key: old -> new`` for every key whose value differs or is on one side only."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    b, a = F.coalesce(col(before), empty), F.coalesce(col(after), empty)
    value = lambda m, k: F.when(
        F.map_contains_key(m, k), F.coalesce(F.try_element_at(m, k), F.lit("None"))
    ).otherwise(F.lit(undefined))
    keys = F.array_sort(F.array_union(F.map_keys(b), F.map_keys(a)))
    changed = F.filter(keys, lambda k: value(b, k) != value(a, k))
    return F.transform(changed, lambda k: F.concat(k, F.lit(": "), value(b, k), F.lit(" -> "), value(a, k)))


def is_missing(df: DataFrame, path: str) -> Column:
    """Absent path, NULL, empty text, empty array or empty map."""
    dtype: T.DataType = df.schema
    for part in path.split("."):
        if isinstance(dtype, T.StructType) and part in dtype.names:
            dtype = dtype[part].dataType
        else:
            return F.lit(True)
    c = F.col(path)
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def missing_paths(df: DataFrame, paths: Sequence[str]) -> Column:
    """Required paths without a value, in the order given."""
    return F.array_compact(F.array(*[F.when(is_missing(df, p), F.lit(p)) for p in paths]))


def flatten_result(
    df: DataFrame,
    text: str,
    scalars: dict[str, str],
    arrays: Sequence[str],
    defaults: dict[str, object],
    suffix: str = "_json",
) -> DataFrame:
    """Typed scalars and JSON lists of a structured result, with defaults for absent fields."""
    fields = [T.StructField(k, T._parse_datatype_string(v)) for k, v in scalars.items()]
    fields += [T.StructField(k, T.ArrayType(T.StringType())) for k in arrays]
    parsed = df.withColumn("_r", F.from_json(F.col(text), T.StructType(fields)))
    out = {}
    for k in scalars:
        c = F.col(f"_r.{k}")
        out[k] = F.coalesce(c, F.lit(defaults[k])) if k in defaults else c
    for k in arrays:
        out[f"{k}{suffix}"] = F.coalesce(F.to_json(F.col(f"_r.{k}")), F.lit("[]"))
    return parsed.withColumns(out).drop("_r")
