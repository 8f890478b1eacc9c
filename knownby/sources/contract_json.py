"""Strict JSON records: key sets and types are judged level by level before parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knownby.functions.canonical import canonical_json
from knownby.functions.timeops import text_instant_violation

_SCALAR_KINDS = {
    T.StringType: ("STRING",),
    T.BooleanType: ("BOOLEAN",),
    T.LongType: ("BIGINT",),
    T.IntegerType: ("BIGINT",),
    T.DoubleType: ("DECIMAL", "DOUBLE", "FLOAT"),
}


def _hit(condition: Column, code: str, field: str | Column) -> Column:
    where = F.lit(field) if isinstance(field, str) else field
    return F.when(
        F.coalesce(condition, F.lit(False)), F.struct(F.lit(code).alias("code"), where.alias("field"))
    )


def _kind(variant: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(variant), r"^[A-Z]+", 0)


_MAP = "map<string,variant>"


class _Stages:
    """Columns added to a table one after the other, so that each is computed once for all that is asked of it."""

    def __init__(self, df: DataFrame) -> None:
        self.df, self.added = df, 0

    def names(self, columns: list[Column]) -> list[Column]:
        names = [f"_stage_{self.added + i}" for i in range(len(columns))]
        self.added += len(columns)
        self.df = self.df.withColumns(dict(zip(names, columns)))
        return [F.col(n) for n in names]


def _object_checks(node: Column, schema: T.StructType, path: str) -> list[Column]:
    """Arrays of violations for one JSON object against one struct type."""
    there = F.coalesce(_kind(node) == "OBJECT", F.lit(False))
    keys = F.when(there, F.map_keys(node.try_cast(_MAP)))
    out = _key_checks(keys, schema, path)
    for field in schema.fields:
        value = F.try_variant_get(node, f"$.{field.name}", "variant")
        present = there & F.array_contains(keys, field.name)
        out += _value_checks(value, present, field.dataType, field.nullable, path + field.name)
    return out


def _key_checks(keys: Column, schema: T.StructType, path: str) -> list[Column]:
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    as_hit = lambda code: lambda key: F.struct(
        F.lit(code).alias("code"), F.concat(F.lit(path), key).alias("field")
    )
    return [
        F.transform(F.sort_array(F.array_except(keys, names)), as_hit("UNKNOWN_FIELD")),
        F.transform(F.sort_array(F.array_except(names, keys)), as_hit("MISSING_FIELD")),
    ]


def _staged_checks(stages: _Stages, fields: Column, schema: T.StructType, path: str) -> list[Column]:
    """``_object_checks`` of an object cast to ``_MAP`` (null: no object), level by level, in columns of ``stages``."""
    keys, = stages.names([F.map_keys(fields)])
    values = stages.names([fields[f.name] for f in schema.fields])
    presents = stages.names([F.coalesce(F.array_contains(keys, f.name), F.lit(False)) for f in schema.fields])
    kinds = stages.names([F.coalesce(_kind(v), F.lit("VOID")) for v in values])
    out = _key_checks(keys, schema, path)
    for field, value, present, kind in zip(schema.fields, values, presents, kinds):
        below = path + field.name
        if isinstance(field.dataType, T.StructType):
            wrong = (F.lit(not field.nullable) | (kind != "VOID")) & (kind != "OBJECT")
            nested, = stages.names([F.when(present, value.try_cast(_MAP))])
            out += [F.array(_hit(present & wrong, "INVALID_TYPE", below))]
            out += _staged_checks(stages, nested, field.dataType, below + ".")
        else:
            out += _value_checks(value, present, field.dataType, field.nullable, below, kind, stages)
    return out


def _value_checks(
    value: Column, present: Column, dtype: T.DataType, nullable: bool, path: str,
    kind: Column | None = None, stages: _Stages | None = None,
) -> list[Column]:
    kind = F.coalesce(_kind(value), F.lit("VOID")) if kind is None else kind
    absent = kind == "VOID"
    wrong_null = F.lit(not nullable) & absent
    if isinstance(dtype, T.StructType):
        own = _hit(present & (wrong_null | (~absent & (kind != "OBJECT"))), "INVALID_TYPE", path)
        return [F.array(own), *_object_checks(F.when(present, value), dtype, path + ".")]
    if isinstance(dtype, T.ArrayType):
        own = _hit(present & (wrong_null | (~absent & (kind != "ARRAY"))), "INVALID_TYPE", path)
        listed = F.when(present & (kind == "ARRAY"), value.try_cast("array<variant>"))
        nested = F.transform(
            listed,
            lambda item: F.array_compact(
                F.flatten(F.array(*_item_checks(item, dtype.elementType, path + "[]")))
            ),
        )
        return [F.array(own), F.flatten(nested)]
    if isinstance(dtype, T.TimestampType):
        text = F.when(kind == "STRING", value.try_cast("string"))
        stamp = text_instant_violation(text)
        if stages is not None:
            text, = stages.names([text])
            stamp, = stages.names([text_instant_violation(text)])
        return [
            F.array(
                _hit(present & (wrong_null | (~absent & (kind != "STRING"))), "INVALID_TYPE", path),
                _hit(present & (stamp == "NAIVE_DATETIME"), "NAIVE_DATETIME", path),
                _hit(present & (stamp == "INVALID_TIMESTAMP"), "INVALID_TIMESTAMP", path),
            )
        ]
    allowed = _SCALAR_KINDS[type(dtype)]
    return [F.array(_hit(present & (wrong_null | (~absent & ~kind.isin(*allowed))), "INVALID_TYPE", path))]


def _item_checks(item: Column, dtype: T.DataType, path: str) -> list[Column]:
    if isinstance(dtype, T.StructType):
        own = _hit(~F.coalesce(_kind(item) == "OBJECT", F.lit(False)), "INVALID_TYPE", path)
        return [F.array(own), *_object_checks(item, dtype, path + ".")]
    return _value_checks(item, F.lit(True), dtype, False, path)


def strict_records(texts: DataFrame, text: str, schema: T.StructType, keep: list[str]) -> DataFrame:
    """JSON text -> (keep..., record, violations). ``record`` is null unless it is clean.

    ``schema`` marks required fields as NOT NULL. Domain values are left to the rule table
    of the record type.
    """
    doc = texts.select(*keep, F.col(text).alias("_text"), F.try_parse_json(F.col(text)).alias("_doc"))
    stages = _Stages(doc)
    fields, = stages.names([F.col("_doc").try_cast(_MAP)])
    root = _hit(fields.isNull(), "INVALID_TYPE", "$")
    parts = [F.array(root), *_staged_checks(stages, fields, schema, "")]
    empty = F.array().cast("array<struct<code:string,field:string>>")
    found = F.array_compact(F.flatten(F.array(*[F.coalesce(p, empty) for p in parts])))
    return stages.df.withColumn("violations", found).select(
        *keep,
        F.when(F.size("violations") == 0, F.from_json("_text", schema)).alias("record"),
        "violations",
    )


def canonical_lines(records: DataFrame, record: str, schema: T.StructType) -> DataFrame:
    """Records -> one canonical JSON line each (column ``value``), ready for ``write.text``."""
    return records.select(canonical_json(F.col(record), schema).alias("value"))
