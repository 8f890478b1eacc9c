"""Rule tables: every broken rule of every row, as data instead of exceptions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import is_blank, is_non_finite


@dataclass(frozen=True)
class Rule:
    """``violated`` is true for a row that breaks the rule; null counts as kept."""

    code: str
    field: str
    violated: Column



def required(*fields: str) -> list[Rule]:
    return [Rule("INVALID_TYPE", f, F.col(f).isNull()) for f in fields]


def not_blank(*fields: str) -> list[Rule]:
    return [Rule("EMPTY_VALUE", f, is_blank(F.col(f))) for f in fields]


def in_domain(field: str, values: Iterable[str]) -> list[Rule]:
    return [Rule("UNKNOWN_ENUM_VALUE", field, ~F.col(field).isin(*values))]


def finite(*fields: str) -> list[Rule]:
    return [Rule("NON_FINITE_NUMBER", f, is_non_finite(F.col(f))) for f in fields]


def probability(*fields: str) -> list[Rule]:
    out = finite(*fields)
    for f in fields:
        c = F.col(f)
        out.append(
            Rule("PROBABILITY_OUT_OF_BOUNDS", f, ~is_non_finite(c) & ((c < 0.0) | (c > 1.0)))
        )
    return out


def identifier(*fields: str) -> list[Rule]:
    return [Rule("INVALID_IDENTIFIER", f, ~F.col(f).rlike(r"\A[A-Z][A-Z0-9_]*\z")) for f in fields]


def digest(*fields: str) -> list[Rule]:
    return [Rule("INVALID_DIGEST", f, ~F.col(f).rlike(r"\A[0-9a-f]{64}\z")) for f in fields]


def unique_items(field: str, items: Column | None = None) -> list[Rule]:
    items = F.col(field) if items is None else items
    return [Rule("DUPLICATE_VALUE", field, F.size(F.array_distinct(items)) < F.size(items))]


def array_rule(code: str, field: str, broken) -> Rule:
    """Some item of the array breaks the rule."""
    return Rule(code, field, F.exists(F.col(field), lambda item: F.coalesce(broken(item), F.lit(False))))


def _hits(rules: Sequence[Rule]) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(
                    r.violated, F.struct(F.lit(r.code).alias("code"), F.lit(r.field).alias("field"))
                )
                for r in rules
            ]
        )
    )


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``: array<struct<code, field>> in rule order, empty for a good row."""
    return df.withColumn("violations", _hits(rules))


def violation_rows(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One row per broken rule, with the ``keep`` columns of its source row.

    The array is generated from its expression, not from a named column: a named column
    would make Spark add a filter on the whole rule table and evaluate it twice.
    """
    return df.select(*keep, F.inline(_hits(rules)))


def fail_on(violations: DataFrame, codes: Iterable[str] | None = None) -> None:
    """Optional action: raise with one example if any (listed) violation exists."""
    wanted = violations if codes is None else violations.filter(F.col("code").isin(*codes))
    example = wanted.first()
    if example is not None:
        raise ValueError(f"{example['code']}: {example.asDict()}")
