"""Canonical JSON text and content digests as columns.

Form: keys sorted, no spaces, ASCII only, nulls kept, instants as UTC ISO-8601 with
six fraction digits only when they are not all zero, negative zero written as 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code unit -> short escape; \u005c comes last so that no escape is escaped again.
_SHORT_ESCAPES = {
    "\\u0008": "\\b",
    "\\u0009": "\\t",
    "\\u000a": "\\n",
    "\\u000c": "\\f",
    "\\u000d": "\\r",
    "\\u0022": '\\"',
    "\\u005c": "\\\\",
}
_PLAIN = r"[ !#-\[\]-~]"
_RUNS = r"[ !#-\[\]-~]+|[^ !#-\[\]-~]+"


def _escape_run(run: Column) -> Column:
    """Escape a run of characters: its UTF-16 code units are the escapes, in order."""
    units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
    out = F.regexp_replace(units, "(.{4})", r"\\u$1")
    for unit, short in _SHORT_ESCAPES.items():
        out = F.replace(out, F.lit(unit), F.lit(short))
    return out


def json_string(col: Column) -> Column:
    """Quoted text; only runs of characters that need an escape are rewritten."""
    runs = F.regexp_extract_all(col, F.lit(_RUNS), F.lit(0))
    escaped = F.array_join(
        F.transform(runs, lambda r: F.when(r.rlike("^" + _PLAIN), r).otherwise(_escape_run(r))), ""
    )
    needs_escape = col.rlike(r"[^ !#-\[\]-~]")
    return F.concat(F.lit('"'), F.when(needs_escape, escaped).otherwise(col), F.lit('"'))


def json_instant(col: Column) -> Column:
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(col), F.lit(1_000_000))
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(F.lit('"'), whole, F.coalesce(fraction, F.lit("")), F.lit('+00:00"'))


def json_double(col: Column) -> Column:
    """Shortest positional form between 1e-4 and 1e16, exponent form outside."""
    value = F.when(col == 0, F.lit(0.0)).otherwise(col)
    text = value.cast("string")
    sign = F.when(value < 0, "-").otherwise("")
    mantissa = F.regexp_extract(text, r"^-?(\d+)\.(\d+)(?:E(-?\d+))?$", 1)
    fraction = F.regexp_replace(F.regexp_extract(text, r"^-?(\d+)\.(\d+)", 2), r"^0$", "")
    exponent = F.coalesce(
        F.nullif(F.regexp_extract(text, r"E(-?\d+)$", 1), F.lit("")).try_cast("int"), F.lit(0)
    )
    digits = F.concat(mantissa, fraction)
    point = F.length(mantissa) + exponent
    small = F.concat(
        F.lit("0."), F.repeat(F.lit("0"), F.greatest(F.lit(0), -point)), digits
    )
    large = F.concat(F.rpad(digits, F.greatest(point, F.length(digits)), "0"), F.lit(".0"))
    middle = F.concat_ws(
        ".", digits.substr(F.lit(1), point), digits.substr(point + 1, F.length(digits))
    )
    positional = (
        F.when(point <= 0, small).when(point >= F.length(digits), large).otherwise(middle)
    )
    shift = point - 1
    head = F.when(
        F.length(digits) > 1,
        F.concat_ws(".", digits.substr(1, 1), digits.substr(F.lit(2), F.length(digits))),
    ).otherwise(digits)
    scientific = F.concat(
        head,
        F.when(shift < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(shift).cast("string"), 2, "0"),
    )
    plain = F.concat(
        sign,
        F.when((F.abs(value) >= 1e-4) & (F.abs(value) < 1e16), positional).otherwise(scientific),
    )
    return F.when(exponent == 0, text).otherwise(plain)


def canonical_json(col: Column, dtype: T.DataType, plain: frozenset[str] = frozenset()) -> Column:
    """Canonical JSON text of ``col``; the shape is fixed by ``dtype`` at plan time.

    ``plain`` names text fields whose domain rules out escapes (hex digests, enumerations):
    they are quoted as they are instead of being searched for characters to escape.
    """
    if isinstance(dtype, T.StructType):
        parts: list[Column] = []
        for i, field in enumerate(sorted(dtype.fields, key=lambda f: f.name)):
            lead = ("," if i else "{") + f'"{field.name}":'
            value = col.getField(field.name)
            parts += [F.lit(lead), _field_json(value, field.dataType, field.name in plain, plain)]
        body = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda item: canonical_json(item, dtype.elementType, plain))
        body = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(dtype, T.StringType):
        body = json_string(col)
    elif isinstance(dtype, T.TimestampType):
        body = json_instant(col)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        body = json_double(col.cast("double"))
    elif isinstance(dtype, (T.BooleanType, T.IntegralType)):
        body = col.cast("string")
    else:
        raise TypeError(f"no canonical JSON form for {dtype.simpleString()}")
    return F.when(col.isNull(), F.lit("null")).otherwise(body)


def _field_json(value: Column, dtype: T.DataType, is_plain: bool, plain: frozenset[str]) -> Column:
    quote = F.lit('"')
    if is_plain and isinstance(dtype, T.StringType):
        return F.coalesce(F.concat(quote, value, quote), F.lit("null"))
    if is_plain and isinstance(dtype, T.ArrayType):
        listed = F.concat(F.lit('["'), F.array_join(value, '","'), F.lit('"]'))
        return F.when(value.isNull(), "null").when(F.size(value) == 0, "[]").otherwise(listed)
    return canonical_json(value, dtype, plain)


def content_digest(col: Column, dtype: T.DataType, plain: frozenset[str] = frozenset()) -> Column:
    return F.sha2(canonical_json(col, dtype, plain), 256)


def row_digest(schema: T.StructType, plain: frozenset[str] = frozenset()) -> Column:
    """Digest over every column of a row with ``schema``."""
    return content_digest(F.struct(*[F.col(f.name) for f in schema.fields]), schema, plain)


_DIGEST_BYTES = 32
_OTHER = b"\0" * (_DIGEST_BYTES + 1)


def packed_digest(name: str) -> Column:
    """A lower-case SHA-256 hex digest as its 32 bytes; any other text keeps all of its bytes, behind 33 zeros."""
    text = F.col(name)
    number = F.unhex(text)
    is_digest = (F.octet_length(text) == 2 * _DIGEST_BYTES) & number.isNotNull() & (F.lower(text) == text)
    other = F.concat(F.lit(_OTHER), text.cast("binary"))
    return F.when(F.coalesce(is_digest, F.lit(False)), number).otherwise(other)


def unpacked_digest(packed: str | Column) -> Column:
    """The text that ``packed_digest`` was given."""
    data = F.col(packed) if isinstance(packed, str) else packed
    other = F.substring(data, len(_OTHER) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(data) == _DIGEST_BYTES, F.lower(F.hex(data))).otherwise(other)
