"""Text columns: blank tests, defaults, JSON getters on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Space and all control characters below it count as blank at the ends of a text.
BLANKS = "".join(map(chr, range(33)))


def squeeze(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column, strict: bool = False) -> Column:
    """Null or empty; the lenient form also treats whitespace as blank."""
    return c.isNull() | ((c if strict else squeeze(c)) == "")


def normalize(c: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(squeeze(c), F.lit("")), F.lit(fallback))


def first_non_blank(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(squeeze(c), F.lit("")) for c in cols])


def _member(v: Column, field: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$.{field}", kind)


def v_text(v: Column, field: str) -> Column:
    """Scalar member as text; absent or null is null; containers are blank."""
    text = _member(v, field, "string")
    maybe_container = text.startswith("{") | text.startswith("[")
    kind = _kind(v, field)
    container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(maybe_container, F.when(container, F.lit("")).otherwise(text)).otherwise(text)


def _kind(v: Column, field: str) -> Column:
    return F.schema_of_variant(_member(v, field, "variant"))


def _is_number(v: Column, field: str) -> Column:
    kind = _kind(v, field)
    return (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def v_long(v: Column, field: str, lenient: bool = False) -> Column:
    """JSON number as long, fraction cut; lenient also takes whole-text integers."""
    number = F.when(_is_number(v, field), _member(v, field, "bigint"))
    if not lenient:
        return number
    text = _member(v, field, "string")
    is_text = _kind(v, field) == "STRING"
    return F.coalesce(
        number, F.when(is_text & text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    )


def v_double(v: Column, field: str) -> Column:
    return F.when(_is_number(v, field), _member(v, field, "double"))
