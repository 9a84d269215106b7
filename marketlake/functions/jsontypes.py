"""Strict JSON typing on VARIANT values.

Spark's variant getters coerce (``"150"`` becomes 150.0, a float becomes an
integer), while the reference's deserializer rejects a value of the wrong JSON
type. These predicates check the wire type first, with ``schema_of_variant``:
``BIGINT`` / ``DECIMAL(p,s)`` / ``DOUBLE`` for numbers, ``STRING``, ``BOOLEAN``,
``VOID`` for JSON null, ``ARRAY<...>``, ``OBJECT<...>``; SQL NULL means the key
is missing. Every predicate returns a non-null BOOLEAN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_63 = 9223372036854775808
_U64_MAX = 18446744073709551615


def path(key: str) -> str:
    return "$." + key if key.replace("_", "").isalnum() else "$['" + key + "']"


def get(v: Column, key: str, type_: str) -> Column:
    """Typed value of ``v.key`` (coercing; check the type first)."""
    return F.try_variant_get(v, path(key), type_)


def jtype(v: Column, key: str) -> Column:
    """Wire type of ``v.key``: NULL when missing, 'VOID' for JSON null."""
    return F.schema_of_variant(F.try_variant_get(v, path(key), "variant"))


# Each predicate evaluates the wire type once (one look-up among names): inside a
# ``forall`` lambda expressions are interpreted, so a repeated subtree would be
# computed again, and a pattern would be matched for every field of every element.
_NUMBER = ("BIGINT", "DOUBLE", "DECIMAL")


def _type_is(v: Column, key: str, names: tuple[str, ...], missing_ok: bool, null_ok: bool, head: bool = False) -> Column:
    """Whether the wire type is one of ``names`` (``head``: up to its first parenthesis)."""
    t = F.coalesce(jtype(v, key), F.lit("MISSING" if missing_ok else "-"))
    if head:
        t = F.substring_index(t, "(", 1)
    return t.isin(*names, *(["VOID"] if null_ok else []), *(["MISSING"] if missing_ok else []))


def is_string(v: Column, key: str, missing_ok: bool = False, null_ok: bool = False) -> Column:
    return _type_is(v, key, ("STRING",), missing_ok, null_ok)


def is_bool(v: Column, key: str, missing_ok: bool = False, null_ok: bool = False) -> Column:
    return _type_is(v, key, ("BOOLEAN",), missing_ok, null_ok)


def is_f64(v: Column, key: str, missing_ok: bool = False, null_ok: bool = False) -> Column:
    """Any JSON number that fits a double (integers included; 1e400 is not)."""
    finite = F.coalesce(F.abs(get(v, key, "double")) != F.lit(float("inf")), F.lit(True))
    return _type_is(v, key, _NUMBER, missing_ok, null_ok, head=True) & finite


def is_int_in(v: Column, key: str, lo: int, hi: int, missing_ok: bool = False, null_ok: bool = False) -> Column:
    """An integer token in [lo, hi] (a float token such as 1.0 is not)."""
    in_range = F.coalesce(get(v, key, "bigint").between(lo, hi), F.lit(True))
    return _type_is(v, key, ("BIGINT",), missing_ok, null_ok) & in_range


def is_u64(v: Column, key: str, missing_ok: bool = False, null_ok: bool = False) -> Column:
    """A non-negative integer token up to 2^64-1: BIGINT >= 0, or a 19/20-digit
    decimal in 2^63..2^64-1. Below 2^63 an integer token is a BIGINT, so a decimal
    there was written as a float."""
    t = F.coalesce(jtype(v, key), F.lit("MISSING" if missing_ok else "-"))
    d = get(v, key, "decimal(20,0)")
    whole = F.lit(str(_TWO_63)).cast("decimal(20,0)"), F.lit(str(_U64_MAX)).cast("decimal(20,0)")
    ok = F.when(t == "BIGINT", d >= 0).when(t.isin("DECIMAL(19,0)", "DECIMAL(20,0)"), d.between(*whole))
    return F.coalesce(ok.when(t == "VOID", F.lit(null_ok)).when(t == "MISSING", F.lit(missing_ok)), F.lit(False))


def is_string_list(v: Column, key: str, missing_ok: bool = False, null_ok: bool = False) -> Column:
    """A JSON array whose elements are all strings (``[]`` included)."""
    arr = get(v, key, "array<string>")
    no_nulls = F.coalesce(F.size(arr) == F.size(F.array_compact(arr)), F.lit(True))
    return _type_is(v, key, ("ARRAY<STRING>", "ARRAY<VOID>"), missing_ok, null_ok) & no_nulls


def optional(v: Column, key: str, check) -> Column:
    """``Option<T>``: missing or JSON null, or a valid T."""
    return check(v, key, missing_ok=True, null_ok=True)


def defaulted(v: Column, key: str, check) -> Column:
    """A field with a default: missing, or a valid T (JSON null is an error)."""
    return check(v, key, missing_ok=True, null_ok=False)




def string_list(v: Column, key: str, default_empty: bool) -> Column:
    arr = get(v, key, "array<string>")
    return F.coalesce(arr, F.array().cast("array<string>")) if default_empty else arr
