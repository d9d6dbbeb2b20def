"""Reading JSON whose levels come in changing shapes, with VARIANT inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """The text as VARIANT; null where it is null or no complete JSON document (as when it was cut off).

    A document that repeats a member name within one object is taken for no JSON."""
    return unwrap(F.try_parse_json(text))


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_object(v: Column) -> Column:
    """Whether ``v`` is a JSON object; false for null."""
    return _members(v).isNotNull()


def unwrap(v: Column) -> Column:
    """``v``, or what its text says where it is a string that holds a JSON object or array."""
    text = F.try_variant_get(v, "$", "string")
    quoted = _list(v).isNull() & _members(v).isNull() & text.rlike(r"^\s*[\[{]")
    return F.when(quoted, F.coalesce(F.try_parse_json(text), v)).otherwise(v)


def items(v: Column) -> Column:
    """The elements of a JSON array as array<variant>; one object in the place of the array is its only
    element; text that holds JSON counts as that JSON; anything else, null included, has no elements.
    Elements that are null, or no objects, keep their positions."""
    u = unwrap(v)
    listed = F.transform(_list(u), unwrap)
    single = F.when(is_object(u), F.array(u))
    return F.coalesce(listed, single, F.array().cast("array<variant>"))


def member(v: Column, name: str) -> Column:
    """The member ``name`` of a JSON object as VARIANT; null where ``v`` is no object or lacks it."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def text(v: Column, name: str) -> Column:
    """The member ``name`` as text; null where missing or null."""
    return F.try_variant_get(v, f"$.{name}", "string")


def canonical(v: Column, *without: str) -> Column:
    """A JSON object as text with members in the order of their names, leaving out the members ``without``."""
    kept = _members(v)
    if without:
        kept = F.map_filter(kept, lambda k, _: ~k.isin(*without))
    return F.to_json(kept)
