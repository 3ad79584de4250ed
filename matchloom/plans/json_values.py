"""JSON values of any depth: set and append along a path, and containment, as a database with a JSON type has them; built on variants, so no schema is needed.

Values are variants; json_value makes one of any column, json_text gives text with the keys in order. Null stands for no value, a JSON null is a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT, ARRAY = "map<string,variant>", "array<variant>"


def json_value(c: Column) -> Column:
    """A column of any type as a JSON value; null becomes a JSON null."""
    return F.variant_get(F.parse_json(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})), "$.v", "variant")


def json_text(value: Column) -> Column:
    return F.to_json(value)


def parsed(text: Column) -> Column:
    """JSON text as a value; null without one, an error for text that isn't JSON."""
    return F.parse_json(text)


def at_path(value: Column, path: list[str]) -> Column:
    """The value at a path of keys, null where a key is missing or what holds it is no object."""
    for key in path:
        value = F.element_at(F.try_variant_get(value, "$", OBJECT), key)
    return value


def set_path(value: Column, path: list[str], new: Column) -> Column:
    """The value with `new` at a path of keys. The last key is added where it is missing; where an earlier one is, or is no object, nothing changes."""
    held = F.try_variant_get(value, "$", OBJECT)
    own = F.element_at(held, path[0])
    inner = new if len(path) == 1 else set_path(own, path[1:], new)
    put = F.to_variant_object(F.map_concat(F.map_filter(held, lambda k, v: k != path[0]), F.create_map(F.lit(path[0]), inner)))
    there = held.isNotNull() if len(path) == 1 else held.isNotNull() & F.try_variant_get(own, "$", OBJECT).isNotNull()
    return F.when(there, put).otherwise(value)


def append_path(value: Column, path: list[str], item: Column) -> Column:
    """The value with an item added to the list at a path; a missing list is started, a null value is an empty object, what is there and no list becomes its first element."""
    value = F.coalesce(value, F.parse_json(F.lit("{}")))
    held = at_path(value, path)
    listed = F.coalesce(F.try_variant_get(held, "$", ARRAY), F.when(held.isNotNull(), F.array(held)), F.array().cast(ARRAY))
    return set_path(value, path, F.to_variant_object(F.concat(listed, F.array(item))))


def without_nulls(value: Column, keys: list[str]) -> Column:
    """The object without those of the keys whose value is a JSON null."""
    held = F.try_variant_get(value, "$", OBJECT)
    return F.when(held.isNull(), value).otherwise(F.to_variant_object(F.map_filter(held, lambda k, v: ~(k.isin(*keys) & F.is_variant_null(v)))))


def contains(value: Column, part: object, top: bool = True) -> Column:
    """Whether a value holds a part, given as Python's dict, list, str, int, float, bool or None: an object all its keys with values that hold theirs, a list for each
    element one that holds it, in any order, a scalar the same scalar. At the top a list holds a scalar that is one of its elements. False for null."""
    if isinstance(part, dict):
        held = F.try_variant_get(value, "$", OBJECT)
        out = held.isNotNull()
        for k, v in part.items():
            out = out & F.coalesce(contains(F.element_at(held, k), v, False), F.lit(False))
    elif isinstance(part, list):
        held = F.try_variant_get(value, "$", ARRAY)
        out = held.isNotNull()
        for v in part:
            out = out & F.exists(held, _holds(v))
    else:
        out = _same(value, part)
        if top:
            out = out | F.coalesce(F.exists(F.try_variant_get(value, "$", ARRAY), lambda x: _same(x, part)), F.lit(False))
    return F.coalesce(out, F.lit(False))


def _holds(part: object):
    return lambda x: contains(x, part, False)


def _same(value: Column, part: object) -> Column:
    if part is None:
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    kind = F.schema_of_variant(value)
    if isinstance(part, bool):
        return F.coalesce((kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == F.lit(part)), F.lit(False))
    if isinstance(part, str):
        return F.coalesce((kind == "STRING") & (F.try_variant_get(value, "$", "string") == F.lit(part)), F.lit(False))
    return F.coalesce(kind.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (F.try_variant_get(value, "$", "double") == F.lit(float(part))), F.lit(False))
