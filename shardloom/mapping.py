"""Field mappings: the declared schema of a snapshot.

A mapping is a JSON object with ``properties`` at its root, or the same object under a
single ``_doc`` key.  Snapshots are always strict: a field that is not declared is an error.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import types as T

# Declared type -> type of the stored column.
FIELD_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "keyword": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
}
WHOLE_NUMBERS = ("long", "integer", "short", "byte")
REAL_NUMBERS = ("double", "float")
STRINGS = ("text", "keyword")
WRAPPER = "_doc"

# Parameters of a declaration that decide what fits and what is stored, and those that
# only tell a search server how to index or show a field.
OWN_PARAMETERS = ("type", "properties", "dynamic", "enabled", "format", "ignore_malformed", "coerce", "null_value")
SERVER_PARAMETERS = (
    "analyzer",
    "boost",
    "copy_to",
    "doc_values",
    "eager_global_ordinals",
    "fielddata",
    "fields",
    "ignore_above",
    "index",
    "index_options",
    "index_phrases",
    "index_prefixes",
    "locale",
    "meta",
    "normalizer",
    "norms",
    "position_increment_gap",
    "search_analyzer",
    "search_quote_analyzer",
    "similarity",
    "split_queries_on_whitespace",
    "store",
    "term_vector",
)
# Which types take a parameter.
TAKEN_BY = {
    "enabled": ("object",),
    "format": ("date",),
    "coerce": WHOLE_NUMBERS + REAL_NUMBERS,
    "ignore_malformed": (*WHOLE_NUMBERS, *REAL_NUMBERS, "date", "boolean"),
    "null_value": tuple(name for name in FIELD_TYPES if name != "text"),
}
# The names of date formats, as Spark's datetime patterns.
DATE_FORMATS = {
    "basic_date": "yyyyMMdd",
    "basic_date_time": "yyyyMMdd'T'HHmmss.SSSXXX",
    "basic_date_time_no_millis": "yyyyMMdd'T'HHmmssXXX",
    "date": "yyyy-MM-dd",
    "date_hour": "yyyy-MM-dd'T'HH",
    "date_hour_minute": "yyyy-MM-dd'T'HH:mm",
    "date_hour_minute_second": "yyyy-MM-dd'T'HH:mm:ss",
    "date_hour_minute_second_millis": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "date_time": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "date_time_no_millis": "yyyy-MM-dd'T'HH:mm:ssXXX",
    "year": "yyyy",
    "year_month": "yyyy-MM",
    "year_month_day": "yyyy-MM-dd",
}
ISO_FORMATS = ("date_optional_time", "strict_date_optional_time", "strict_date_optional_time_nanos")
DEFAULT_FORMAT = "strict_date_optional_time||epoch_millis"


def mapping_from_dict(mapping: Mapping[str, Any] | str | None) -> dict[str, Any]:
    """The mapping as a new dict, from a dict or from JSON text."""
    if mapping is None or mapping == "":
        raise ValueError(
            "mapping missing: pass one that declares every field of the documents"
        )
    if isinstance(mapping, str):
        try:
            mapping = json.loads(mapping)
        except json.JSONDecodeError as error:
            raise ValueError(f"mapping is not valid JSON: {error}") from error
    if not isinstance(mapping, Mapping):
        raise ValueError("mapping must be a JSON object")
    return copy.deepcopy(dict(mapping))


def mapping_body(mapping: Mapping[str, Any]) -> dict[str, Any]:
    """The object that holds ``properties``: the mapping itself or what ``_doc`` wraps."""
    if list(mapping) == [WRAPPER]:
        body = mapping[WRAPPER]
        if not isinstance(body, dict):
            raise ValueError(f"mapping: {WRAPPER} must be a JSON object")
        return body
    return mapping  # type: ignore[return-value]


def normalize_mapping(mapping: Mapping[str, Any] | str | None) -> dict[str, Any]:
    """Parsed mapping with ``dynamic`` forced to ``strict``; a ``_doc`` wrapper is kept."""
    normalized = mapping_from_dict(mapping)
    mapping_body(normalized)["dynamic"] = "strict"
    return normalized


def mapping_json(mapping: Mapping[str, Any]) -> str:
    return json.dumps(mapping, ensure_ascii=False, separators=(",", ":"))


def declared_properties(mapping: Mapping[str, Any] | str) -> dict[str, Any]:
    """Field name -> declaration at the root of the mapping."""
    return properties_of(mapping_body(mapping_from_dict(mapping)), "mapping")


def properties_of(declaration: Mapping[str, Any], where: str) -> dict[str, Any]:
    properties = declaration.get("properties", {})
    if not isinstance(properties, dict):
        raise ValueError(f"{where}: properties must be a JSON object")
    for name, field in properties.items():
        if not isinstance(field, dict):
            raise ValueError(f"{where}: the declaration of field {name!r} must be a JSON object")
    return expanded(properties, where)


def expanded(properties: Mapping[str, Any], where: str) -> dict[str, Any]:
    """Declarations with names such as ``a.b`` turned into a field ``b`` of an object ``a``.

    Several declarations of one object are merged; of one field, they are an error.
    """
    found: dict[str, Any] = {}
    for name, spec in properties.items():
        first, _, rest = name.partition(".")
        if not first or name.endswith("."):
            raise ValueError(f"{where}: a field name has an empty part: {name!r}")
        if rest:
            spec = {"properties": {rest: spec}}
        if first not in found:
            found[first] = spec
        elif is_object(found[first]) and is_object(spec):
            inner = {**found[first].get("properties", {})}
            for key, value in spec.get("properties", {}).items():
                if key in inner and not (is_object(inner[key]) and is_object(value)):
                    raise ValueError(f"{where}: field {first}.{key} is declared twice")
                inner[key] = {**inner.get(key, {}), **value, **_merged_properties(inner.get(key), value)}
            found[first] = {**found[first], **spec, "properties": inner}
        else:
            raise ValueError(f"{where}: field {first} is declared twice")
    return found


def _merged_properties(one: Mapping[str, Any] | None, other: Mapping[str, Any]) -> dict[str, Any]:
    both = {**(one or {}).get("properties", {}), **other.get("properties", {})}
    return {"properties": both} if both else {}


def flag(declaration: Mapping[str, Any], name: str, default: bool) -> bool:
    value = declaration.get(name, default)
    if value in (True, "true"):
        return True
    if value in (False, "false"):
        return False
    raise ValueError(f"parameter {name} must be true or false, not {value!r}")


def is_opaque(declaration: Mapping[str, Any]) -> bool:
    """An object that is kept in the source, but neither checked nor stored as columns."""
    return is_object(declaration) and not flag(declaration, "enabled", True)


def check_parameters(declaration: Mapping[str, Any], name: str) -> None:
    """Every parameter is known, and one that its type takes."""
    declared = "object" if is_object(declaration) else declaration.get("type")
    for key in declaration:
        if key in SERVER_PARAMETERS:
            continue
        if key not in OWN_PARAMETERS:
            raise ValueError(f"field {name!r}: unknown parameter {key!r}")
        if declared not in TAKEN_BY.get(key, (declared,)):
            raise ValueError(f"field {name!r}: type {declared!r} takes no parameter {key!r}")
    for key in ("enabled", "coerce", "ignore_malformed"):
        flag(declaration, key, True)
    date_patterns(declaration)


def date_patterns(declaration: Mapping[str, Any]) -> list[str]:
    """The alternatives of a date format: ``iso``, ``epoch_millis``, ``epoch_second`` or a pattern."""
    found = []
    for part in str(declaration.get("format", DEFAULT_FORMAT)).split("||"):
        if not part:
            raise ValueError("a date format has an empty alternative")
        if part in ISO_FORMATS:
            found.append("iso")
        elif part in ("epoch_millis", "epoch_second"):
            found.append(part)
        else:
            found.append(DATE_FORMATS.get(part.removeprefix("strict_"), part).replace("uuuu", "yyyy"))
    return found


def is_object(declaration: Mapping[str, Any]) -> bool:
    """An object field: ``type: object``, or no type at all but ``properties``."""
    return declaration.get("type", "object" if "properties" in declaration else None) == "object"


def field_type(declaration: Mapping[str, Any], name: str) -> T.DataType:
    check_parameters(declaration, name)
    if is_opaque(declaration):
        return T.StructType()
    if is_object(declaration):
        return _struct(properties_of(declaration, name), f"{name}.")
    declared = declaration.get("type")
    if declared not in FIELD_TYPES:
        supported = ", ".join([*FIELD_TYPES, "object"])
        raise ValueError(f"field {name!r}: type {declared!r} is not supported ({supported})")
    return FIELD_TYPES[declared]


def lists_type(dtype: T.DataType) -> T.DataType:
    """The same fields with a list of values each."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, lists_type(f.dataType)) for f in dtype.fields])
    return T.ArrayType(dtype)


def ignores_malformed(mapping: Mapping[str, Any] | str) -> bool:
    """Whether any field may leave out values that do not fit."""

    def visit(properties: Mapping[str, Any], where: str) -> bool:
        return any(
            visit(properties_of(spec, name), name) if is_object(spec) else flag(spec, "ignore_malformed", False)
            for name, spec in properties.items()
        )

    return visit(declared_properties(mapping), "mapping")


def is_empty(dtype: T.DataType) -> bool:
    """An object that declares nothing: checked like any object, but there is no column for it."""
    return isinstance(dtype, T.StructType) and not dtype.fields


def _struct(properties: Mapping[str, Any], prefix: str = "") -> T.StructType:
    types = {name: field_type(spec, prefix + name) for name, spec in properties.items()}
    return T.StructType(
        [T.StructField(name, dtype) for name, dtype in types.items() if not is_empty(dtype)]
    )


def mapping_to_schema(mapping: Mapping[str, Any] | str) -> T.StructType:
    """Spark schema of the declared fields."""
    return _struct(declared_properties(mapping))


def text_fields(mapping: Mapping[str, Any] | str) -> list[str]:
    """Root fields of type ``text``: searched through postings, not stored as columns."""
    return [n for n, d in declared_properties(mapping).items() if d.get("type") == "text"]


def text_paths(mapping: Mapping[str, Any] | str) -> dict[str, tuple[str, ...]]:
    """Every field of type ``text`` by its dotted name, with the names that lead to it."""
    found: dict[str, tuple[str, ...]] = {}

    def visit(properties: Mapping[str, Any], above: tuple[str, ...]) -> None:
        for name, spec in properties.items():
            path = (*above, name)
            if is_opaque(spec):
                continue
            if is_object(spec):
                visit(properties_of(spec, ".".join(path)), path)
            elif spec.get("type") == "text":
                found[".".join(path)] = path

    visit(declared_properties(mapping), ())
    return found


def stored_fields(mapping: Mapping[str, Any] | str) -> T.StructType:
    """Schema of the typed columns a snapshot stores: the declared fields but for text."""
    texts = text_fields(mapping)
    return T.StructType([f for f in mapping_to_schema(mapping).fields if f.name not in texts])
