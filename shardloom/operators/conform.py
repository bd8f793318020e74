"""Strict mappings: no undeclared field, every value of its declared type.

Two kinds of input are checked against the same mapping.  Rows of a DataFrame are compared by
schema on the driver, and only casts that can fail are guarded per value.  JSON sources are read
as variants and checked value by value.  The guards sit inside the produced columns, so whoever
writes the result has run them.

Values follow the usual coercion of search mappings: whole numbers may come as strings, fractions
are cut off, booleans are no numbers, and objects fit no scalar field.

Any field may hold a list of values; lists in lists are one list, nulls in them are left out.  So
a document has two structs of the same shape: ``fields`` with the only or first value of each field, and
``lists`` with all values of those that have several.  An object may be a list of objects, whose
fields then have lists.  A key with dots is a path: ``{"a.b": 1}`` is ``{"a": {"b": 1}}``, and both
together give two values.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from dataclasses import field as dataclass_field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.mapping import (
    REAL_NUMBERS,
    STRINGS,
    WHOLE_NUMBERS,
    date_patterns,
    declared_properties,
    field_type,
    flag,
    is_empty,
    is_object,
    is_opaque,
    lists_type,
    properties_of,
)
from shardloom.operators.documents import (
    LONG_LINE,
    NOT_AN_OBJECT,
    RAW,
    SIMPLE,
    column,
    json_variant,
    scalar_json,
    written_member,
)

# Fixed value: lists in lists are made one list to this depth.
LIST_DEPTH = 3

# Where a value can fail to fit: dotted path and the condition that it does.
Misfits = list[tuple[str, Column]]


class StrictMappingError(ValueError):
    """The schema of a DataFrame does not fit the mapping."""


@dataclass
class Conformed:
    """What a mapping makes of documents: columns to store, and the guard of all fields.

    ``typed`` and ``lists`` are None if no field is left for them, ``ignored`` if no field may
    leave values out.  The guard is TRUE or raises; None if nothing can fail.
    """

    rows: DataFrame | None
    typed: Column | None
    lists: Column | None
    ignored: Column | None
    guard: Column | None

    def columns(self) -> list[Column]:
        named = {"fields": self.typed, "lists": self.lists, "ignored": self.ignored}
        return [value.alias(name) for name, value in named.items() if value is not None]


# --- values -------------------------------------------------------------------------------


def _finite(value: Column) -> Column:
    """False for infinities and, as it is larger than all others, for NaN."""
    return F.abs(value) < float("inf")


def _date_from_text(text: Column, spec: Mapping[str, Any]) -> Column:
    """The first alternative of the format that reads the text.

    ``iso`` is an ISO date or time or a year; epochs are whole numbers, for the default format any but
    a year.
    """
    digits = text.rlike(r"^-?\d+$")
    patterns = date_patterns(spec)
    found = []
    for pattern in patterns:
        if pattern == "iso":
            year = F.length(text) == 4 if "epoch_millis" in patterns else F.lit(True)
            found.append(F.when(text.rlike(r"^\d{4}") & (~digits | year), text.try_cast("timestamp")))
        elif pattern == "epoch_millis":
            found.append(F.when(digits, F.timestamp_millis(text.try_cast("bigint"))))
        elif pattern == "epoch_second":
            found.append(F.when(digits, F.timestamp_seconds(text.try_cast("bigint"))))
        else:
            found.append(F.try_to_timestamp(text, F.lit(pattern)))
    return F.coalesce(*found)


def _null_value(spec: Mapping[str, Any], dtype: T.DataType) -> Column | None:
    """What stands for an explicit null, typed like the field."""
    value = spec.get("null_value")
    if value is None:
        return None
    if spec["type"] == "date":
        return _date_from_text(F.lit(str(value)), spec)
    return F.lit(str(value).lower() if isinstance(value, bool) else str(value)).cast(dtype)


def _from_json(
    spec: Mapping[str, Any], path: str, text: Column, variant: Column, raw: Column
) -> Column:
    """Typed value of a scalar field from its text; NULL if it does not fit.

    Most values are settled by their text.  Where the text of a string and of another JSON type
    look the same, the type is looked up, but only then.  ``raw`` is the text as it was written.
    """
    declared, dtype = spec["type"], field_type(spec, path)
    kind = F.schema_of_variant(variant)
    if declared in STRINGS:
        doubtful = text.startswith("{") | text.startswith("[")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        # Whole numbers are their text; others may be written in several ways.
        number = text.rlike("^[-0-9IN]") & ~kind.isin("STRING", "BOOLEAN", "BIGINT")
        return F.when(number, F.coalesce(raw, text)).when(~doubtful, text).when(~nested, text)
    if declared == "boolean":
        return F.when(text.isin("true", "false"), text == "true")
    if declared == "date":
        return _date_from_text(text, spec)
    plain = text.try_cast(dtype)
    coerce = flag(spec, "coerce", True)
    if declared in REAL_NUMBERS:
        fits = _finite(plain) if coerce else _finite(plain) & (kind != "STRING")
        return F.when(fits, plain)
    if not coerce:
        whole = F.try_variant_get(variant, "$", "double")
        return F.when((kind != "STRING") & (whole == F.floor(whole)), F.try_variant_get(variant, "$", dtype.simpleString()))
    fraction = ~kind.isin("STRING", "BOOLEAN")
    cut = F.try_variant_get(variant, "$", dtype.simpleString())
    return F.when(text.isNull() | plain.isNotNull(), plain).when(fraction, cut)


# --- JSON sources -------------------------------------------------------------------------


@dataclass
class _Object:
    """One declared object of the mapping and the columns that hold its value.

    For most documents ``variant`` is the value, ``keys`` its member names (NULL if it is no
    object), ``members`` a STRUCT of the declared members: text for scalars, variants for objects.
    Documents with lists or dotted keys have ``elements`` instead: all objects that the field has.
    """

    number: int
    prefix: str
    properties: Mapping[str, Any]
    above: list[_Object] = dataclass_field(default_factory=list)
    children: dict[str, _Object] = dataclass_field(default_factory=dict)

    def name(self, what: str) -> str:
        return f"__json_{what}_{self.number}"

    def leaf_name(self, what: str, field: str) -> str:
        return f"{self.name(what)}_{list(self.properties).index(field)}"

    @property
    def keys(self) -> Column:
        return F.col(self.name("keys"))

    @property
    def variant(self) -> Column:
        return F.col(self.name("variant"))

    @property
    def elements(self) -> Column:
        return F.col(self.name("elements"))

    def member(self, field: str) -> Column:
        return F.col(self.name("members")).getField(field)

    def member_variant(self, field: str) -> Column:
        return _member(self.variant, field)

    def scalars(self) -> list[str]:
        return [n for n, spec in self.properties.items() if n not in self.children and not is_opaque(spec)]

    def spelled(self) -> list[str]:
        """The keys under which this object may name its fields and theirs."""
        below = [f"{name}.{key}" for name, child in self.children.items() for key in child.spelled()]
        return [*self.properties, *below]

    def opaque(self) -> list[str]:
        """Those of them that name objects which are not checked."""
        below = [f"{name}.{key}" for name, child in self.children.items() for key in child.opaque()]
        return [*(name for name, spec in self.properties.items() if is_opaque(spec)), *below]

    def values(self, field: str) -> Column:
        """All values of a field, from this object and from the dotted keys of those above."""
        path, found = f"{self.prefix}{field}", []
        for node in [*self.above, self]:
            key = path.removeprefix(node.prefix)
            found.append(F.flatten(F.transform(node.elements, _listed_member(key))))
        return F.filter(F.concat(*found), lambda value: value.isNotNull())


def _struct_type(members: Mapping[str, str]) -> str:
    quoted = [f"`{name.replace('`', '``')}`:{dtype}" for name, dtype in members.items()]
    return f"struct<{','.join(quoted)}>"


def _member(value: Column, key: str) -> Column:
    return F.try_variant_get(value, "$", _struct_type({key: "variant"})).getField(key)


def _listed(value: Column, depth: int = LIST_DEPTH) -> Column:
    """A value as a list of values: itself, or what it lists."""
    if depth == 0:
        return F.array(value)
    items = F.try_variant_get(value, "$", "array<variant>")
    inner = F.flatten(F.transform(items, lambda item: _listed(item, depth - 1)))
    return F.when(items.isNull(), F.array(value)).otherwise(inner)


def _listed_member(key: str) -> Callable[[Column], Column]:
    return lambda element: _listed(_member(element, key))


def _levels(properties: Mapping[str, Any]) -> list[list[_Object]]:
    """The declared objects by depth, the root first."""
    numbers = itertools.count()
    levels = [[_Object(next(numbers), "", properties)]]
    while levels[-1]:
        below = []
        for parent in levels[-1]:
            for name, spec in parent.properties.items():
                if is_object(spec) and not is_opaque(spec):
                    path = parent.prefix + name
                    above = [*parent.above, parent]
                    child = _Object(next(numbers), f"{path}.", properties_of(spec, path), above)
                    parent.children[name] = child
                    below.append(child)
        levels.append(below)
    return levels[:-1]


PLAIN = "__json_plain"


def _read_members(docs: DataFrame, levels: list[list[_Object]]) -> DataFrame:
    """Parse each source once and add the columns of every declared object.

    Each depth is a projection of its own, so that nothing is parsed or looked up again by
    the expressions that use it.  The columns then pass through a one-element ``inline``, below
    which the optimizer moves no filter on them: moved there, it would parse again.
    """
    root = levels[0][0]
    helpers = [root.name("variant")]
    out = docs.withColumn(root.name("variant"), json_variant(F.col("source")))
    for level in levels:
        found = {}
        for node in level:
            members = F.try_variant_get(node.variant, "$", "map<string,variant>")
            found[node.name("keys")] = F.map_keys(members)
            if node.properties:
                types = {
                    name: "variant" if is_object(spec) else "string"
                    for name, spec in node.properties.items()
                }
                found[node.name("members")] = F.try_variant_get(
                    node.variant, "$", _struct_type(types)
                )
        out = out.withColumns(found)
        helpers += found
        below = {
            child.name("variant"): node.member(name)
            for node in level
            for name, child in node.children.items()
        }
        out = out.withColumns(below) if below else out
        helpers += below
    nodes = list(itertools.chain.from_iterable(levels))
    dotted = F.lit(False)
    for node in nodes:
        dotted = dotted | F.coalesce(F.array_join(node.keys, "").contains("."), F.lit(False))
    # Without a bracket there is no list.
    out = out.withColumn(PLAIN, ~(F.col("source").contains("[") | dotted))
    helpers.append(PLAIN)
    for level in levels:
        found = {}
        for node in level:
            parent = node.above[-1] if node.above else None
            values = F.array(node.variant) if parent is None else parent.values(node.prefix.removeprefix(parent.prefix)[:-1])
            found[node.name("elements")] = F.when(~F.col(PLAIN), values)
        out = out.withColumns(found)
        helpers += found
    return out.select(*[column(name) for name in docs.columns], F.inline(F.array(F.struct(*helpers))))


def _undeclared(levels: list[list[_Object]]) -> Column:
    """Array of the dotted paths that are present but not declared."""
    none = F.array().cast("array<string>")
    found = []
    for node in itertools.chain.from_iterable(levels):
        declared = F.lit(list(node.properties)) if node.properties else none
        spelled = F.lit(node.spelled()) if node.properties else none
        all_keys = F.array_distinct(F.flatten(F.transform(node.elements, _keys_or_none)))
        for name in node.opaque():
            all_keys = F.filter(all_keys, _not_below(name))
        extra = F.when(F.col(PLAIN), F.array_except(node.keys, declared)).otherwise(
            F.array_except(all_keys, spelled)
        )
        extra = F.coalesce(extra, none)
        if node.prefix:
            extra = F.transform(extra, _prepend(node.prefix))
        found.append(extra)
    return F.concat(*found) if len(found) > 1 else found[0]


def _keys_or_none(element: Column) -> Column:
    keys = F.map_keys(F.try_variant_get(element, "$", "map<string,variant>"))
    return F.coalesce(keys, F.array().cast("array<string>"))


def _not_below(name: str) -> Callable[[Column], Column]:
    return lambda key: ~key.startswith(f"{name}.")


def _prepend(prefix: str) -> Callable[[Column], Column]:
    return lambda name: F.concat(F.lit(prefix), name)


def _long_text(node: _Object, name: str) -> Column:
    """A string of the source, of any length."""
    path = [*node.prefix.split(".")[:-1], name]
    dtype = "string"
    for step in reversed(path):
        dtype = _struct_type({step: dtype})
    value = F.from_json("source", dtype, RAW)
    for step in path:
        value = value.getField(step)
    return value


def _written(node: _Object, name: str) -> Column:
    """A member of the source as it is written."""
    value = F.col("source")
    for step in [*node.prefix.split(".")[:-1], name]:
        value = written_member(value, step)
    return value


def _typed_columns(docs: DataFrame, levels: list[list[_Object]]) -> DataFrame:
    """For each scalar field its value, the list of its values, and whether some do not fit."""
    leaves = [(node, name) for level in levels for node in level for name in node.scalars()]
    steps: list[dict[str, Column]] = [{}, {}, {}, {}]
    for node, name in leaves:
        spec, path = node.properties[name], node.prefix + name
        dtype = field_type(spec, path)
        of = {what: node.leaf_name(what, name) for what in ("values", "list", "typed", "bad", "several")}
        plain, values, several = F.col(PLAIN), F.col(of["values"]), F.col(of["several"])
        text, variant, missing = node.member(name), node.member_variant(name), _null_value(spec, dtype)
        if spec["type"] in STRINGS:
            # A string of any length, which variants do not hold.
            text = F.when(F.octet_length("source") > LONG_LINE, _long_text(node, name)).otherwise(text)
            # A number as it is written, in lists that hold no other lists.
            written = _written(node, name)
            items = F.regexp_extract_all(written, F.lit(f"({SIMPLE})"), F.lit(1))
        else:
            written, items = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
        one = _from_json(spec, path, text, variant, written)
        bad = text.isNotNull() & F.col(of["typed"]).isNull()
        if missing is not None:
            one = F.when(F.is_variant_null(variant), missing).otherwise(one)
        given = F.filter(values, lambda value: ~F.is_variant_null(value)) if missing is None else values
        steps[0][of["values"]] = F.when(~plain, node.values(name))
        steps[1][of["several"]] = F.array_compact(F.transform(values, _each(spec, path, missing, items, values)))
        steps[2][of["typed"]] = F.when(plain, one).otherwise(F.get(several, F.lit(0)))
        steps[3][of["list"]] = F.when(F.size(several) > 1, several)
        steps[3][of["bad"]] = F.when(plain, bad).otherwise(F.size(several) < F.size(given))
    for step in steps:
        docs = docs.withColumns(step) if step else docs
    return docs


def _each(
    spec: Mapping[str, Any], path: str, missing: Column | None, items: Column, values: Column
) -> Callable[[Column, Column], Column]:
    def typed(value: Column, i: Column) -> Column:
        raw = F.when(F.size(items) == F.size(values), F.get(items, i))
        one = _from_json(spec, path, F.try_variant_get(value, "$", "string"), value, raw)
        return one if missing is None else F.when(F.is_variant_null(value), missing).otherwise(one)

    return typed


def _has_object(node: _Object) -> Column:
    objects = F.exists(node.elements, lambda e: F.try_variant_get(e, "$", "map<string,variant>").isNotNull())
    # Or what dotted keys say of it.
    for name in node.scalars():
        objects = objects | (F.size(F.col(node.leaf_name("values", name))) > 0)
    for child in node.children.values():
        objects = objects | _has_object(child)
    return F.when(F.col(PLAIN), node.keys.isNotNull()).otherwise(objects)


def _leaf_struct(node: _Object, what: str, skip: Collection[str] = ()) -> Column | None:
    """STRUCT of the declared members in mapping order, None if there are none."""
    values = []
    for name, spec in node.properties.items():
        if name in skip or is_opaque(spec):
            continue
        child = node.children.get(name)
        value = F.col(node.leaf_name(what, name)) if child is None else _leaf_struct(child, what)
        if value is not None:
            values.append(value.alias(name))
    if not values:
        return None
    return F.struct(*values) if node.number == 0 else F.when(_has_object(node), F.struct(*values))


def _json_misfits(levels: list[list[_Object]]) -> tuple[Misfits, Misfits]:
    """Scalars with values that have no typed value, objects that are something else; and those
    that may be left out."""
    misfits, ignored = [], []
    for node in itertools.chain.from_iterable(levels):
        for name, child in node.children.items():
            there = child.variant.isNotNull() & ~F.is_variant_null(child.variant)
            other = F.exists(child.elements, _no_object)
            misfits.append((node.prefix + name, F.when(F.col(PLAIN), there & child.keys.isNull()).otherwise(other)))
        for name in node.scalars():
            kind = ignored if flag(node.properties[name], "ignore_malformed", False) else misfits
            kind.append((node.prefix + name, F.col(node.leaf_name("bad", name))))
    return misfits, ignored


def _no_object(element: Column) -> Column:
    return ~F.is_variant_null(element) & F.try_variant_get(element, "$", "map<string,variant>").isNull()


def _error(message: Column) -> Column:
    return F.raise_error(message).cast("boolean")


def _undeclared_error(paths: Column) -> Column:
    return _error(
        F.concat(
            F.lit("strict mapping: document "),
            F.col("_id"),
            F.lit(" has undeclared fields "),
            F.array_join(paths, ", "),
        )
    )


def _misfit_error(misfits: Misfits) -> Column:
    return _error(
        F.concat(
            F.lit("document "),
            F.col("_id"),
            F.lit(" does not fit the mapping in "),
            F.array_join(_misfit_paths(misfits), ", "),
        )
    )


def _not_an_object(root: _Object) -> tuple[Column, Column]:
    message = F.concat(F.lit("source of document "), F.col("_id"), F.lit(NOT_AN_OBJECT))
    return root.keys.isNull(), _error(message)


def _misfit_paths(misfits: Misfits) -> Column:
    found = [F.when(misfit, F.lit(path)) for path, misfit in misfits]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _any(misfits: Misfits) -> Column:
    bad = F.lit(False)
    for _, misfit in misfits:
        bad = bad | F.coalesce(misfit, F.lit(False))
    return bad


def _report(parsed: DataFrame, paths: Column) -> DataFrame:
    """``(field, n_docs)`` from one array of paths per document.

    The outer ``explode`` keeps the optimizer from testing the array first, which would
    evaluate it twice.
    """
    return (
        parsed.select(F.explode_outer(paths).alias("field"))
        .where(F.col("field").isNotNull())
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def json_conformance(
    docs: DataFrame, mapping: Mapping[str, Any] | str, skip: Collection[str] = ()
) -> Conformed:
    """``docs`` with helper columns, and the columns of the declared fields, in ``typed`` but for ``skip``."""
    levels = _levels(declared_properties(mapping))
    root = levels[0][0]
    parsed = _typed_columns(_read_members(docs, levels), levels)
    misfits, ignored = _json_misfits(levels)
    paths = _undeclared(levels)
    guard = (
        F.when(*_not_an_object(root))
        .when(F.size(paths) > 0, _undeclared_error(paths))
        .when(_any(misfits), _misfit_error(misfits))
        .otherwise(F.lit(True))
    )
    left_out = _misfit_paths(ignored) if ignored else None
    return Conformed(parsed, _leaf_struct(root, "typed", skip), _leaf_struct(root, "list"), left_out, guard)


def conform_to_mapping(docs: DataFrame, mapping: Mapping[str, Any] | str) -> DataFrame:
    """``(_id, source)`` documents plus ``fields``, a STRUCT of the declared fields, ``lists``, one
    of the same shape with all values of fields that have several, and, if the mapping lets fields
    leave out malformed values, ``ignored``, the paths of those that did.

    An undeclared field or a value that does not fit its type fails the job.
    """
    made = json_conformance(docs, mapping)
    if made.typed is None:
        raise ValueError("the mapping declares no field")
    checked = F.when(made.guard, made.typed).alias("fields")
    return made.rows.select(*docs.columns, checked, *made.columns()[1:])


def nonconforming_fields(docs: DataFrame, mapping: Mapping[str, Any] | str) -> DataFrame:
    """Report: ``(field, n_docs)`` for each field with values that do not fit its type."""
    levels = _levels(declared_properties(mapping))
    parsed = _typed_columns(_read_members(docs, levels), levels)
    misfits, ignored = _json_misfits(levels)
    return _report(parsed, _misfit_paths(misfits + ignored))


def undeclared_fields(docs: DataFrame, mapping: Mapping[str, Any] | str) -> DataFrame:
    """Report: ``(field, n_docs)`` for each undeclared field of JSON sources."""
    levels = _levels(declared_properties(mapping))
    return _report(_read_members(docs, levels), _undeclared(levels))


def reject_undeclared_fields(docs: DataFrame, mapping: Mapping[str, Any] | str) -> DataFrame:
    """Documents unchanged; evaluating the source of one with an undeclared field fails."""
    levels = _levels(declared_properties(mapping))
    paths = _undeclared(levels)
    guard = (
        F.when(*_not_an_object(levels[0][0]))
        .when(F.size(paths) > 0, _undeclared_error(paths))
        .otherwise(F.lit(True))
    )
    checked = F.when(guard, F.col("source")).alias("source")
    return _read_members(docs, levels).select(
        *[checked if name == "source" else F.col(name) for name in docs.columns]
    )


# --- rows of a DataFrame ------------------------------------------------------------------

# How to take a member out of its parent (None at the root), and its type.
Getter = Callable[[Column | None], Column]


@dataclass
class _Given:
    """A column or member of the rows; one with dots in its name is a member of an object."""

    get: Getter | None
    dtype: T.DataType | None
    members: dict[str, _Given] = dataclass_field(default_factory=dict)


def _getter(name: str) -> Getter:
    return lambda parent: column(name) if parent is None else parent.getField(name)


def _below(outer: Getter, inner: Getter) -> Getter:
    return lambda parent: inner(outer(parent))


def _given(schema: T.StructType, prefix: str = "") -> dict[str, _Given]:
    """Members by name, dotted names expanded and merged with the objects they are part of."""
    found: dict[str, _Given] = {}

    def add(into: dict[str, _Given], name: str, value: _Given, path: str) -> None:
        first, _, rest = name.partition(".")
        path = f"{path}{first}"
        if rest:
            holder = into.setdefault(first, _Given(None, None))
            open_up(holder, path)
            add(holder.members, rest, value, f"{path}.")
        elif first not in into:
            into[first] = value
        elif value.dtype is not None and isinstance(value.dtype, T.StructType):
            open_up(into[first], path)
            for inner, member in _given(value.dtype, f"{path}.").items():
                add(into[first].members, inner, _Given(_below(value.get, member.get), member.dtype, member.members), f"{path}.")
        else:
            raise StrictMappingError(f"field {path} is given by several columns")

    def open_up(holder: _Given, path: str) -> None:
        if holder.dtype is None:
            return
        if not isinstance(holder.dtype, T.StructType):
            raise StrictMappingError(f"field {path} is given by several columns")
        outer, schema = holder.get, holder.dtype
        holder.get, holder.dtype = None, None
        for inner, member in _given(schema, f"{path}.").items():
            add(holder.members, inner, _Given(_below(outer, member.get), member.dtype, member.members), f"{path}.")

    for field in schema.fields:
        add(found, field.name, _Given(_getter(field.name), field.dataType), prefix)
    return found


def _element(dtype: T.DataType | None) -> T.DataType | None:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype


def undeclared_columns(
    schema: T.StructType, properties: Mapping[str, Any], prefix: str = ""
) -> list[str]:
    """Dotted paths of schema fields that the mapping does not declare."""

    def visit(members: Mapping[str, _Given], properties: Mapping[str, Any], prefix: str) -> list[str]:
        found = []
        for name, value in members.items():
            path = prefix + name
            spec = properties.get(name)
            inner = _element(value.dtype)
            if spec is None:
                found.append(path)
            elif is_object(spec) and not is_opaque(spec):
                below = _given(inner, f"{path}.") if isinstance(inner, T.StructType) else value.members
                found += visit(below, properties_of(spec, path), f"{path}.")
        return found

    return visit(_given(schema, prefix), properties, prefix)


def check_columns(schema: T.StructType, mapping: Mapping[str, Any] | str) -> None:
    extra = undeclared_columns(schema, declared_properties(mapping))
    if extra:
        raise StrictMappingError(f"strict mapping: undeclared fields {', '.join(extra)}")


def fits_by_schema(schema: T.StructType) -> bool:
    """Whether the types alone say enough: no map or variant at any depth."""
    return all(
        fits_by_schema(_element(field.dataType))
        if isinstance(_element(field.dataType), T.StructType)
        else not isinstance(_element(field.dataType), (T.MapType, T.VariantType))
        for field in schema.fields
    )


@dataclass
class _Made:
    """Value and list of values of a field, and where its values can fail to fit."""

    typed: Column | None
    lists: Column | None
    misfits: Misfits = dataclass_field(default_factory=list)
    ignored: Misfits = dataclass_field(default_factory=list)


def _row_scalar(
    value: Column, source: T.DataType, spec: Mapping[str, Any], path: str
) -> tuple[Column, Column | None]:
    """A value as its declared type, and the condition that it does not fit, if it can."""
    refused = _refused(source, spec, path)
    if isinstance(source, (T.StructType, T.BinaryType)):
        raise refused
    declared = spec["type"]
    dtype = field_type(spec, path)
    coerce = flag(spec, "coerce", True)
    is_text = isinstance(source, (T.StringType, T.CharType, T.VarcharType))
    is_number = isinstance(source, T.NumericType)
    there = value.isNotNull()
    if isinstance(source, T.NullType):
        return value.cast(dtype), None
    if declared in REAL_NUMBERS and isinstance(source, (T.DoubleType, T.FloatType)):
        typed = value.cast(dtype)
        return typed, there & ~_finite(typed)
    if declared in STRINGS:
        # The same text as the source has.
        return (value.cast(dtype) if is_text else scalar_json(value)), None
    if source == dtype and declared != "date":
        return value.cast(dtype), None
    if declared == "boolean" and is_text:
        return value.try_cast(dtype), there & ~value.isin("true", "false")
    if declared == "date" and isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast(dtype), None
    if declared == "date" and (is_text or isinstance(source, T.IntegralType)):
        if isinstance(source, T.IntegralType) and "format" not in spec:
            return F.timestamp_millis(value), None
        typed = _date_from_text(value.cast("string"), spec)
        return typed, there & typed.isNull()
    if declared in WHOLE_NUMBERS + REAL_NUMBERS and (is_number or (is_text and coerce)):
        typed = value.try_cast(dtype)
        fits = typed.isNotNull() & _finite(typed) if declared in REAL_NUMBERS else typed.isNotNull()
        if not coerce and declared in WHOLE_NUMBERS and not isinstance(source, T.IntegralType):
            fits = fits & (value == F.floor(value))
        return typed, there & ~fits
    if is_text and declared in WHOLE_NUMBERS + REAL_NUMBERS:
        return F.lit(None).cast(dtype), there
    raise refused


def _refused(source: T.DataType, spec: Mapping[str, Any], path: str) -> StrictMappingError:
    return StrictMappingError(
        f"field {path}: a column of type {source.simpleString()} does not fit the declaration "
        f"{spec.get('type', 'object')}"
    )


def _row_field(value: Column, source: T.DataType, spec: Mapping[str, Any], path: str) -> _Made:
    flat, inner = value, source
    if isinstance(source, T.ArrayType):
        while isinstance(inner, T.ArrayType):
            flat = F.filter(flat, lambda x: x.isNotNull())
            if isinstance(inner.elementType, T.ArrayType):
                flat = F.flatten(flat)
            inner = inner.elementType
    if is_object(spec):
        if not isinstance(inner, (T.StructType, T.NullType)):
            raise _refused(source, spec, path)
        if isinstance(inner, T.NullType):
            return _Made(None, None)
        members = _given(inner, f"{path}.")
        if flat is value:
            made = _row_struct(lambda member: member.get(value), members, properties_of(spec, path), f"{path}.")
            there = value.isNotNull()
        else:
            def pick(member: _Given) -> Column:
                return F.transform(flat, lambda item: member.get(item))

            made = _row_struct(pick, members, properties_of(spec, path), f"{path}.", listed=True)
            there = F.size(flat) > 0
        for what in ("typed", "lists"):
            column_of = getattr(made, what)
            if column_of is not None:
                setattr(made, what, F.when(there, column_of))
        return made
    dtype = field_type(spec, path)
    missing = _null_value(spec, dtype)
    kind = "ignored" if flag(spec, "ignore_malformed", False) else "misfits"
    if flat is not value:
        typed, lists, bad = _row_list(flat, inner, spec, path, dtype)
    else:
        typed, bad = _row_scalar(value, source, spec, path)
        lists = F.lit(None).cast(T.ArrayType(dtype))
    if missing is not None:
        typed = F.when(value.isNull(), missing).otherwise(typed)
    return _Made(typed, lists, **({} if bad is None else {kind: [(path, bad)]}))


def _row_list(
    flat: Column, inner: T.DataType, spec: Mapping[str, Any], path: str, dtype: T.DataType
) -> tuple[Column, Column, Column | None]:
    probe = _row_scalar(F.lit(None), inner, spec, path)[1]
    values = F.transform(flat, lambda item: _row_scalar(item, inner, spec, path)[0].cast(dtype))
    bad = None if probe is None else F.exists(flat, lambda item: _row_scalar(item, inner, spec, path)[1])
    kept = F.array_compact(values)
    return F.get(kept, F.lit(0)), F.when(F.size(kept) > 1, kept), bad


def _row_struct(
    pick: Callable[[_Given], Column],
    members: Mapping[str, _Given],
    properties: Mapping[str, Any],
    prefix: str = "",
    skip: Collection[str] = (),
    listed: bool = False,
) -> _Made:
    """Structs in mapping order; declared fields the rows lack become NULL."""
    typed, lists, out = [], [], _Made(None, None)
    for name, spec in properties.items():
        path = prefix + name
        dtype = field_type(spec, path)
        if is_empty(dtype) and is_opaque(spec):
            continue
        made = _Made(None, None)
        value = members.get(name)
        if value is not None and value.dtype is None:
            if not is_object(spec):
                raise StrictMappingError(f"field {path}: an object does not fit the declaration {spec['type']}")
            made = _row_struct(pick, value.members, properties_of(spec, path), f"{path}.", listed=listed)
            inside = [pick(leaf) for leaf in _leaves(value.members)]
            there = F.coalesce(*[F.when(x.isNotNull(), F.lit(True)) for x in inside], F.lit(False))
            made.typed, made.lists = (None if x is None else F.when(there, x) for x in (made.typed, made.lists))
        elif value is not None:
            source = T.ArrayType(value.dtype) if listed else value.dtype
            made = _row_field(pick(value), source, spec, path)
        out.misfits += made.misfits
        out.ignored += made.ignored
        if is_empty(dtype):
            continue
        several = lists_type(dtype)
        one, many = (F.lit(None) if x is None else x for x in (made.typed, made.lists))
        if name not in skip:
            typed.append(one.cast(dtype).alias(name))
        lists.append(many.cast(several).alias(name))
    out.typed, out.lists = (F.struct(*x) if x else None for x in (typed, lists))
    return out


def _leaves(members: Mapping[str, _Given]) -> list[_Given]:
    return [leaf for m in members.values() for leaf in ([m] if m.dtype is not None else _leaves(m.members))]


def row_conformance(
    parent: Column | None,
    schema: T.StructType,
    mapping: Mapping[str, Any] | str,
    skip: Collection[str] = (),
) -> Conformed:
    """Like ``json_conformance`` for typed columns (or the members of the struct ``parent``).

    The guard is None if the types already say that every value fits.
    """
    check_columns(schema, mapping)
    made = _row_struct(lambda member: member.get(parent), _given(schema), declared_properties(mapping), skip=skip)
    guard = F.when(_any(made.misfits), _misfit_error(made.misfits)).otherwise(F.lit(True))
    left_out = _misfit_paths(made.ignored) if made.ignored else None
    return Conformed(None, made.typed, made.lists, left_out, guard if made.misfits else None)
