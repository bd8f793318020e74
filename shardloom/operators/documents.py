"""Ids and JSON sources: the two columns every document has."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nulls stay in the source; timestamps keep their microseconds and name UTC.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

NOT_AN_OBJECT = " is not a JSON object with distinct keys"

# Strings and numbers of any length; bytes from which on JSON may hold a string that is
# too long for a variant.
RAW = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}
LONG_LINE = 20_000_000


def column(name: str) -> Column:
    """A top-level column whatever its name holds (dots, spaces, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def extract_id(id_field: str = "_id") -> Column:
    """The id column as a string, whatever its type."""
    return column(id_field).cast("string")


def require_id(value: Column, id_field: str, where: Column | None = None) -> Column:
    """The id itself; a NULL id fails the job with a message that names the field."""
    message = F.lit(f"document is missing id field {id_field}")
    if where is not None:
        message = F.concat(message, F.lit(" in "), F.coalesce(where, F.lit("unknown input")))
    return F.coalesce(value, F.raise_error(message).cast("string"))


# A JSON string; a string or scalar; the tokens of a JSON text.
STRING = r'"(?:[^"\\]++|\\.)*+"'
SIMPLE = rf'(?:{STRING}|[^,{{}}\[\]"\s]+)'
TOKEN = rf'({STRING}|[{{}}\[\]:,]|[^"{{}}\[\]:,]++)'


def member_pattern(key: str) -> str:
    """A member with a string or scalar, its value as group 1."""
    return rf"\Q{json.dumps(key, ensure_ascii=False)}\E\s*:\s*({SIMPLE})"


def is_plain(text: Column, key: str) -> Column:
    """Whether the key is written once in a JSON object, could not be written otherwise, and has a
    string or scalar: a pattern finds it then."""
    quoted = json.dumps(key, ensure_ascii=False)
    once = F.octet_length(F.replace(text, F.lit(quoted), F.lit(""))) == F.octet_length(text) - len(quoted.encode())
    escape = "\\u" if re.fullmatch(r"\w+", key, re.ASCII) else "\\"
    return once & ~text.contains(escape) & text.rlike(member_pattern(key))


def member_bounds(text: Column, key: str) -> Column:
    """``(start, value_at, stop)`` of a member of a JSON object, token by token; from 0, -1 if absent."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))
    zero, none = F.lit(0), F.lit(-1)
    state = F.struct(
        zero.alias("at"), zero.alias("depth"), F.lit("").alias("last"), zero.alias("last_at"),
        none.alias("start"), none.alias("value_at"), none.alias("stop"),
    )

    def step(s: Column, token: Column) -> Column:
        name = F.get(F.from_json(F.concat(F.lit("["), s["last"], F.lit("]")), "array<string>", RAW), F.lit(0))
        colon = (s["start"] < 0) & (token == ":") & (s["depth"] == 1)
        begins = F.when(colon, name == key).otherwise(F.lit(False))
        ends = (s["start"] >= 0) & (s["stop"] < 0) & (s["depth"] == 1) & token.isin(",", "}")
        is_string = token.startswith('"')
        deeper = F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)
        return F.struct(
            (s["at"] + F.char_length(token)).alias("at"),
            (s["depth"] + deeper).alias("depth"),
            F.when(is_string, token).otherwise(s["last"]).alias("last"),
            F.when(is_string, s["at"]).otherwise(s["last_at"]).alias("last_at"),
            F.when(begins, s["last_at"]).otherwise(s["start"]).alias("start"),
            F.when(begins, s["at"] + 1).otherwise(s["value_at"]).alias("value_at"),
            F.when(ends, s["at"]).otherwise(s["stop"]).alias("stop"),
        )

    return F.aggregate(tokens, state, step, lambda s: F.struct(s["start"], s["value_at"], s["stop"]))


def written_member(text: Column, key: str) -> Column:
    """A member of a JSON object as it is written."""
    def slow(b: Column) -> Column:
        return F.trim(F.substring(text, b["value_at"] + 1, b["stop"] - b["value_at"]))

    bounds = F.transform(F.array(member_bounds(text, key)), slow)
    return F.when(is_plain(text, key), F.regexp_extract(text, member_pattern(key), 1)).otherwise(F.get(bounds, F.lit(0)))


def member_text(text: Column, key: str) -> Column:
    """A member of a JSON object as text: of a string its value, of all else what is written."""
    quoted = key.replace("`", "``")
    value = F.from_json(text, f"struct<`{quoted}`:string>", RAW).getField(key)
    written = written_member(text, key)
    return F.when(value.isNull() | written.startswith('"'), value).otherwise(written)


def without_member(text: Column, key: str) -> Column:
    """JSON text of an object without its member ``key``; the rest stays as it is written."""
    member = member_pattern(key)
    cut = F.regexp_replace(text, rf"(?:,\s*{member}(?=\s*[,}}]))|(?:{member}\s*,?\s*)", "")
    return F.when(is_plain(text, key), cut).otherwise(without_member_by_tokens(text, key))


def without_member_by_tokens(text: Column, key: str) -> Column:
    def joined(b: Column) -> Column:
        before = F.substring(text, F.lit(1), b["start"])
        after = F.substring(text, b["stop"] + 1, F.char_length(text))
        last = F.concat(F.regexp_replace(before, r",\s*$", ""), after)
        return F.when(after.startswith(","), F.concat(before, F.regexp_replace(after, r"^,\s*", ""))).otherwise(last)

    return F.get(F.transform(F.array(member_bounds(text, key)), joined), F.lit(0))


def json_variant(text: Column) -> Column:
    """JSON text as a variant; NULL for text that is malformed or repeats a key.

    Variants do not hold strings of more than ``LONG_LINE`` characters: in an object with such
    strings these are left empty, and members are told apart by their text.
    """
    members = F.from_json(text, "map<string,string>", RAW)

    def member(_: Column, value: Column) -> Column:
        parsed = F.coalesce(F.try_parse_json(value), value.cast("variant"))
        return F.when(F.octet_length(value) > LONG_LINE, F.lit("").cast("variant")).otherwise(parsed)

    keys = F.map_keys(members)
    rebuilt = F.to_variant_object(F.transform_values(members, member))
    distinct = F.size(keys) == F.size(F.array_distinct(keys))
    return F.coalesce(
        F.try_parse_json(text), F.when((F.octet_length(text) > LONG_LINE) & distinct, rebuilt)
    )


def checked_object(text: Column, where: Column) -> Column:
    """The text itself, if it is a JSON object whose keys are distinct; else the job fails, with a
    message that ``where`` begins."""
    is_object = F.try_variant_get(json_variant(text), "$", "map<string,variant>").isNotNull()
    message = F.concat(where, F.lit(NOT_AN_OBJECT))
    return F.when(is_object, text).otherwise(F.raise_error(message).cast("string"))


def scalar_json(value: Column) -> Column:
    """A number, boolean, date or timestamp as ``to_source_json`` writes it, without quotes."""
    text = to_source_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.trim(F.substring(text, F.lit(6), F.char_length(text) - 6), F.lit('"')))


def to_source_json(value: Column) -> Column:
    """A struct, map or variant as JSON text, NULL fields kept."""
    return F.to_json(value, JSON_OPTIONS)
