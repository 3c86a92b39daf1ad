"""Nested JSON to one level of dotted keys.

A few levels are opened by expressions one inside the other, so that plans stay small and
shallow documents pay for their own depth only. What is nested deeper, to any depth, is
read off its text in one pass over the tokens, because opening a VARIANT level by level copies
all that is left for each level. All of it runs in the JVM, also in streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.variants import (
    as_items,
    as_members,
    as_string,
    is_scalar_kind,
    let,
    normal_number,
    schema_kind,
)
from weirflow.operators.once import fence

NATIVE_LEVELS = 3
FLAT = "map<string,variant>"
_LEAVES = "_flat_leaves"
#: Stands between the keys of a path; JSON text holds no such character.
_SEP = "\x01"
#: Kinds whose text reads as another kind (a decimal 5.0 is written as 5), or that may hide them (mixed lists).
_NOT_JSON = "DATE|TIME|BINARY|FLOAT|INTERVAL|UUID|VARIANT|DECIMAL"
_STRING = '"[^"]*+"'
#: Keys that open objects, a key that opens a list, a key with a scalar, ends of objects, the rest. Runs
#: of keys are bounded, as the matcher goes one call deeper for each.
_TOKENS = (
    rf'(?:{_STRING}:\{{){{1,32}}+|{_STRING}:\[|{_STRING}:{_STRING}|{_STRING}:[^,{{}}\[\]"]++|{_STRING}|\}}++|[\{{\[\]]|[^,{{}}\[\]"]++'
)


def _entry(key: Column, v: Column) -> Column:
    """Key, value, and the members if the value is an object."""
    return F.struct(key.alias("key"), v.alias("v"), as_members(v).alias("members"))


def _is_open(entry: Column) -> Column:
    return entry["members"].isNotNull()


def _expand(entries: Column) -> Column:
    """Replace every object by its members, in place."""

    def members(e: Column) -> Column:
        return F.transform(
            F.map_entries(e["members"]),
            lambda m: _entry(
                F.when(e["key"] == "", m["key"]).otherwise(F.concat_ws(".", e["key"], m["key"])),
                m["value"],
            ),
        )

    return F.flatten(
        F.transform(entries, lambda e: F.when(_is_open(e), members(e)).otherwise(F.array(e)))
    )


def _opened(v: Column, levels: int) -> Column:
    """Entries of a value with its first levels opened."""

    def open_levels(entries: Column, left: int) -> Column:
        if left == 0:
            return entries
        return F.when(
            F.exists(entries, _is_open),
            let(_expand(entries), lambda deeper: open_levels(deeper, left - 1)),
        ).otherwise(entries)

    return let(F.array(_entry(F.lit(""), v)), lambda e: open_levels(e, levels))


def _opened_to_the_end(entries: Column) -> Column:
    """Entries without any object left, whatever their depth, in their order."""
    return F.flatten(F.transform(entries, lambda e: F.when(_is_open(e), _deep(e)).otherwise(F.array(e))))


def _deep(entry: Column) -> Column:
    """The entries of one open entry: read off its text, unless that would change a value."""

    def entries(text: Column) -> Column:
        as_text = F.contains(text, F.lit("Infinity")) | F.contains(text, F.lit("NaN"))
        odd = F.rlike(schema_kind(entry["v"]), F.lit(_NOT_JSON))
        return F.when(as_text | odd, _deep_by_rounds(F.array(entry))).otherwise(_deep_by_text(entry["key"], text))

    return let(F.to_json(entry["v"]), entries)


def _deep_by_rounds(entries: Column) -> Column:
    """One round for each level. A value has no more levels than opening braces.

    Every round copies what is left, so this costs the square of the depth.
    """
    braces = F.transform(F.filter(entries, _is_open), lambda e: _braces(F.to_json(e["v"])))
    rounds = F.sequence(F.lit(1), F.array_max(braces))
    return F.aggregate(rounds, entries, lambda done, _: F.when(F.exists(done, _is_open), _expand(done)).otherwise(done))


def _deep_by_text(prefix: Column, text: Column) -> Column:
    """One pass over the tokens of an object's text, with the path to where the pass is.

    Quotes and backslashes inside strings are spelled as numbers first, so that a quote always
    ends a string. A run of keys that open objects is one token, and so is a run of ends.
    """
    plain = F.replace(F.replace(F.substr(text, F.lit(2)), F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    nothing = F.array().cast("array<struct<key:string,text:string>>")
    start = F.struct(
        F.lit("").alias("path"), F.lit(0).alias("depth"), F.lit(0).alias("lists"), F.lit("").alias("items"), nothing.alias("out")
    )

    def step(s: Column, t: Column) -> Column:
        last, in_list = F.right(t, F.lit(1)), s["lists"] > 0
        opens, closes = last.isin("{", "["), last.isin("}", "]")
        # Openings inside a list count as lists: only its own scalars are wanted.
        count = F.when(t.isin("{", "["), 1).when(last == "[", 1).otherwise(_keys_that_open(t))
        ends = in_list & (last == "]") & (s["lists"] == 1)
        pushed = F.replace(F.substr(t, F.lit(2), F.length(t) - 4), F.lit('":{"'), F.lit(_SEP))
        below = F.when(s["depth"] == 0, F.lit("")).otherwise(F.concat(s["path"], F.lit(_SEP)))
        key = F.substring_index(F.substr(t, F.lit(2)), '"', 1)
        left = s["depth"] - F.when(ends, 1).otherwise(F.length(t))
        item = F.concat(s["items"], F.when(s["items"] == "[", F.lit("")).otherwise(F.lit(",")), t)
        is_item = (s["lists"] == 1) & ~opens & ~closes & (t != "null")
        up = ends | (~in_list & closes)
        path = (
            F.when(up, F.when(left > 0, F.call_function("substring_index", s["path"], F.lit(_SEP), left)).otherwise(F.lit("")))
            .when(~in_list & (last == "{"), F.concat(below, pushed))
            .when(~in_list & (last == "["), F.concat(below, key))
            .otherwise(s["path"])
        )
        depth = (
            F.when(up, F.greatest(left, F.lit(0)))
            .when(~in_list & opens, s["depth"] + count)
            .otherwise(s["depth"])
        )
        lists = (
            F.when(in_list & opens, s["lists"] + count)
            .when(in_list & closes, s["lists"] - F.length(t))
            .when(~in_list & (last == "["), 1)
            .otherwise(s["lists"])
        )
        items = F.when(~in_list & (last == "["), F.lit("[")).when(is_item, item).otherwise(s["items"])
        leaf = (
            F.when(ends, F.struct(s["path"].alias("key"), F.concat(s["items"], F.lit("]")).alias("text")))
            .when(~in_list & ~opens & ~closes, F.struct(F.concat(below, key).alias("key"), F.substr(t, F.length(key) + 4).alias("text")))
        )
        out = F.when(leaf.isNotNull(), F.concat(s["out"], F.array(leaf))).otherwise(s["out"])
        return F.struct(
            path.alias("path"), depth.cast("int").alias("depth"), lists.cast("int").alias("lists"), items.alias("items"), out.alias("out")
        )

    def entry(leaf: Column) -> Column:
        names = F.when(prefix == "", F.ltrim(leaf["key"], F.lit(_SEP))).otherwise(leaf["key"])
        dotted = F.replace(names, F.lit(_SEP), F.lit("."))
        whole = F.when(F.contains(dotted, F.lit("\\")), as_string(F.parse_json(F.concat(F.lit('"'), dotted, F.lit('"'))))).otherwise(dotted)
        # A decimal has no negative zero; a double has, and is printed like that.
        value = F.parse_json(F.when(leaf["text"] == "-0.0", F.lit("-0e0")).otherwise(leaf["text"]))
        key = F.when(prefix == "", whole).otherwise(F.concat_ws(".", prefix, whole))
        return F.struct(key.alias("key"), value.alias("v"), F.lit(None).cast(FLAT).alias("members"))

    leaves = F.aggregate(F.regexp_extract_all(plain, F.lit(_TOKENS), F.lit(0)), start, step, lambda s: s["out"])
    return F.transform(leaves, entry)


def _keys_that_open(token: Column) -> Column:
    return ((F.length(token) - F.length(F.replace(token, F.lit('":{'), F.lit("")))) / 3).cast("int")


def _braces(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "{", ""))


def _leaf_value(e: Column) -> Column:
    """Scalars as they are, arrays reduced to their scalars, NULL for what is dropped."""

    def value(kind: Column) -> Column:
        items = F.transform(as_items(e["v"]), lambda x: _scalar(x, schema_kind(x)))
        scalars = F.array_compact(items)
        return F.when(
            kind.startswith("ARRAY<"), F.when(F.size(scalars) > 0, F.to_variant_object(scalars))
        ).otherwise(_scalar(e["v"], kind))

    return let(schema_kind(e["v"]), value)


def _scalar(v: Column, kind: Column) -> Column:
    return F.when(is_scalar_kind(kind), normal_number(v, kind))


def with_flat(df: DataFrame, source: str, out: str, levels: int = NATIVE_LEVELS) -> DataFrame:
    """Add ``out``: the VARIANT ``source`` as ``map<string,variant>`` with dotted keys.

    Nulls, empty objects and arrays without scalars vanish; a scalar at the root gets the
    key ``""``; of two equal keys the later in key order stays. Objects are opened to any
    depth. ``levels`` only says how many of them native expressions open.
    """
    opened = fence(df.withColumn(_LEAVES, _opened(F.col(source), levels)), [_LEAVES])
    whole = F.when(F.exists(_LEAVES, _is_open), _opened_to_the_end(F.col(_LEAVES))).otherwise(F.col(_LEAVES))
    values = F.transform(whole, lambda e: F.struct(e["key"].alias("key"), _leaf_value(e).alias("value")))
    flat = F.map_from_entries(F.filter(values, lambda p: p["value"].isNotNull()))
    # Above the fence too: the filter that Spark adds below an explode would open every document again.
    return fence(opened.withColumn(out, flat).drop(_LEAVES), [out])
