"""Row-level constraint checks on JSON records, with a full violation report.

Records are checked as VARIANT, before any projection to a fixed struct, because
a typed read would silently drop unknown keys and null out wrong types. A record
is parsed once into an array of the values that rules speak of, items of lists with
their place among them; each value carries the row of its rule table, and one set of
tests reads both, for records that shape and a few values do not show to be valid at once.
The report explodes what it finds, the gate asks whether it found anything. Nothing is shuffled until a first violation is picked.
"""

from __future__ import annotations

import re
from functools import reduce
from json import dumps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RULES

def _type(tag: Column) -> Column:
    """JSON type name of a VARIANT's schema text; whole-number decimals are integers, booleans are not."""
    return (
        F.when(tag.isNull(), F.lit(None).cast("string"))
        .when(tag == "VOID", "null")
        .when(tag.rlike(r"^(?:BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$"), "integer")
        .when(tag.rlike(r"^(?:DECIMAL|DOUBLE|FLOAT)"), "number")
        .when(tag == "BOOLEAN", "boolean")
        .when(tag == "STRING", "string")
        .when(tag.startswith("ARRAY"), "array")
        .otherwise("object")
    )


def _nodes(spec: dict, path: tuple = (), schema: tuple = ()) -> list[tuple]:
    """(path, schema path, spec) of a record and of every object field below it."""
    out = [(path, schema, spec)]
    for key, child in spec.get("fields", {}).items():
        out += _nodes(child, (*path, key), (*schema, "properties", key))
    return out


def _path(parts) -> str:
    return "$" + "".join(f".{p}" for p in parts)


def _texts(parts) -> Column:
    return F.array(*[F.lit(p) for p in parts]).cast("array<string>")


RULE = (
    "types array<string>, types_text string, const string, allowed array<string>, allowed_text string, min_length int, pattern string, "
    "minimum double, distinct_items boolean, required array<string>, known array<string>, head array<string>, tail array<string>, "
    "head_text string, tail_text string, schema_path array<string>"
)


def rule_table(schema: str) -> tuple[Column, list[tuple], list[tuple]]:
    """The rules of a schema as an array of structs, one for each place of a record, and where the places are.

    A place is a path of the record, or a path of the items of one of its lists: (number, path) and
    (list path, [(number, path in an item)]).
    """
    rules: list[dict] = []
    places, lists = [], []

    def rule(head: tuple, tail: tuple, schema_path: tuple, spec: dict) -> int:
        listed = lambda values: ", ".join(f"'{x}'" for x in values or [])
        kept = {key: spec.get(key) for key in ("types", "const", "min_length", "pattern", "minimum")}
        rules.append(
            kept
            | {
                "types_text": listed(spec.get("types")), "allowed": spec.get("enum"), "allowed_text": listed(spec.get("enum")),
                "distinct_items": bool(spec.get("unique")), "required": spec.get("required", []) if "fields" in spec else [],
                "known": list(spec["fields"]) if spec.get("closed") else None, "head": head, "tail": tail,
                "head_text": _path(head), "tail_text": _path(tail)[1:], "schema_path": schema_path,
            }
        )
        return len(rules) - 1

    for path, schema_path, spec in _nodes(RULES[schema]):
        places.append((rule(path, (), schema_path, spec), path))
        if "items" in spec:
            below = _nodes(spec["items"], (), (*schema_path, "items"))
            lists.append((path, [(rule(path, tail, found, item), tail) for tail, found, item in below]))
    # One short expression, however often it is read: it becomes a constant of the plan.
    return F.from_json(F.lit(dumps(rules)), f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in RULE.split(', '))}>>"), places, lists


def _values(record: Column, places: list[tuple], lists: list[tuple]) -> Column:
    """Every value of a record that a rule speaks of: (number of the rule, place in its list or null, value)."""

    def at(number: int, place: Column, value: Column) -> Column:
        return F.struct(F.lit(number).alias("at"), place.cast("int").alias("place"), value.alias("value"))

    def inside(value: Column, path: tuple) -> Column:
        return F.try_variant_get(value, _path(path), "variant") if path else value

    def of_items(items: list[tuple]):
        return lambda x, i: F.array(*[at(n, i, inside(x, tail)) for n, tail in items])

    found = [F.array(*[at(n, F.lit(None), inside(record, path)) for n, path in places])]
    for path, items in lists:
        each = F.transform(F.try_variant_get(record, _path(path), "array<variant>"), of_items(items))
        found.append(F.coalesce(F.flatten(each), F.array().cast("array<struct<at:int,place:int,value:variant>>")))
    return F.filter(F.concat(*found), lambda x: x["value"].isNotNull())


# Each step adds what the next one reads several times: an expression in a lambda runs anew at each use. A value
# carries the number of its rule only, as steps copy what they carry.


def _tagged(x: Column) -> Column:
    return F.struct(x["at"].alias("at"), x["place"].alias("place"), x["value"].alias("value"), F.schema_of_variant(x["value"]).alias("tag"))


def _kind(x: Column) -> Column:
    return F.struct(x["at"].alias("at"), x["place"].alias("place"), x["value"].alias("value"), _type(x["tag"]).alias("kind"))


def _shown(rules: Column):
    """Add the text of a value, and its keys where the rules name any; a number without fraction is an integer
    where the rule asks for one."""

    def shown(x: Column) -> Column:
        rule, kind = F.get(rules, x["at"]), x["kind"]
        number = F.try_variant_get(x["value"], "$", "double")
        whole = (kind == "number") & F.array_contains(rule["types"], "integer") & (number == F.floor(number))
        asked = (kind == "object") & (rule["known"].isNotNull() | (F.size(rule["required"]) > 0))
        return F.struct(
            x["at"].alias("at"), x["place"].alias("place"), x["value"].alias("value"),
            F.when(whole, F.lit("integer")).otherwise(kind).alias("kind"),
            F.when(kind == "string", x["value"].cast("string")).alias("raw"),
            F.when((kind != "object") & (kind != "string"), F.to_json(x["value"])).alias("json"),
            F.when(asked, F.map_keys(F.try_variant_get(x["value"], "$", "map<string,variant>"))).alias("keys"),
        )

    return shown


def _broken(x: Column, rules: Column, patterns: list[str]) -> Column:
    """The rules that one value breaks: array of (rule, path, json_path, schema_path, message)."""
    rule, kind, raw = F.get(rules, x["at"]), x["kind"], x["raw"]
    shown = F.coalesce(F.concat(F.lit("'"), raw, F.lit("'")), x["json"], F.to_json(x["value"]))
    inside = x["place"].isNotNull()
    path = F.when(inside, F.concat(rule["head"], F.array(x["place"].cast("string")), rule["tail"])).otherwise(rule["head"])
    text = F.when(inside, F.concat(rule["head_text"], F.lit("["), x["place"].cast("string"), F.lit("]"), rule["tail_text"])).otherwise(rule["head_text"])

    def found(name: str, message: Column, key: str) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), path.alias("path"), text.alias("json_path"),
            F.concat(rule["schema_path"], F.array(F.lit(key))).alias("schema_path"), message.alias("message"),
        )

    def test(name: str, failing: Column, message: Column, key: str) -> Column:
        return F.when(F.coalesce(failing, F.lit(False)), found(name, message, key))

    matched = F.lit(True)
    for pattern in patterns:  # a pattern is compiled once only when it is a literal
        # A repeated group at the end gives nothing back: else the engine recurses for each repeat of a long text.
        matched = F.when(rule["pattern"] == pattern, raw.rlike(pattern.replace(")*$", ")*+$"))).otherwise(matched)
    number = F.try_variant_get(x["value"], "$", "double")
    listed = F.transform(F.try_variant_get(x["value"], "$", "array<variant>"), lambda i: F.to_json(i))
    extra = F.array_sort(F.array_except(x["keys"], rule["known"]))
    verb = F.when(F.size(extra) == 1, " was unexpected)").otherwise(" were unexpected)")
    names = F.concat(F.lit("Additional properties are not allowed ('"), F.array_join(extra, "', '"), F.lit("'"), verb)
    ends = lambda words, more=F.lit(""): F.concat(shown, F.lit(words), more)
    tests = [
        test("type", rule["types"].isNotNull() & ~F.array_contains(rule["types"], kind), ends(" is not of type ", rule["types_text"]), "type"),
        test("const", rule["const"].isNotNull() & ~raw.eqNullSafe(rule["const"]), F.concat(F.lit("'"), rule["const"], F.lit("' was expected")), "const"),
        test("enum", rule["allowed"].isNotNull() & ~F.coalesce(F.array_contains(rule["allowed"], raw), F.lit(False)), ends(" is not one of [", F.concat(rule["allowed_text"], F.lit("]"))), "enum"),
        test("min_length", F.char_length(raw) < rule["min_length"], ends(" should be non-empty"), "minLength"),
        test("pattern", ~matched, ends(" does not match '", F.concat(rule["pattern"], F.lit("'"))), "pattern"),
        test("minimum", kind.isin("integer", "number") & (number < rule["minimum"]), ends(" is less than the minimum of ", _number(rule["minimum"])), "minimum"),
        test("unique", rule["distinct_items"] & (kind == "array") & (F.size(F.array_distinct(listed)) < F.size(listed)), ends(" has non-unique elements"), "uniqueItems"),
        test("extra_keys", rule["known"].isNotNull() & (F.size(extra) > 0), names, "additionalProperties"),
    ]
    missing = F.when(kind == "object", F.array_except(rule["required"], x["keys"]))
    absent = F.transform(missing, lambda k: found("required", F.concat(F.lit("'"), k, F.lit("' is a required property")), "required"))
    return F.concat(F.array_compact(F.array(*tests)), F.coalesce(absent, F.array().cast(FOUND)))


def _number(c: Column) -> Column:
    """A limit as it is written in the rules: whole numbers without a fraction."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


FOUND = "array<struct<rule:string,path:array<string>,json_path:string,schema_path:array<string>,message:string>>"


# The text of any JSON shape without odd keys (quoted ones), nested three deep at most; nothing in it is tried twice.
ANY = r"[^<>`]*+"
for _ in range(3):
    ANY = rf"[^<>`]*+(?:<{ANY}>[^<>`]*+)*+"
SHAPES = {"string": "STRING", "null": "VOID", "integer": "BIGINT", "boolean": "BOOLEAN", "object": f"OBJECT<{ANY}>"}


def _shape(spec: dict) -> str:
    """Pattern of VARIANT schema texts (keys in order) that break no rule on types and keys; a list may only be empty."""
    if "fields" in spec and not spec.get("closed"):
        return r"(?!)"
    if "fields" in spec:
        keys = []
        for key, child in sorted(spec["fields"].items()):
            pattern = rf"{re.escape(key)}: {_shape(child)}(?:, |(?=>))"
            keys.append(pattern if key in spec.get("required", []) else f"(?:{pattern})?")
        return f"OBJECT<{''.join(keys)}>" if set(spec.get("required", [])) <= set(spec["fields"]) else r"(?!)"
    if "items" in spec:
        return r"ARRAY<VOID>"
    told = "const" in spec or "enum" in spec
    return "(?:" + "|".join(SHAPES.get(t, r"(?!)") for t in (["string"] if told else spec.get("types", ["string"]))) + ")"


def _surely_valid(record: Column, schema: str) -> Column:
    """True only for records that break no rule: most records are told by their shape and a few values.

    A record with a filled list, a decimal or an odd key may be valid without it; all rules are tested then.
    """
    tests = [F.schema_of_variant(record).rlike(rf"\A{_shape(RULES[schema])}\z")]
    for path, _, spec in _nodes(RULES[schema]):
        text = F.try_variant_get(record, _path(path), "string") if path else F.lit(None).cast("string")
        if "const" in spec:
            tests.append(text == spec["const"])
        if "enum" in spec:
            tests.append(text.isin(spec["enum"]))
        if "min_length" in spec:
            tests.append(F.char_length(text) >= spec["min_length"])
        if "pattern" in spec:
            tests.append(text.rlike(spec["pattern"].replace(")*$", ")*+$")))
        if "minimum" in spec:
            tests.append(F.try_variant_get(record, _path(path), "double") >= spec["minimum"])
        if "items" in spec:
            tests.append(F.size(F.try_variant_get(record, _path(path), "array<variant>")) == 0)
    # A value that is absent (or null, where its type allows that) breaks no rule on values.
    return reduce(Column.__and__, [F.coalesce(test, F.lit(True)) for test in tests])


def checked(df: DataFrame, schema: str, json: str = "json") -> DataFrame:
    """``df`` with ``_record`` (VARIANT) and ``_broken``: all rules that a JSON record breaks, in one pass, without a shuffle.

    Unparsable text (or a repeated key) breaks ``malformed_json``. A record is valid when the array is empty:
    the gate and the report read this one column.
    """
    rules, places, lists = rule_table(schema)
    patterns = sorted(_patterns(RULES[schema]))
    parsed = df.withColumn("_record", F.try_parse_json(F.col(json)))
    # A one-element explode keeps the steps apart: collapsed into one expression they would run again for each use.
    values = F.transform(F.transform(_values(F.col("_record"), places, lists), _tagged), _kind)
    values = F.transform(values, _shown(rules))
    broken = F.flatten(F.transform(values, lambda x: _broken(x, rules, patterns)))
    malformed = F.array(
        F.struct(
            F.lit("malformed_json").alias("rule"), _texts([]).alias("path"), F.lit("$").alias("json_path"),
            _texts([]).alias("schema_path"), F.lit("expected a JSON object").alias("message"),
        )
    )
    none = F.array().cast(FOUND)
    told = F.when(F.col("_record").isNull(), malformed).when(_surely_valid(F.col("_record"), schema), none).otherwise(broken)
    once = F.explode(F.array(told)).alias("_broken")
    return parsed.select("*", once)


def _patterns(spec: dict) -> set[str]:
    own = {spec["pattern"]} if "pattern" in spec else set()
    for child in [*spec.get("fields", {}).values(), *([spec["items"]] if "items" in spec else [])]:
        own |= _patterns(child)
    return own


def violations(
    df: DataFrame, schema: str, json: str = "json", rules: list[str] | None = None, key: str | None = None
) -> DataFrame:
    """All violations of a JSON column: object_id, rule, paths and message.

    Unparsable text (or a repeated key) is reported as ``malformed_json``; an
    object without an id is reported under ``<unknown>``. ``key`` names a column of
    ``df`` that tells records apart, whatever their ids; it is carried along.
    """
    carry = [] if key is None else [key]
    name = F.coalesce(F.try_variant_get("_record", "$.id", "string"), F.lit("<unknown>"))
    rows = checked(df.select(json, *carry), schema, json).select(name.alias("object_id"), *carry, F.explode("_broken").alias("_x"))
    found = rows.select("object_id", *carry, "_x.*", F.lit(schema).alias("schema_name"))
    return found if rules is None else found.filter(F.col("rule").isin(rules))


def first_violations(found: DataFrame, key: str = "object_id") -> DataFrame:
    """First violation per record by (path, schema path), compared part by part as text.

    ``key`` tells records apart; the object id only does where every record has its own.
    """
    rest = F.struct("object_id", "json_path", "schema_path", "message", "rule", "schema_name")
    first = found.groupBy(F.col(key).alias("_key")).agg(F.min_by(rest, F.struct("path", "schema_path", "message")).alias("_x"))
    names = ["_x.*"] if key == "object_id" else [F.col("_key").alias(key), "_x.*"]
    return first.select(*names)


def flagged(df: DataFrame, schema: str, json: str = "json") -> DataFrame:
    """Input rows with a boolean ``is_valid`` column: no rule is broken."""
    return checked(df, schema, json).select(*df.columns, (F.size("_broken") == 0).alias("is_valid"))


def split_valid(df: DataFrame, schema: str, json: str = "json") -> tuple[DataFrame, DataFrame]:
    """(valid rows, violations)."""
    valid = flagged(df, schema, json).filter("is_valid").drop("is_valid")
    return valid, violations(df, schema, json)


def require_valid(df: DataFrame, schema: str, json: str = "json") -> DataFrame:
    """Strict gate: raises on any violation, naming one of them."""
    bad = violations(df, schema, json).limit(1).collect()
    if bad:
        row = bad[0]
        raise ValueError(f"{row.object_id}: {row.json_path}: {row.message} [{schema}]")
    return df
