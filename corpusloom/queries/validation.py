"""Validation rules over JSON records with defects that depend on their source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validate as V
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles

# A canonical record per document; some sources deliver one kind of defect each.


def records(v):
    a = v.v_article.withColumn("slug", F.expr("concat('doc-', external_id)"))
    space = F.col("space")

    def broken(source: str, bad: str, good: str) -> str:
        return f"CASE WHEN space = '{source}' THEN {bad} ELSE {good} END"

    text = lambda c: f"to_json(named_struct('x', {c}))"
    quoted = lambda c: f"substring({text(c)}, 6, length({text(c)}) - 6)"
    parts = [
        "'{\"schema_version\": '", broken("src1", "'\"2.0\"'", "'\"1.0\"'"),
        broken("src2", "''", "concat(', \"id\": ', " + quoted("id") + ")"),
        broken("src3", "''", "concat(', \"title\": ', " + quoted("concat('T', title)") + ")"),
        "', \"slug\": '", broken("src4", "'\"Not A Slug\"'", "concat('\"', slug, '\"')"),
        "', \"status\": '", broken("src5", "'\"public\"'", broken("src6", "'7'", "'\"published\"'")),
        "', \"content\": {\"format\": \"html\", \"body\": '", quoted("body"), broken("src7", "', \"extra\": 1, \"also\": 2}'", "'}'"),
        "', \"source\": {\"connector\": '", broken("src8", "'\"\"'", "'\"wiki\"'"), "', \"external_id\": '", broken("src9", "external_id", "concat('\"', external_id, '\"')"),
        "', \"revision\": '", "CASE space WHEN 'src10' THEN '1.5' WHEN 'src11' THEN 'null' WHEN 'src12' THEN '3' ELSE '\"r\"' END",
        "'}, \"timestamps\": {\"ingested_at\": \"2026-01-01T00:00:00+00:00\"}'",
        "', \"assets\": [\"a\", '", broken("src13", "'\"a\"'", broken("src14", "'\"\"'", "'\"b\"'")), "']'",
        "', \"relationships\": [{\"type\": '", broken("src15", "'\"friend\"'", "'\"child\"'"), "', \"target_id\": \"x\"}'", broken("src16", "', {\"type\": \"child\"}'", "''"), "']'",
        broken("src17", "', \"unknown\": true'", "''"), broken("src18", "', \"extensions\": []'", "''"),
        "'}'",
    ]
    return a.select(F.expr("concat(" + ", ".join(parts) + ")").alias("json"), "id", space)


EXPECTED = {
    "src1": ("const", "$.schema_version", "'1.0' was expected"),
    "src2": ("required", "$", "'id' is a required property"),
    "src3": ("required", "$", "'title' is a required property"),
    "src4": ("pattern", "$.slug", "'Not A Slug' does not match '^[a-z0-9]+(?:-[a-z0-9]+)*$'"),
    "src5": ("enum", "$.status", "'public' is not one of ['draft', 'review', 'published', 'archived']"),
    "src6": ("type", "$.status", "7 is not of type 'string'"),
    "src7": ("extra_keys", "$.content", "Additional properties are not allowed ('also', 'extra' were unexpected)"),
    "src8": ("min_length", "$.source.connector", "'' should be non-empty"),
    "src9": ("type", "$.source.external_id", None),
    "src10": ("type", "$.source.revision", "1.5 is not of type 'string', 'integer', 'null'"),
    "src13": ("unique", "$.assets", '["a","a"] has non-unique elements'),
    "src14": ("min_length", "$.assets[1]", "'' should be non-empty"),
    "src15": ("enum", "$.relationships[0].type", "'friend' is not one of ['parent', 'child', 'related', 'references', 'supersedes', 'duplicate_of']"),
    "src16": ("required", "$.relationships[1]", "'target_id' is a required property"),
    "src17": ("extra_keys", "$", "Additional properties are not allowed ('unknown' was unexpected)"),
    "src18": ("type", "$.extensions", "[] is not of type 'object'"),
}
# A status of the wrong type is also not one of the allowed values.
MORE = [("src6", "enum", "$.status", "7 is not one of ['draft', 'review', 'published', 'archived']")]


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ROWS = [(s, r, p, m) for s, (r, p, m) in EXPECTED.items()] + MORE
FOUND_SQL = "found AS (" + " UNION ALL ".join(
    f"SELECT CASE WHEN space = 'src2' THEN '<unknown>' ELSE id END AS object_id, '{rule}' AS rule, '{path}' AS json_path, "
    + (_literal(message) if message else "external_id || ' is not of type ''string'''")
    + f" AS message, space FROM {{v_article}} WHERE space = '{space}'"
    for space, rule, path, message in ROWS
) + ")"


def _rules_sql(*rules: str) -> str:
    listed = ", ".join(f"'{r}'" for r in rules)
    return f"WITH {FOUND_SQL} SELECT f.object_id, f.rule, f.json_path, f.message FROM found f WHERE f.rule IN ({listed})"


def _found(v, *rules):
    return V.violations(records(v), "knowledge", rules=list(rules)).select("object_id", "rule", "json_path", "message")


@reg.query("validate_required", _rules_sql("required"))
def validate_required(v):
    return _found(v, "required")


@reg.query("validate_types", _rules_sql("type"))
def validate_types(v):
    return _found(v, "type")


@reg.query("validate_enums", _rules_sql("const", "enum"))
def validate_enums(v):
    return _found(v, "const", "enum")


@reg.query("validate_patterns", _rules_sql("pattern", "min_length", "minimum"))
def validate_patterns(v):
    return _found(v, "pattern", "min_length", "minimum")


@reg.query("validate_extra_keys", _rules_sql("extra_keys"))
def validate_extra_keys(v):
    return _found(v, "extra_keys")


@reg.query("validate_unique", _rules_sql("unique"))
def validate_unique(v):
    return _found(v, "unique")


@reg.query(
    "first_violation",
    f"WITH {FOUND_SQL} SELECT object_id, json_path, rule, message FROM found f WHERE NOT (space = 'src6' AND rule = 'type')",
)
def first_violation(v):
    return V.first_violations(V.violations(records(v), "knowledge", key="id"), "id").select("object_id", "json_path", "rule", "message")


@reg.query("validate_gate", "SELECT id FROM {v_article} WHERE space IN ('src0', 'src11', 'src12', 'src19')")
def validate_gate(v):
    valid, _ = V.split_valid(records(v), "knowledge")
    return valid.select("id")
