"""Canonical record shapes and their validation rules, as data."""

from __future__ import annotations

SCHEMA_VERSION = "1.0"

KNOWLEDGE_DDL = """schema_version STRING, id STRING, title STRING, slug STRING, status STRING,
    content STRUCT<format: STRING, body: STRING, summary: STRING, language: STRING>,
    source STRUCT<connector: STRING, external_id: STRING, url: STRING, space: STRING,
                  parent_external_id: STRING, revision: STRING>,
    timestamps STRUCT<created_at: STRING, updated_at: STRING, ingested_at: STRING>,
    taxonomy STRUCT<category: STRING, tags: ARRAY<STRING>, products: ARRAY<STRING>, audiences: ARRAY<STRING>>,
    assets ARRAY<STRING>, relationships ARRAY<STRUCT<type: STRING, target_id: STRING>>,
    checksums STRUCT<source: STRING, content: STRING>, extensions VARIANT"""

ASSET_DDL = """schema_version STRING, id STRING, filename STRING, media_type STRING, size_bytes BIGINT,
    sha256 STRING, local_path STRING,
    source STRUCT<connector: STRING, external_id: STRING, container_external_id: STRING, url: STRING>,
    status STRING, extensions VARIANT"""

# ---- validation rules -----------------------------------------------------
# A rule set lists, per object path, its required keys and its known fields; a
# field is described by the types it may have and its value constraints.

STRING = {"types": ["string"]}
FILLED = {"types": ["string"], "min_length": 1}
COUNT = {"types": ["integer"], "minimum": 0}
TEXT_LIST = {"types": ["array"], "unique": True, "items": FILLED}

# Constraints the canonical records must meet.
SLUG_PATTERN = "^[a-z0-9]+(?:-[a-z0-9]+)*$"
SHA256_PATTERN = "^[a-f0-9]{64}$"
ARTICLE_STATUS = ["draft", "review", "published", "archived"]
CONTENT_FORMATS = ["markdown", "html", "plain_text"]
AUDIENCES = ["customer", "support", "developer", "internal", "partner"]
RELATION_TYPES = ["parent", "child", "related", "references", "supersedes", "duplicate_of"]
ASSET_STATUS = ["available", "missing", "failed"]
HASH = {"types": ["string"], "pattern": SHA256_PATTERN}


def record(required: list[str], fields: dict, closed: bool = True) -> dict:
    """An object: keys it must have, fields it may have, extra keys refused when closed."""
    return {"types": ["object"], "required": required, "fields": fields, "closed": closed}


# Names and order that consumers read.
KNOWLEDGE_RULES = record(["schema_version", "id", "title", "slug", "status", "content", "source", "timestamps"],
    {
        "schema_version": {"types": ["string"], "const": SCHEMA_VERSION},
        "id": FILLED,
        "title": FILLED,
        "slug": {"types": ["string"], "min_length": 1, "pattern": SLUG_PATTERN},
        "status": {"types": ["string"], "enum": ARTICLE_STATUS},
        "content": record(
            ["format", "body"],
            {
                "format": {"types": ["string"], "enum": CONTENT_FORMATS},
                "body": STRING,
                "summary": STRING,
                "language": STRING,
            },
        ),
        "source": record(
            ["connector", "external_id"],
            {
                "connector": FILLED,
                "external_id": FILLED,
                "url": STRING,
                "space": STRING,
                "parent_external_id": {"types": ["string", "null"]},
                "revision": {"types": ["string", "integer", "null"]},
            },
        ),
        "timestamps": record(
            ["ingested_at"],
            {
                "created_at": {"types": ["string", "null"]},
                "updated_at": {"types": ["string", "null"]},
                "ingested_at": STRING,
            },
        ),
        "taxonomy": record(
            [],
            {
                "category": {"types": ["string", "null"]},
                "tags": TEXT_LIST,
                "products": TEXT_LIST,
                "audiences": {
                    "types": ["array"],
                    "unique": True,
                    "items": {"types": ["string"], "enum": AUDIENCES},
                },
            },
        ),
        "assets": TEXT_LIST,
        "relationships": {
            "types": ["array"],
            "items": record(
                ["type", "target_id"],
                {"type": {"types": ["string"], "enum": RELATION_TYPES}, "target_id": FILLED},
            ),
        },
        "checksums": record([], {"source": STRING, "content": STRING}),
        "extensions": {"types": ["object"]},
    },
)

# Names and order that consumers read.
ASSET_RULES = record(["schema_version", "id", "filename", "media_type", "size_bytes", "sha256", "local_path", "source", "status"],
    {
        "schema_version": {"const": SCHEMA_VERSION},
        "id": FILLED,
        "filename": FILLED,
        "media_type": FILLED,
        "size_bytes": COUNT,
        "sha256": HASH,
        "local_path": FILLED,
        "status": {"enum": ASSET_STATUS},
        "source": record(["connector", "external_id", "container_external_id", "url"],
            {"connector": FILLED, "external_id": FILLED, "container_external_id": FILLED, "url": STRING},
        ),
        "extensions": {"types": ["object"]},
    },
)

# Names and order that consumers read.
INVENTORY_RULES = record(["schema_version", "connector", "generated_at", "item_count", "items"],
    {
        "schema_version": {"const": SCHEMA_VERSION},
        "connector": FILLED,
        "generated_at": STRING,
        "root_page_id": {"types": ["string", "null"]},
        "space_id": {"types": ["string", "null"]},
        "item_count": COUNT,
        "items": {"types": ["array"], "items": {"types": ["object"]}},
    },
)

# Names and order that consumers read.
MANIFEST_RULES = record(
    ["schema_version", "connector", "generated_at", "root_page_id", "space_id", "object_count", "asset_count", "objects", "assets", "crawl_successful", "failures"],
    {
        "schema_version": {"const": SCHEMA_VERSION},
        "connector": FILLED,
        "generated_at": STRING,
        "root_page_id": FILLED,
        "space_id": FILLED,
        "object_count": COUNT,
        "asset_count": COUNT,
        "objects": TEXT_LIST,
        "assets": TEXT_LIST,
        "crawl_successful": {"types": ["boolean"]},
        "failures": {"types": ["array"], "items": {"types": ["object"]}},
    },
)

# Names and order that consumers read.
PUBLISHER_MANIFEST_RULES = record(
    ["schema_version", "publisher", "generated_at", "source_connector", "article_count", "asset_count", "articles", "assets", "issues"],
    {
        "schema_version": {"const": SCHEMA_VERSION},
        "publisher": FILLED,
        "generated_at": STRING,
        "source_connector": FILLED,
        "article_count": COUNT,
        "asset_count": COUNT,
        "articles": {
            "types": ["array"],
            "items": record(["id", "title", "path", "sha256"], {"id": FILLED, "title": FILLED, "path": FILLED, "sha256": HASH}
            ),
        },
        "assets": {
            "types": ["array"],
            "items": record(["id", "path", "sha256", "size_bytes"],
                {"id": FILLED, "path": FILLED, "sha256": HASH, "size_bytes": COUNT},
            ),
        },
        "issues": {"types": ["array"], "items": STRING},
    },
)

RULES = {
    "knowledge": KNOWLEDGE_RULES,
    "asset": ASSET_RULES,
    "inventory": INVENTORY_RULES,
    "manifest": MANIFEST_RULES,
    "publisher-manifest": PUBLISHER_MANIFEST_RULES,
}
