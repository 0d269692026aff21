"""Declared schemas. Nothing is inferred; a missing field reads as NULL."""

FILES = "path STRING, filename STRING, content BINARY"

MANIFEST = (
    "output_metadata ARRAY<STRUCT<segment_metadata ARRAY<STRUCT<standard_output_path STRING>>>>, "
    "semantic_modality STRING"
)

_REPRESENTED = "STRUCT<transcript STRUCT<representation STRUCT<text STRING>>>"
SEGMENTS = (
    f"ARRAY<STRUCT<audio {_REPRESENTED}, video {_REPRESENTED}, "
    "chapters ARRAY<STRUCT<summary STRING>>, "
    "pages ARRAY<STRUCT<representation STRUCT<markdown STRING, text STRING>>>, "
    "image STRUCT<summary STRING, text_lines ARRAY<STRUCT<text STRING>>>>>"
)

BLOCKS = (
    "doc_key STRING, pos INT, id STRING, block_type STRING, text STRING, "
    "relationships ARRAY<STRUCT<type STRING, ids ARRAY<STRING>>>, "
    "entity_types ARRAY<STRING>, selection_status STRING"
)

CACHE_ENTRY = "text STRING, modality STRING, extractor STRING, metadata MAP<STRING, STRING>"
CACHE = "cache_key STRING, entry STRING, schema_tag STRING, mode STRING"

TURNS = (
    "actor_id STRING, session_id STRING, seq BIGINT, ts TIMESTAMP, role STRING, text STRING, "
    "expires_at TIMESTAMP"
)
FACT_BATCH = "ARRAY<STRUCT<content STRING>>"

SCREENING = "action STRING, outputs ARRAY<STRUCT<text STRING>>, assessments ARRAY<STRING>"
