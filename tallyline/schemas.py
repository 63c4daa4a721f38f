"""Explicit schemas of the two message kinds."""

from __future__ import annotations

# The top-level fields a change message may have.
CDC_FIELDS = ["before", "after", "source", "op", "ts_ms", "transaction"]

# `before`, `op` and `transaction` accept any JSON value and are never read, so they are not materialised.
# `after` names only the three fields that are used; the rest of the row image is skipped by the parser.
# `ts_ms` is text because a quoted number is as good as a plain one.
CDC_SCHEMA = (
    "after STRUCT<branch_id_no: STRING, sku_no: STRING, value: STRING>, "
    "source STRUCT<>, ts_ms STRING, _malformed STRING"
)

WEB_SCHEMA = "uid STRING, experiment_id STRING, variant STRING, timestamp STRING, _malformed STRING"

# Standard JSON only, and a broken document keeps its text in `_malformed`.
JSON_OPTIONS = {
    "columnNameOfCorruptRecord": "_malformed",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Fixed value: yyyy-MM-ddTHH:mm:ssZ, UTC, whole seconds.
WEB_TIMESTAMP_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
