"""Scan-state documents as variants, so that keys outside any fixed schema survive a rewrite."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposure.schemas import PHASES, STATISTICS

OBJECT = "map<string, variant>"

# What a new or repaired document holds.
PENDING_PHASE = {"status": "pending", "progress_percentage": 0, "results_count": 0}
DEFAULT_PHASES = {phase: PENDING_PHASE for phase in PHASES}
DEFAULT_STATISTICS = {name: 0 for name in STATISTICS}
DEFAULT_ENVIRONMENT = {"tool_versions": {}, "templates_hash": ""}


def body_of(doc: Column) -> Column:
    """Top-level keys of a JSON object; null for broken JSON and for anything but an object.

    The parser stops after one value. Text behind it is found by parsing the document inside an
    object and inside an array: no text but white space can continue both. A key that comes twice
    makes a document broken.
    """
    inside = F.try_parse_json(F.concat(F.lit('{"d":'), doc, F.lit("}")))
    alone = F.try_parse_json(F.concat(F.lit("["), doc, F.lit("]"))).isNotNull()
    return F.when(alone, F.try_variant_get(inside, "$.d", OBJECT))


def object_at(body: Column, key: str) -> Column:
    """The keys of a nested object, null when it is absent or not an object."""
    return F.try_variant_get(F.element_at(body, F.lit(key)), "$", OBJECT)


def text_at(body: Column, key: str) -> Column:
    return F.try_variant_get(F.element_at(body, F.lit(key)), "$", "string")


def has_key(body: Column, key: str) -> Column:
    """A key counts as present even when its value is JSON null."""
    return F.coalesce(F.map_contains_key(body, F.lit(key)), F.lit(False))


def json_object(value: dict) -> Column:
    """A literal JSON object as key -> variant."""
    return F.variant_get(F.parse_json(F.lit(json.dumps(value))), "$", OBJECT)


def json_literal(value) -> Column:
    return F.parse_json(F.lit(json.dumps(value)))


def text_variant(text: Column) -> Column:
    return text.cast("variant")


def iso_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def scan_identity(domain: Column, moment: Column) -> Column:
    """``domain-epoch-xxxxxxxx`` where the suffix hashes the first two parts."""
    stem = F.concat_ws("-", domain, epoch_seconds(moment).cast("string"))
    return F.concat_ws("-", stem, F.substring(F.md5(stem), 1, 8))


# Zone-less timestamps are read as UTC, whatever the session's time zone is.

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970."""
    return F.timestamp_diff("SECOND", _epoch(), moment.cast("timestamp_ntz"))


def epoch_micros(moment: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), moment.cast("timestamp_ntz"))


def from_epoch(seconds: Column) -> Column:
    """Seconds since 1970, with fractions, as a timestamp."""
    return F.timestamp_add("MICROSECOND", (seconds * 1e6).cast("bigint"), _epoch())
