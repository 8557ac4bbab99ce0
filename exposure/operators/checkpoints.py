"""Scan-state documents: read, check, repair, compact, merge.

``documents`` are rows (scan_id, doc) with the JSON text. Rewrites work on variants so that keys
this module does not know stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exposure.functions import text
from exposure.functions.documents import (
    DEFAULT_ENVIRONMENT, DEFAULT_PHASES, DEFAULT_STATISTICS, OBJECT, body_of, has_key,
    iso_time, json_literal, json_object, object_at, scan_identity, text_at, text_variant,
)
from exposure.operators.joins import WAYS, lookup_join
from exposure.schemas import (
    PHASES, REQUIRED_FIELDS, REQUIRED_PHASE_FIELDS, SNAPSHOTS_KEPT,
    STATISTICS,
)

# The texts of integrity issues.
NOT_READABLE = "Checkpoint not initialized"
MISSING_FIELD = "Missing required field: "
MISSING_PHASE = "Missing phase: "
MISSING_PHASE_FIELD = {
    "status": "Missing status in phase: ",
    "progress_percentage": "Missing progress percentage in phase: ",
    "results_count": "Missing results count in phase: ",
}
MISSING_STATISTIC = "Missing statistic: "
MISSING_TOOL_VERSIONS = "Missing tool versions in environment"
DOMAIN_MISMATCH = "Domain mismatch: %s (checkpoint) vs %s (current)"


# --- reading ---------------------------------------------------------------------------------

POSITION = ("batch_index", "batch_size", "progress")


def _at(record: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", kind)


def _position(record: Column) -> Column:
    """A phase's saved position; it may sit one level too deep."""
    return F.when(
        _at(record, "checkpoint", "variant").isNotNull(),
        F.struct(*[
            F.coalesce(
                _at(record, f"checkpoint.checkpoint.{name}", "int"),
                _at(record, f"checkpoint.{name}", "int"),
            ).alias(name)
            for name in POSITION
        ]),
    )


def load_checkpoints(documents: DataFrame) -> DataFrame:
    """Typed view of each document with ``load_status``: loaded, missing, corrupt or no_scan_id.

    A null or broken document gives a row with nulls, never a failure, and one odd value leaves the
    values beside it alone. ``held_phases`` and ``held_statistics`` are the names an update may
    change, ``has_environment`` says whether there is one to change. Other columns are kept.
    """
    opened = documents.withColumn("_body", body_of(F.col("doc"))).withColumns({
        f"_{part}": object_at(F.col("_body"), part)
        for part in ("phases", "statistics", "environment")
    })
    phases = F.transform_values("_phases", lambda _, record: F.struct(
        _at(record, "status", "string").alias("status"),
        _at(record, "progress_percentage", "int").alias("progress_percentage"),
        _at(record, "results_count", "bigint").alias("results_count"),
        _position(record).alias("checkpoint"),
    ))
    objects = F.map_filter(
        "_phases", lambda _, record: F.try_variant_get(record, "$", OBJECT).isNotNull()
    )
    statistics = F.struct(*[
        F.try_variant_get(F.try_element_at("_statistics", F.lit(name)), "$", "bigint").alias(name)
        for name in STATISTICS
    ])
    environment = F.struct(
        F.try_variant_get(
            F.try_element_at("_environment", F.lit("tool_versions")), "$", "map<string,string>"
        ).alias("tool_versions"),
        text_at(F.col("_environment"), "templates_hash").alias("templates_hash"),
    )
    return opened.select(
        *documents.columns,
        F.when(F.col("doc").isNull(), "missing")
        .when(F.col("_body").isNull(), "corrupt")
        .when(~has_key(F.col("_body"), "scan_id"), "no_scan_id")
        .otherwise("loaded").alias("load_status"),
        text_at(F.col("_body"), "scan_id").alias("checkpoint_id"),
        *[text_at(F.col("_body"), name).alias(name)
          for name in ("domain", "start_time", "last_update", "status")],
        phases.alias("phases"),
        F.when(F.col("_statistics").isNotNull(), statistics).alias("statistics"),
        F.when(F.col("_environment").isNotNull(), environment).alias("environment"),
        F.map_keys(objects).alias("held_phases"),
        F.map_keys("_statistics").alias("held_statistics"),
        F.col("_environment").isNotNull().alias("has_environment"),
    )


def scan_summary(loaded: DataFrame) -> DataFrame:
    """Identity, times, status, phase -> status, statistics."""
    return loaded.filter("load_status = 'loaded'").select(
        "scan_id", "checkpoint_id", "domain", "start_time", "last_update", "status",
        F.transform_values("phases", lambda _, record: record["status"]).alias("phase_status"),
        "statistics",
    )


def phase_table(loaded: DataFrame) -> DataFrame:
    """One display row per scan and phase."""
    return (
        loaded.filter("load_status = 'loaded'")
        .select("scan_id", F.explode("phases").alias("phase", "record"))
        .select(
            "scan_id", "phase", text.title_label(F.col("phase")).alias("phase_label"),
            text.title_status(F.col("record.status")).alias("status_label"),
            F.concat(F.col("record.progress_percentage").cast("string"), F.lit("%"))
            .alias("progress"),
            F.col("record.results_count").alias("results"),
        )
    )


def statistics_table(loaded: DataFrame) -> DataFrame:
    """One display row per scan and statistic that the document holds."""
    held = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col("statistics")[name].alias("value"))
        for name in STATISTICS
    ])
    return (
        loaded.filter("load_status = 'loaded'").select("scan_id", F.inline(held))
        .filter(F.col("value").isNotNull())
        .select("scan_id", text.title_label(F.col("metric")).alias("metric"), "value")
    )


def phase_record(loaded: DataFrame, phase: str) -> DataFrame:
    """One phase of every scan; nulls where the document does not hold it."""
    record = F.try_element_at("phases", F.lit(phase))
    return loaded.select("scan_id", F.lit(phase).alias("phase"), *[
        record[name].alias(name) for name in (*REQUIRED_PHASE_FIELDS, "checkpoint")
    ])


def pending_list(
    phases: Column, resuming: bool = True, force_phase: str | None = None,
) -> Column:
    """Phases still to run, in running order, as an array of (position, phase, status).

    ``force_phase`` and all later phases are to run whatever their status.
    """
    if force_phase is not None and force_phase not in PHASES:
        raise ValueError(f"unknown phase {force_phase!r}: one of {', '.join(PHASES)}")
    listed = F.array(*[
        F.struct(
            F.lit(position).cast("int").alias("position"), F.lit(phase).alias("phase"),
            F.try_element_at(phases, F.lit(phase))["status"].alias("status"),
        )
        for position, phase in enumerate(PHASES, start=1)
    ])
    if not resuming:
        return listed
    forced = len(PHASES) + 1 if force_phase is None else PHASES.index(force_phase) + 1
    return F.filter(listed, lambda entry: (entry["position"] >= forced)
                    | ~entry["status"].eqNullSafe("completed"))


def pending_phases(
    loaded: DataFrame, resuming: bool = True, force_phase: str | None = None,
) -> DataFrame:
    """One row per phase still to run; a fresh run has all of them to do."""
    return loaded.select(
        "scan_id", F.inline(pending_list(F.col("phases"), resuming, force_phase)))


# --- integrity and repair --------------------------------------------------------------------

def _names(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(name) for name in names])


def _absent(body: Column, names: tuple[str, ...]) -> Column:
    """The required names a JSON object does not hold, in the order they are required."""
    held = F.coalesce(F.map_keys(body), F.array().cast("array<string>"))
    return F.array_except(_names(names), held)


def _phase_issues(phase: str) -> Column:
    """A missing phase, or the fields missing in it."""
    messages = F.create_map(*[
        F.lit(part) for pair in MISSING_PHASE_FIELD.items() for part in pair
    ])
    return F.when(
        ~has_key(F.col("_phases"), phase), F.array(F.lit(MISSING_PHASE + phase))
    ).otherwise(
        F.transform(
            _absent(F.col(f"_{phase}"), REQUIRED_PHASE_FIELDS),
            lambda name: F.concat(F.element_at(messages, name), F.lit(phase)),
        )
    )


def checkpoint_issues(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Everything wrong with each document, as a list, and whether it is valid.

    ``documents`` also has ``expected_domain``; columns named in ``keep`` are kept. Nested parts
    are looked at only once all top-level fields are there.
    """
    opened = documents.withColumn("_body", body_of(F.col("doc"))).withColumns({
        f"_{part}": object_at(F.col("_body"), part)
        for part in ("phases", "statistics", "environment")
    }).withColumns({
        f"_{phase}": object_at(F.col("_phases"), phase) for phase in PHASES
    }).withColumn("_top", _absent(F.col("_body"), REQUIRED_FIELDS))

    def listed(absent: Column, message: str) -> Column:
        return F.transform(absent, lambda name: F.concat(F.lit(message), name))

    def only_if(condition: Column, message: Column) -> Column:
        return F.when(condition, F.array(message)).otherwise(F.array().cast("array<string>"))

    found_domain = F.coalesce(text_at(F.col("_body"), "domain"), F.lit("None"))
    nested = F.concat(
        only_if(
            found_domain != F.col("expected_domain"),
            F.format_string(DOMAIN_MISMATCH, found_domain, F.col("expected_domain")),
        ),
        *[_phase_issues(phase) for phase in PHASES],
        listed(_absent(F.col("_statistics"), STATISTICS), MISSING_STATISTIC),
        only_if(
            ~has_key(F.col("_environment"), "tool_versions"), F.lit(MISSING_TOOL_VERSIONS)
        ),
    )
    issues = (
        F.when(F.coalesce(F.size("_body"), F.lit(0)) <= 0, F.array(F.lit(NOT_READABLE)))
        .when(F.size("_top") > 0, listed(F.col("_top"), MISSING_FIELD))
        .otherwise(nested)
    )
    return (
        opened.select("scan_id", *keep, issues.alias("issues"))
        .withColumn("is_valid", F.size("issues") == 0)
    )


def _default_fields(domain: Column, as_of: Column) -> Column:
    now = text_variant(iso_time(as_of))
    values = {
        "scan_id": text_variant(scan_identity(domain, as_of)),
        "domain": text_variant(domain),
        "start_time": now,
        "last_update": now,
        "status": json_literal("in_progress"),
        "phases": json_literal(DEFAULT_PHASES),
        "statistics": json_literal(DEFAULT_STATISTICS),
        "environment": json_literal(DEFAULT_ENVIRONMENT),
    }
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in values]), F.array(*values.values())
    )


def _with_phases(body: Column, phases: Column) -> Column:
    others = F.map_filter(body, lambda key, _: key != "phases")
    return F.map_concat(others, F.create_map(F.lit("phases"), F.to_variant_object(phases)))


def repair_checkpoints(documents: DataFrame, as_of: Column) -> DataFrame:
    """Fill missing top-level fields and missing phases; leave everything else untouched.

    ``documents`` also has ``expected_domain``. ``added`` lists what was filled in; where that is
    nothing, the text is not rewritten. A document that is no JSON object or an empty one, or whose
    phases are no object, stays as it is with ``is_repaired = false``.
    """
    opened = documents.withColumn("_body", body_of(F.col("doc"))).withColumn(
        "_missing", _absent(F.col("_body"), REQUIRED_FIELDS)
    )
    filled = opened.withColumn(
        "_filled",
        F.map_concat(
            "_body",
            F.map_filter(
                _default_fields(F.col("expected_domain"), as_of),
                lambda key, _: F.array_contains(F.col("_missing"), key),
            ),
        ),
    ).withColumn("_phases", object_at(F.col("_filled"), "phases"))
    merged = F.map_zip_with(
        json_object(DEFAULT_PHASES), "_phases",
        lambda _, default, present: F.coalesce(present, default),
    )
    repairable = F.col("_phases").isNotNull() & (F.size("_body") > 0)
    listed = filled.withColumn(
        "added",
        F.when(repairable, F.concat("_missing", _absent(F.col("_phases"), PHASES)))
        .otherwise(F.array().cast("array<string>")),
    )
    return listed.select(
        "scan_id", "expected_domain",
        F.when(F.size("added") > 0, F.to_json(_with_phases(F.col("_filled"), merged)))
        .otherwise(F.col("doc")).alias("doc"),
        repairable.alias("is_repaired"), "added",
    )


def compact_checkpoints(documents: DataFrame) -> DataFrame:
    """Drop the saved position of completed phases; ``size_kb`` is the size afterwards.

    Documents without such a position are not rewritten.
    """
    def droppable(record: Column) -> Column:
        return (F.try_variant_get(record, "$.status", "string") == "completed") & (
            F.try_variant_get(record, "$.checkpoint", "variant").isNotNull()
        )

    def compacted(_, record: Column) -> Column:
        others = F.map_filter(
            F.try_variant_get(record, "$", OBJECT), lambda key, _: key != "checkpoint"
        )
        return F.when(droppable(record), F.to_variant_object(others)).otherwise(record)

    opened = documents.withColumn("_body", body_of(F.col("doc"))).withColumn(
        "_phases", object_at(F.col("_body"), "phases")
    )
    smaller = F.to_json(
        _with_phases(F.col("_body"), F.transform_values("_phases", compacted))
    )
    needed = F.exists(F.map_values("_phases"), droppable)
    return opened.withColumn(
        "doc", F.when(needed, smaller).otherwise(F.col("doc"))
    ).drop("_body", "_phases").withColumn(
        "size_kb", text.one_decimal(F.octet_length("doc") / 1024)
    )


# --- life cycle ------------------------------------------------------------------------------

def init_checkpoints(scans: DataFrame) -> DataFrame:
    """A first document for every new scan (scan_id, domain, started, tool_versions)."""
    now = iso_time(F.col("started"))
    pending = F.struct(
        F.lit("pending").alias("status"), F.lit(0).alias("progress_percentage"),
        F.lit(0).alias("results_count"),
    )
    document = F.struct(
        scan_identity(F.col("domain"), F.col("started")).alias("scan_id"),
        F.col("domain"),
        now.alias("start_time"),
        now.alias("last_update"),
        F.lit("in_progress").alias("status"),
        F.struct(*[pending.alias(phase) for phase in PHASES]).alias("phases"),
        F.struct(*[F.lit(0).alias(name) for name in STATISTICS]).alias("statistics"),
        F.struct(F.col("tool_versions"), F.lit("").alias("templates_hash")).alias("environment"),
    )
    return scans.select("scan_id", F.to_json(document).alias("doc"))


def upsert_checkpoints(current: DataFrame, updates: DataFrame) -> DataFrame:
    """The last written document per scan; rows are (scan_id, ts, seq, doc)."""
    return latest_documents(current.unionByName(updates))


def latest_documents(written: DataFrame) -> DataFrame:
    return (
        written.groupBy("scan_id")
        .agg(F.max_by(F.struct("ts", "seq", "doc"), F.struct("ts", "seq")).alias("_last"))
        .select("scan_id", "_last.*")
    )


def snapshot_checkpoints(documents: DataFrame, as_of: Column) -> DataFrame:
    """Backup rows under a time label; scans without a document have nothing to back up."""
    label = F.date_format(as_of, "yyyyMMdd_HHmmss")
    return documents.filter(F.col("doc").isNotNull()).select(
        "scan_id", label.alias("snapshot"),
        F.concat(F.lit("scan_state_"), label, F.lit(".json")).alias("file_name"), "doc",
    )


def expired_snapshots(
    files: DataFrame, keep: int = SNAPSHOTS_KEPT, ways: int = WAYS,
) -> DataFrame:
    """Every file older than the newest ``keep`` of its scan.

    Only the cut-off of each scan is ranked (Spark limits every task's groups before the
    shuffle); the files themselves are compared with it, so no scan has to be sorted whole.
    """
    newest_first = Window.partitionBy("scan_id").orderBy(F.desc("mtime_s"), "path")
    cutoffs = (
        files.select("scan_id", "path", "mtime_s")
        .withColumn("_n", F.row_number().over(newest_first))
        .filter(F.col("_n") <= keep).filter(F.col("_n") == keep)
        .select("scan_id", F.col("mtime_s").alias("_mtime"), F.col("path").alias("_path"))
    )
    older = (F.col("mtime_s") < F.col("_mtime")) | (
        (F.col("mtime_s") == F.col("_mtime")) & (F.col("path") > F.col("_path"))
    )
    return lookup_join(files, cutoffs, ["scan_id"], "inner", ways).filter(
        older
    ).select(*files.columns)


# --- updates ---------------------------------------------------------------------------------

def _targets(base: DataFrame, held: str) -> DataFrame:
    """(scan_id, name) for everything of that kind that a loaded document holds."""
    return base.filter("load_status = 'loaded'").select(
        "scan_id", F.explode(held).alias("name")
    ).dropDuplicates()


def _split(events: DataFrame, base: DataFrame, held: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): whether the scan's loaded document holds what the event names."""
    targets = _targets(base, held).select("scan_id", F.col("name").alias(name))
    return (
        lookup_join(events, targets, ["scan_id", name], "left_semi"),
        lookup_join(events, targets, ["scan_id", name], "left_anti"),
    )


def split_phase_events(events: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of events with a phase.

    Rejected are updates of scans without a loaded document, and of phases their document does not
    hold. ``base`` comes from ``load_checkpoints``.
    """
    return _split(events, base, "held_phases", "phase")


def split_statistic_events(events: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of events with the name of a statistic."""
    return _split(events, base, "held_statistics", "name")


def split_field_events(events: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of whole-scan settings: templates_hash needs an environment."""
    fields = base.withColumn("_fields", F.when(
        F.col("has_environment"), F.array(F.lit("status"), F.lit("templates_hash"))
    ).otherwise(F.array(F.lit("status"))))
    return _split(events, fields, "_fields", "name")


def _with_last(base: DataFrame, last: DataFrame) -> DataFrame:
    """``base`` with the folded updates of its loaded documents (scan_id, _new, _ts)."""
    loaded = last.withColumn("load_status", F.lit("loaded"))
    return base.join(loaded, ["scan_id", "load_status"], "left").select(
        *base.columns, *[c for c in last.columns if c != "scan_id"]
    )


def _last_per_phase(events: DataFrame, fields: dict[str, Column], held: DataFrame) -> DataFrame:
    """Per scan: the last non-null value of every field of each phase (``_new``), and ``_ts``.

    Events are folded by scan and phase first, then those of phases the document holds are put
    together, so a scan has as many records as its document has phases.
    """
    written = F.struct("ts", "seq")
    per_phase = events.groupBy("scan_id", "phase").agg(
        F.max("ts").alias("_phase_ts"),
        *[F.max_by(value, F.when(value.isNotNull(), written)).alias(name)
          for name, value in fields.items()],
    )
    return (
        per_phase.join(held, ["scan_id", "phase"], "left_semi").groupBy("scan_id").agg(
            F.map_from_entries(F.collect_list(F.struct("phase", F.struct(*fields)))).alias("_new"),
            F.max("_phase_ts").alias("_ts"),
        )
    )


def _apply_to_phases(base: DataFrame, events: DataFrame, fields: dict[str, Column], change) -> DataFrame:
    held = _targets(base, "held_phases").withColumnRenamed("name", "phase")
    joined = _with_last(base, _last_per_phase(events, fields, held))
    changed = F.transform_values("phases", lambda phase, old: F.when(
        F.map_contains_key("_new", phase), change(F.try_element_at("_new", phase), old)
    ).otherwise(old))
    return joined.withColumns({
        "phases": F.when(F.col("_new").isNull(), F.col("phases")).otherwise(changed),
        "last_update": F.coalesce(F.greatest("last_update", "_ts"), "last_update"),
    }).drop("_new", "_ts")


def apply_phase_events(base: DataFrame, events: DataFrame) -> DataFrame:
    """Fold phase updates into loaded documents (scan_id, load_status, phases, held_phases,
    last_update).

    Only the last update of each scan and phase counts. A phase's saved position stays, and a
    phase the document does not hold neither is added nor moves the time.
    """
    record = F.struct(
        F.col("status"), F.col("progress").alias("progress_percentage"), F.col("results_count")
    )
    return _apply_to_phases(base, events, {"record": record}, lambda new, old: F.struct(
        *[new["record"][name].alias(name) for name in REQUIRED_PHASE_FIELDS],
        old["checkpoint"].alias("checkpoint"),
    ))


def apply_position_events(base: DataFrame, events: DataFrame) -> DataFrame:
    """Fold saved positions (scan_id, seq, ts, phase, batch_index, batch_size, progress).

    A null field is one the update does not name: it keeps its value.
    """
    return _apply_to_phases(
        base, events, {name: F.col(name) for name in POSITION},
        lambda new, old: old.withField("checkpoint", F.struct(*[
            F.coalesce(new[name], old["checkpoint"][name]).alias(name) for name in POSITION
        ])),
    )


def _last_named(events: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Per scan: the last value (``_name``) and time (``_name_ts``) of each name, and ``_ts``."""
    named = {name: F.col("name") == name for name in names}
    return events.groupBy("scan_id").agg(
        *[
            F.max_by(F.when(is_it, F.col("value")), F.when(is_it, F.struct("ts", "seq")))
            .alias(f"_{name}")
            for name, is_it in named.items()
        ],
        *[F.max(F.when(is_it, F.col("ts"))).alias(f"_{name}_ts") for name, is_it in named.items()],
        F.max("ts").alias("_ts"),
    )


def apply_statistic_events(base: DataFrame, events: DataFrame) -> DataFrame:
    """Fold counter updates (scan_id, seq, ts, name, value) into loaded documents.

    A statistic the document does not hold is not added; the time moves all the same.
    """
    joined = _with_last(base, _last_named(events, STATISTICS))
    merged = F.struct(*[
        F.when(
            F.array_contains("held_statistics", name) & F.col(f"_{name}_ts").isNotNull(),
            F.col(f"_{name}"),
        ).otherwise(F.col("statistics")[name]).alias(name)
        for name in STATISTICS
    ])
    return joined.withColumns({
        "statistics": F.when(F.col("statistics").isNotNull(), merged),
        "last_update": F.coalesce(F.greatest("last_update", "_ts"), "last_update"),
    }).select(*base.columns)


def apply_field_events(base: DataFrame, events: DataFrame) -> DataFrame:
    """Fold whole-scan settings (scan_id, seq, ts, name, value): status and templates_hash.

    A document without an environment takes no templates_hash, and its time does not move.
    """
    joined = _with_last(base, _last_named(events, ("status", "templates_hash")))
    hash_ts = F.when(F.col("has_environment"), F.col("_templates_hash_ts"))
    return joined.withColumns({
        "status": F.when(F.col("_status_ts").isNotNull(), F.col("_status"))
        .otherwise(F.col("status")),
        "templates_hash": F.when(hash_ts.isNotNull(), F.col("_templates_hash"))
        .otherwise(F.col("templates_hash")),
        "last_update": F.coalesce(
            F.greatest("last_update", "_status_ts", hash_ts), "last_update"
        ),
    }).select(*base.columns)
