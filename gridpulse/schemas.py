"""Declared schemas of the data model. Nothing is inferred.

Timestamps are `timestamp_ntz` holding UTC wall clock, so results never depend
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The allowed labels of every enumerated column, in sort order.
ENUMS: dict[str, tuple[str, ...]] = {
    "point_value_type": ("int64", "float64", "numeric"),
    "rollup_method": ("sum", "avg", "power_to_energy", "sum_hour_avg", "accumulator_to_energy"),
    "data_quality": ("online", "offline", "mixed", "over_range", "under_range", "estimated", "error"),
    "reading_type": ("raw", "heartbeat"),
    "device_status": ("active", "disabled"),
    "value_map_type": ("translation", "bitmask"),
    "control_status": (
        "queued", "accepted", "rejected", "scheduled", "active",
        "completed", "failed", "cancelled", "not_found", "superseded",
    ),
    "control_source": ("hmi", "api", "plc", "scheduler", "dispatch", "system"),
    "schedule_status": ("draft", "ready", "active", "disabled"),
    "repeat_unit": ("minutes", "hours", "days", "weeks"),
    "alarm_severity": ("information", "low", "medium", "high", "critical"),
    "alarm_type": (
        "point_analysis", "point_group_deviation", "performance_analysis", "missing_data",
        "data_quality", "point_activity", "device_analysis", "bitmask_analysis",
        "suppression", "system",
    ),
    "analysis_type": ("rate", "duration"),
    "boolean_operator": ("all", "any"),
    "expression_role": ("raise", "clear"),
}

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DATE = T.TimestampNTZType(), T.DateType()
NUMERIC = T.DecimalType(38, 9)
ENG = T.DecimalType(24, 7)
SETPOINTS = T.ArrayType(T.DecimalType(18, 9))


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_REQUEST = dict(
    control_request_id=S, parent_control_request_id=S, cancel_control_request_id=S,
    function_code=I, value=SETPOINTS, executed_at=TS, scheduled_at=TS, device_id=S, point_id=S,
    mode=I, status=S, source=S, dispatch_id=I, description=S, site_id=S, created_by=S,
    updated_by=S, created_at=TS, updated_at=TS,
)

SCHEMAS: dict[str, T.StructType] = {
    "sites": _schema(
        site_id=S, name=S, timezone=S, latitude=T.DecimalType(9, 6), longitude=T.DecimalType(9, 6),
        capacity_kw=T.DecimalType(12, 2), commissioned_on=DATE, updated_at=TS,
    ),
    "settings": _schema(site_id=S, setting_name=S, value=S, updated_at=TS),
    "value_maps": _schema(
        value_map_id=S, name=S, map_type=S, display_values=T.ArrayType(S),
        int_values=T.ArrayType(I), updated_at=TS,
    ),
    "device_types": _schema(device_type_id=I, name=S),
    "devices": _schema(
        device_id=S, site_id=S, name=S, status=S, device_type_id=I, device_model=S,
        is_controllable=B, updated_at=TS,
    ),
    "device_hierarchy": _schema(parent_device_id=S, child_device_id=S, alias_name=S),
    "device_properties": _schema(
        device_property_id=S, device_id=S, name=S, static_value=D, point_id=S, uom=S, updated_at=TS,
    ),
    "points": _schema(
        point_id=S, site_id=S, name=S, display_name=S, description=S, point_kind=I, value_type=S,
        eng_low=ENG, eng_high=ENG, low_label=S, high_label=S, uom=S, display_uom=S,
        rollup_method=S, rollup_uom=S, display_rollup_uom=S, display_precision=I, value_map_id=S,
        is_derived=B, is_analog=B, updated_at=TS,
    ),
    "device_points": _schema(device_id=S, point_id=S),
    "derived_points": _schema(
        point_id=S, calc_code=I, constant_value=T.DecimalType(20, 7), quality_point_id=S,
        require_all_sources=B, updated_at=TS,
    ),
    "derived_point_sources": _schema(point_id=S, source_point_id=S, parameter_order=I),
    "control_schedules": _schema(
        site_id=S, schedule_id=I, name=S, priority=I, start_at=TS, repeat_interval=I,
        repeat_units=S, status=S, points_config=S, is_ready=B, updated_at=TS,
    ),
    "retention_settings": _schema(table_name=S, retention_days=I, updated_at=TS),
    "retention_logs": _schema(
        executed_at=TS, table_name=S, deleted_chunks=I, duration_s=D, status=S, error_message=S,
    ),
    "compaction_logs": _schema(
        executed_at=TS, table_name=S, partition_date=DATE, action=S, bytes_before=L, bytes_after=L,
    ),
    "point_readings": _schema(
        event_time=TS, point_id=S, reading_type=S, value_bigint=L, value_double=D,
        value_numeric=NUMERIC, data_quality=S, quality_flags=I,
    ),
    "control_requests": _schema(**_REQUEST),
    "control_requests_history": _schema(**_REQUEST, is_internal=B),
    "alarm_definitions": _schema(
        alarm_definition_id=S, site_id=S, name=S, description=S, resolution=S, device_id=S,
        point_id=S, severity=S, analysis_type=S, alarm_type=S, raise_occurrence_limit=I,
        raise_timeframe_s=I, clear_occurrence_limit=I, clear_timeframe_s=I,
        raise_window_start_s=I, clear_window_start_s=I, can_be_shelved=B,
        require_acknowledgement=B, require_cleared_acknowledged=B, raise_match_operator=S,
        clear_match_operator=S, updated_at=TS,
    ),
    "alarm_definition_expressions": _schema(
        expression_id=S, alarm_definition_id=S, device_id=S, point_id=S, point_value=NUMERIC,
        comparison_operator=S, evaluation_order=I, bit_position=I, role=S, group_operator=S,
        group_number=I,
    ),
    "alarm_definition_dependencies": _schema(
        dependent_alarm_definition_id=S, limited_by_alarm_definition_id=S,
    ),
    "alarm_history": _schema(
        alarm_history_id=S, alarm_definition_id=S, site_id=S, alarm_name=S, source=S,
        is_system_alarm=B, alarm_hash=S, instance=S, device_id=S, point_id=S, severity=S,
        is_active=B, message=S, note=S, raised_at=TS, cleared_at=TS, acknowledged_at=TS,
        created_at=TS, updated_at=TS,
    ),
    "alarm_events": _schema(
        site_id=S, alarm_event_id=S, alarm_history_id=S, alarm_definition_id=S, event_time=TS,
        message=S, event_condition=S, alarm_inputs=S, alarm_outputs=S, point_id=S, bit_position=I,
        created_at=TS,
    ),
    "config": _schema(key=S, value=S, description=S),
    "day_factors": _schema(site_id=S, local_day=DATE, factor=D),
    "outages": _schema(outage_id=S, device_id=S, site_id=S, start_at=TS, end_at=TS),
}

# Defaults of columns a writer may leave out.
DEFAULTS: dict[str, dict[str, object]] = {
    "sites": {"timezone": "UTC"},
    "value_maps": {"map_type": "translation"},
    "devices": {"status": "active", "is_controllable": False},
    "points": {"is_derived": False, "is_analog": True},
    "control_schedules": {
        "priority": 100, "repeat_interval": 0, "repeat_units": "days", "status": "draft",
        "is_ready": False,
    },
    "point_readings": {"reading_type": "raw"},
    "control_requests": {"status": "queued"},
    "control_requests_history": {"status": "queued"},
    "alarm_definitions": {
        "raise_occurrence_limit": 1, "raise_timeframe_s": 0, "clear_occurrence_limit": 1,
        "clear_timeframe_s": 0, "can_be_shelved": True, "require_acknowledgement": False,
        "require_cleared_acknowledged": False, "raise_match_operator": "any",
        "clear_match_operator": "any",
    },
    "alarm_definition_expressions": {"role": "raise", "group_operator": "any", "group_number": 1},
    "alarm_history": {"is_system_alarm": False},
    "retention_logs": {"deleted_chunks": 0},
}

# Time column and days per partition of the range-partitioned tables.
PARTITIONED: dict[str, tuple[str, int]] = {
    "point_readings": ("event_time", 1),
    "control_requests": ("created_at", 7),
    "control_requests_history": ("created_at", 7),
    "alarm_events": ("created_at", 7),
    "readings_1h": ("bucket", 1),
    "readings_1d": ("bucket", 1),
}

# Clustering of compacted partitions: segment key, then order key descending.
CLUSTERING: dict[str, tuple[str, str]] = {
    "point_readings": ("point_id", "event_time"),
    "control_requests": ("device_id", "created_at"),
    "control_requests_history": ("device_id", "created_at"),
    "alarm_events": ("alarm_definition_id", "created_at"),
    "readings_1h": ("point_id", "bucket"),
}

# Age in days after which a partition is compacted, and seeded retention days.
COMPACT_AFTER_DAYS = {
    "point_readings": 7, "control_requests": 14, "control_requests_history": 7,
    "alarm_events": 14, "readings_1h": 14,
}
RETENTION_DAYS = {
    "point_readings": 45, "control_requests": 180, "control_requests_history": 90,
    "alarm_events": 90,
}
