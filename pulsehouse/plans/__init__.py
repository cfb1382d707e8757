"""Registered queries over the driver tables and their DuckDB oracles."""

from __future__ import annotations

from pulsehouse.plans import batch, layered, streams
from pulsehouse.plans.oracle import ORACLE

QUERIES = {
    "session_summary": batch.session_summary_q,
    "visit_minutes": batch.visit_minutes_q,
    "envelope_decode": batch.envelope_decode_q,
    "topic_week_counts": batch.topic_week_counts_q,
    "epoch_to_timestamp": batch.epoch_to_timestamp_q,
    "envelope_encode": batch.envelope_encode_q,
    "visit_upsert": batch.visit_upsert_q,
    "start_stop_pairs": batch.start_stop_pairs_q,
    "readings_in_sessions": batch.readings_in_sessions_q,
    "readings_bucketed": batch.readings_bucketed_q,
    "age_bins": batch.age_bins_q,
    "validity_flag": batch.validity_flag_q,
    "count_checks": batch.count_checks_q,
    "rows_equal": batch.rows_equal_q,
    "tables_differ": batch.tables_differ_q,
    "colocated_visits": batch.colocated_visits_q,
    "first_seen_insert_only": streams.first_seen_insert_only_q,
    "first_seen_earliest_wins": streams.first_seen_earliest_wins_q,
    "latest_profile": streams.latest_profile_q,
    "pairs_streaming": streams.pairs_streaming_q,
    "summary_stream": streams.summary_stream_q,
    "csv_ingest": streams.csv_ingest_q,
    "bus_ingest": streams.bus_ingest_q,
    "compact_files": streams.compact_files_q,
    "compact_partitions": streams.compact_partitions_q,
    "dedupe_stream": streams.dedupe_stream_q,
    "csv_rejects": streams.csv_rejects_q,
    "observed_checks": streams.observed_checks_q,
    "open_sessions": streams.open_sessions_q,
    "final_windows": streams.final_windows_q,
    "layer_waves": layered.layer_waves_q,
    "gym_summary": layered.gym_summary_q,
    "user_profile_layer": layered.user_profile_layer_q,
    "user_bins_layer": layered.user_bins_layer_q,
    "layer_checks": layered.layer_checks_q,
    "layer_changes": layered.layer_changes_q,
}

__all__ = ["QUERIES", "ORACLE"]
