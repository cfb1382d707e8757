"""Relational operators: joins, summaries, merges, quality, maintenance."""

from pulsehouse.operators.joins import (attach_readings, interval_join, join_dimension,
                                        pair_actions)
from pulsehouse.operators.summaries import reading_stats, session_summary, visit_report
from pulsehouse.operators.merge import (AppendTable, KeyedTable, merge_rows, new_rows,
                                        pick_per_key, read_if_there)
from pulsehouse.operators.quality import (assert_checks, assert_count, count_checks,
                                          database_exists, rows_equal, table_exists)
from pulsehouse.operators.maintenance import (compact, create_database, create_tables,
                                              drop_database, write_colocated)

__all__ = ["attach_readings", "interval_join", "join_dimension", "pair_actions",
           "reading_stats", "session_summary", "visit_report", "AppendTable", "KeyedTable",
           "merge_rows", "new_rows", "pick_per_key", "read_if_there", "assert_checks", "assert_count", "count_checks",
           "database_exists", "rows_equal", "table_exists", "compact",
           "create_database", "create_tables", "drop_database", "write_colocated"]
