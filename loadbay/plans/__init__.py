"""Registered plans: one per operator of the survey, each with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadbay.plans import loads, transfers
from loadbay.plans.oracle import ORACLE_SQL

_TRANSFERS = ["flagship_totals", "delimited_round_trip", "compressed_round_trip",
              "sequence_round_trip", "sequence_typed", "parquet_as_text", "parquet_as_text_arrays", "col_filter",
              "split_regex_trailing", "null_fit_arity", "dates_to_text", "parse_dates",
              "reformat_date", "sanitize_escape", "map_columns_set", "typed_by_hive",
              "typed_parquet", "partition_read", "sharded_union", "route_shards",
              "read_with_schema", "print_rows", "csv_files", "sql_query", "gbk_round_trip",
              "remote_text_header", "date_masks", "load_file_round_trip", "columns_where",
              "expand_paths_glob", "numbered_files", "del_modes", "write_modes",
              "shared_folder"]
_LOADS = ["key_range_chunks", "key_range_select", "extent_chunks", "partition_ranges", "extent_span", "clip_ranges",
          "key_range_scan", "rows_to_cells", "cells_to_rows", "load_ignore", "load_replace",
          "load_files_replace", "load_buckets_replace", "load_versions_replace", "load_ignore_two_keys",
          "load_replace_two_keys", "region_scan", "catalog_load_documents", "split_dirty", "check_limit", "checked_load", "transfer_stats",
          "reconcile", "exchange_report", "catalog_load", "line_stream", "windowed_stats", "detect_format",
          "row_lengths"]

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{k: getattr(transfers, k) for k in _TRANSFERS},
    **{k: getattr(loads, k) for k in _LOADS},
}

__all__ = ["PLANS", "ORACLE_SQL"]
