"""Structured Streaming: line streams, foreachBatch fan-out, per-epoch
statistics, key-policy and console sinks."""
