"""Structured Streaming jobs: incremental ingestion, enrichment, stateful
windows and keyed state kept by ``foreachBatch``."""
