"""Incremental, resumable versions of ingest, de-duplication and counters."""
