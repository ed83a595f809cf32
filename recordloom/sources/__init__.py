"""Readers and writers: NDJSON, JSON documents, index files, CSV, keyed stores."""
