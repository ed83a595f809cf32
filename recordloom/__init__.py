"""Recordloom: nested, multilingual JSON records to clean, flat datasets on Spark."""
