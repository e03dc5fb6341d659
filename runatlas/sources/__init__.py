"""Readers and writers: JSON records, CSV staging files, tables, event logs."""
