"""Sinks: CSV with header, JSON records, plain lines, fact export."""

from arearisk.sinks.writers import write_csv, write_facts, write_lines, write_records  # noqa: F401
