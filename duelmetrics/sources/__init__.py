"""Landed payloads, raw tables and table sinks."""
