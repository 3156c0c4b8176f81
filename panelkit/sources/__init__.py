"""Scans, release parsers, web-page payload operators and sinks."""
