"""Readers of landed payloads and files, and snapshot sinks."""
