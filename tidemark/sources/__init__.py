"""Readers, sinks and table statistics."""
