"""Readers, crawlers and sinks."""
