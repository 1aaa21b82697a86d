"""Streaming forms of windows and roll-ups."""
