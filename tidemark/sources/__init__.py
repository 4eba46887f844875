"""Feeds, stored tables and sinks."""
