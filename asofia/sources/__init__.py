"""Stores, readers and sinks."""
