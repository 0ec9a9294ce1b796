"""Relational operators over point-in-time facts, prices, events and texts."""
