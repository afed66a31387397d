"""Composed models: silver, marts, reports, indicators, chunks."""
