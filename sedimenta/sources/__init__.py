"""Declared sources, loaders and sinks."""
