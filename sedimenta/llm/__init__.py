"""Operators of a training-data pipeline: chat, tokens, filters, joins and search over texts."""
