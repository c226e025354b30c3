"""Operators of a training-data pipeline: formatting, near-duplicates, search,
filters, tokenizing and packing. Nothing outside this folder imports it."""
