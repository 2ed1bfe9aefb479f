"""Streaming: intentionally empty.

The workload is batch: monthly files are loaded, cleaned, turned into a fact
table and aggregated.  It has no stream sources, watermarks, windows over
event time or stateful operators, so nothing here is built.  Late rows of a
month (stray rows of another month inside a monthly file) are handled in
batch by partitioning loads by their source month (see
``meterwise.sources.writers``).
"""
