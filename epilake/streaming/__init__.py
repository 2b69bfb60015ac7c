"""Structured Streaming entry points.

The workload is batch: landed files are processed whole per run. The
streaming piece is an incremental driver for the ingest step
(:func:`epilake.streaming.ingest.incremental_trusted`): it enriches only
files landed since the last run (``availableNow``) and appends them to the
trusted table exactly once (file sink + checkpoint).
"""
