"""Incremental refresh driven by Structured Streaming.

The reference has no stream processing; its monthly summary is an insert
re-run over the whole history. ``refresh`` turns that insert into an
incremental job over arriving transaction files.
"""
