"""Streaming.

The reference job is batch only (no watermark, window or state semantics
to reproduce).  The only streaming piece is the incremental form of the
formatted-zone load in :mod:`driftwood.streaming.drops`: new drop files are
picked up with Structured Streaming and each micro-batch runs the same
batch operators (dedupe, repair, upsert).
"""
