"""Incremental landing of daily batches (the reference has no streams; this
re-expresses its resume / merge of landed batches, S8-S9, as a stream)."""
