"""Readers (tables, CSV batches) and sinks."""
