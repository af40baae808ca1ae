"""Incremental and streaming operators."""
