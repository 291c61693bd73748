"""Readers, incremental pulls, snapshot and delta writers."""
