"""Incremental loading of run logs."""
