"""Cleaning only the snapshots that arrived since the last run."""
