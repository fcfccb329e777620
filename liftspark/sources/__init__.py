"""Readers, writers, snapshots and catalogue entries."""
