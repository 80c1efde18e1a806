"""Readers, writers, digests and driver-table adapters."""
