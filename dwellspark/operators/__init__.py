"""Operators over pages, listings, snapshots and leads."""
