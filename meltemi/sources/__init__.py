"""Readers: landed payloads, partitioned tables and the given star-schema tables."""
