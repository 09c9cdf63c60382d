"""Readers and writers: CSV feeds, GeoJSON, raw snapshots, versioned tables."""
