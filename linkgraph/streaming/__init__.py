"""Ingestion of snapshots as streams."""
