"""Structured Streaming jobs: ingest with fan-out, live monitors."""
