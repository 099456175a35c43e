"""Structured Streaming jobs: landing, applying, metrics, windows."""
