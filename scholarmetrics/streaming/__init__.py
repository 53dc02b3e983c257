"""Structured Streaming: incremental citation counts over an arriving edge feed."""
