"""Incremental file pickup and watermarked streaming aggregates."""
