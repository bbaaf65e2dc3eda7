"""Structured Streaming: score loans as new quarter files land."""
