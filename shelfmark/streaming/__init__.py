"""Structured Streaming in front of Bronze; Silver and Gold stay the same."""
