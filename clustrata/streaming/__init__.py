"""Streaming extension."""
