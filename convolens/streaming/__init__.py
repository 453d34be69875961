"""Streaming of the conversation-quality engine."""
