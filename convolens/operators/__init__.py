"""Operators of the conversation-quality engine."""
