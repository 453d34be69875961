"""Functions of the conversation-quality engine."""
