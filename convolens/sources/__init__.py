"""Sources of the conversation-quality engine."""
