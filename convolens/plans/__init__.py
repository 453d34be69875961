"""Plans of the conversation-quality engine."""
