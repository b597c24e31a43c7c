"""Conversation-corpus analytics as Spark DataFrame transformations."""
