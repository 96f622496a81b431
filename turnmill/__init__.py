"""Conversation data, model evaluation and retrieval as Spark DataFrame jobs."""
