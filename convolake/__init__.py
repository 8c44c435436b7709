"""Conversation-lakehouse operators on Spark DataFrames."""
