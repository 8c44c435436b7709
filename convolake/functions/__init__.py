"""Part of the conversation lakehouse."""
