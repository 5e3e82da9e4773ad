"""Structured Streaming jobs over the audit event feed and late billing."""
