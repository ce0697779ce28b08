"""Streaming: stateless micro-batch scoring of feature rows (see scoring.py)."""
