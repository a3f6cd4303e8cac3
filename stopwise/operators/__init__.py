"""Operators by layer: staging, dimensions, facts, aggregates, questions, checks."""
