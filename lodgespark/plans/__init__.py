"""Composed pipelines: chains of operators, one lazy plan per table."""
