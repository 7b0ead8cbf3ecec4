"""Mappings, the normalisation planner and its execution."""
