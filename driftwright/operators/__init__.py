"""Profiles, similarity, drift and load operators over DataFrames."""
