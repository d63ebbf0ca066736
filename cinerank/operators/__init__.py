"""Operators of the engine, grouped by job: statistics, catalogue, online re-ranking,
item similarity and the factor model."""
