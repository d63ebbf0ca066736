"""Scans: generic table read, text loaders, message parsing, and the fixture views."""

from cinerank.sources.tables import read_table
from cinerank.sources.text import load_movies_text, load_ratings_text, load_tags_text, parse_messages

__all__ = ["read_table", "load_movies_text", "load_ratings_text", "load_tags_text", "parse_messages"]
