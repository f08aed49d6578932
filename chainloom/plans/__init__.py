"""Queries of the library over the star-schema tables."""
