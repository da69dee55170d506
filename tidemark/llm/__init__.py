"""Operators for large text corpora, each with the queries that apply it to whole tables."""
