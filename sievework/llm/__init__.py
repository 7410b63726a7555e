"""Operators for building language-model training corpora, with the queries that apply them to whole tables."""
