"""Operators for preparing large text corpora; ``queries`` registers them over the given tables."""
