"""Operators for preparing text corpora; see ``queries`` for their registered forms."""
