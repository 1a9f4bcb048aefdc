"""Operators that prepare transcripts and documents as training text."""
