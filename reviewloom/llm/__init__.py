"""Operators for building training data: filtering, deduplication, scanning, tokenising, archiving."""
