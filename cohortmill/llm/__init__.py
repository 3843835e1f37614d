"""Operators for training data: cleaning, deduplication, mixing and sharding of document tables."""
