"""Operators for training data at scale: filtering, deduplication, mixing, packing and archives."""
