"""Operators that prepare text for training: filtering, deduplication, packing, archives."""
