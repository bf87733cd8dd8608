"""Readers, landing and snapshot tables."""
