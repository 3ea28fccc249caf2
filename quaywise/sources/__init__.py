"""Readers and writers: feeds, referentials, stored tables."""
