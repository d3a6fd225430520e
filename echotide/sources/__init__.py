"""Readers and normalisers: raw payloads of each platform to one collected row type."""
