"""Readers, landing-zone bookkeeping, and the sinks that publish tables."""
