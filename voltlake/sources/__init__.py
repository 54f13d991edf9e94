"""Readers, audited loading and versioned tables."""
