"""Readers and writers of the ledger tables."""
