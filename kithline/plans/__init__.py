"""Staging and the whole linkage run."""
