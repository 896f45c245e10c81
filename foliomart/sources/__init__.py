"""Readers, staging and warehouse tables."""
