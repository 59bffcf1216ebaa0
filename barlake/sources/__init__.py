"""Landed files, topics and the warehouse tables."""
