"""Reusable DataFrame operators the warehouse models are built from."""
