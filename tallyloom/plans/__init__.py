"""Configured processing of whole editions and register years."""
