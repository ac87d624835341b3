"""Queries over the driver's tables, each with its SQL oracle where SQL can express it."""

from .registry import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
