"""Checks that fail with a count in the text and the complete table of offenders on the exception."""

from __future__ import annotations

from pyspark.sql import DataFrame


class OffendersError(ValueError):
    """A failed check. ``offenders`` is the complete, lazy table of what broke it, or None."""

    def __init__(self, message: str, offenders: DataFrame | None = None):
        super().__init__(message)
        self.offenders = offenders


def require_none(offenders: DataFrame, what: str, error: type[OffendersError]) -> None:
    """Fail with the number of ``offenders``; the table goes along whole, to be read or written by the caller."""
    n = offenders.count()
    if n:
        raise error(f"{what}: {n} (all rows in .offenders)", offenders)
