"""Exceptions raised by the package."""


class StaylakeError(Exception):
    """Base class."""


class BadMapping(StaylakeError):
    """A mapping file is missing or is not one flat JSON object."""


class LookupKeyError(StaylakeError):
    """A lookup table holds a key more than once, so a join would fan out rows."""


class UnsupportedWriteMode(StaylakeError, ValueError):
    """Write mode other than ``overwrite`` or ``append``."""


class TableLayoutError(StaylakeError):
    """An existing target table does not have the bookings columns and types."""


class LoadMismatch(StaylakeError):
    """The records read and those booked or rejected are not the same number."""
