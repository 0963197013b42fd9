"""Exceptions a caller can tell apart."""


class OptionError(ValueError):
    """An argument has a value the operation does not accept."""


class MissingDataError(LookupError):
    """A required dataset, report or stored record is not there."""


class DataError(RuntimeError):
    """Landed data does not have the shape the operation needs."""
