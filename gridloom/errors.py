"""Exceptions raised by name resolution."""


class MultipleKeys(Exception):
    """More than one alternative name of a variable or dimension is present."""


class MissingKey(Exception):
    """A required variable or dimension has none of its names present."""
