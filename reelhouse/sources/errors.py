"""Errors of the readers."""


class MissingInput(Exception):
    """An input does not exist, is empty, or lacks columns."""
