"""Rows as text, for comparison."""


def rows(frame):
    """Rows as sorted tuples of text, for comparison without order."""
    return sorted(tuple(map(repr, row)) for row in frame.collect())
