"""Helpers that several test modules share."""

def rows_of(frame) -> list[tuple]:
    """All rows as sorted tuples, columns by name."""
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)
