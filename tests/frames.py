"""Helpers for comparing frames in tests."""


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    names = list(cols) or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
