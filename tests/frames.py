"""Helpers on the frames that tests compare."""


def rows_of(df, *cols):
    """Sorted tuples of the given columns (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
