"""Small functions that several tests use."""


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    found = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(found, key=lambda r: tuple(str(r[c]) for c in order)) if order else found
