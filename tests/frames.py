"""Comparing DataFrames in tests; not in conftest, for a folder below has one of its own."""


def as_set(df):
    """Rows as tuples; fails on duplicates, which a set would hide."""
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def same_rows(a, b):
    """Equal as bags, by column name."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
