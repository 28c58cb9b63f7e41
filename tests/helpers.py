"""Helpers that tests import by name; fixtures are in conftest."""


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
