"""Results as plain rows, for comparisons."""


def values(df, *columns):
    """Rows of the columns as sorted tuples."""
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))
