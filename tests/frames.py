"""What tests read from DataFrames."""


def rows(df, *names):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.select(*names).collect()), key=str)
