"""What several test modules share besides fixtures."""

DATA = "/root/testdata/sf0.001"


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
