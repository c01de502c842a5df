"""What several test modules share."""

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    """All rows as tuples in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
