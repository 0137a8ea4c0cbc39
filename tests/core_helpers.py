"""Shared by the core tests. Not in conftest.py, which another folder's conftest shadows on import."""

TESTDATA = "/root/testdata/sf0.001"


def rows(df):
    """Rows as a sorted list, for comparison without order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
