"""What the feed tests share. Not in conftest.py, as folders below have one of their own."""


def pairs(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
