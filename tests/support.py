"""What the tests share."""

SF = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by text."""
    got = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(got, key=lambda r: [r[i] for i in at])
    return sorted(got, key=repr)
