TESTDATA = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples, for comparison by value."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
