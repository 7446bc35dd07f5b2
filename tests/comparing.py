"""Results as plain sorted tuples."""


def rows(df, *order):
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)
