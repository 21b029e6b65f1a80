def key(row):
    """Sort key with nulls last, nested rows too."""
    return tuple((v is None, str(v) if v is not None else "") for v in row)
