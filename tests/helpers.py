"""What several test modules use."""


def column(df, expr):
    """Values of one expression, in row order."""
    return [r[0] for r in df.select(expr).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
