import math


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    """Rows in a fixed order, with NaN made comparable."""

    def cell(x):
        return "NaN" if isinstance(x, float) and math.isnan(x) else x

    return sorted((tuple(cell(x) for x in r) for r in df.collect()), key=repr)
