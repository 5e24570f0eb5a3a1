import contextlib
import io
from collections import Counter


def bag(df, *columns):
    columns = columns or sorted(df.columns)
    return Counter(map(tuple, df.select(*columns).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
