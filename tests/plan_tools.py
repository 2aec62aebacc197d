"""Plan text helpers for tests."""

import io
import re
from contextlib import redirect_stdout


def plan_text(df) -> str:
    """The physical plan as ``explain`` prints it; run ``df`` first for the final one."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def final_plan(df) -> str:
    """The part of an executed adaptive plan that really ran."""
    df.collect()
    text = plan_text(df)
    match = re.search(r"== Final Plan ==(.*?)== Initial Plan ==", text, re.S)
    return match.group(1) if match else text
