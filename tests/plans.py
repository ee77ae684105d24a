"""Physical plan text of a DataFrame."""

from __future__ import annotations

import contextlib
import io


def plan(df, mode: str = "simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
