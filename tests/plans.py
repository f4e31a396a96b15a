"""Helpers to read physical plans in tests."""

from __future__ import annotations

import contextlib
import io
import re


def plan_text(df) -> str:
    """The formatted plan, as `explain` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def operators(df) -> list[str]:
    """Operator names from the tree at the top of the plan."""
    tree = plan_text(df).split("\n\n\n")[0]
    return re.findall(r"(?:[-+:|\s*]*)([A-Z]\w+(?: \w+)?) ?.*?\(\d+\)", tree)


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*?)>\n", plan_text(df))
