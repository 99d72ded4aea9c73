"""JSON literals assigned inside script text.

Bracket balance is not a regular language, so this is the one place where a task runs
Python: an Arrow batch of candidate scripts in, their JSON literals out. Scripts that
cannot hold a vehicle array never get here.
"""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Executors get these few functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ASSIGNED = re.compile(r"=\s*([{\[])")
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)


def _is_json(text: str) -> bool:
    def refuse(word: str):
        raise ValueError(word)

    try:
        return bool(json.loads(text, parse_constant=refuse))
    except (ValueError, RecursionError):
        return False


def _closings(text: str) -> dict[int, int]:
    """Where the literal of every opening bracket ends; brackets that never close are left out.

    Two passes over the text: one for the brackets outside of strings as they are counted from
    the start, one for those the count takes to be inside, since a literal begins outside.
    """
    ends: dict[int, int] = {}
    for inside in (False, True):
        quoted = inside
        opened: dict[str, list[int]] = {"}": [], "]": []}
        for token in _TOKEN.finditer(text):
            mark = token.group()
            if mark == '"':
                quoted = not quoted
            elif quoted or len(mark) > 1:
                continue
            elif mark in opened:
                if opened[mark]:
                    ends[opened[mark].pop()] = token.end()
            else:
                opened["}" if mark == "{" else "]"].append(token.start())
    return ends


def json_literals(text: str | None, most: int | None = None) -> list[str]:
    """The whole script if it is JSON, else the literals after an '=' (the first ``most``)."""
    if not text:
        return []
    whole = text.strip()
    if whole[:1] in "{[" and _is_json(whole):
        return [whole]
    found: list[str] = []
    ends: dict[int, int] | None = None
    closed = 0  # what lies inside a literal that is taken is not looked at again
    for match in _ASSIGNED.finditer(text):
        if most is not None and len(found) >= most:
            break
        if match.end() <= closed:
            continue
        if ends is None:
            ends = _closings(text)
        start = match.end() - 1
        if start in ends and _is_json(text[start: ends[start]]):
            found.append(text[start: ends[start]])
            closed = ends[start]
    return found


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _script_literals(scripts: pd.Series) -> pd.Series:
    return scripts.map(
        lambda texts: [json_literals(t) for t in texts] if texts is not None else []
    )


# Declared nondeterministic so that the optimizer never copies or moves the call: every
# page's scripts cross to Python exactly once.
script_literals = _script_literals.asNondeterministic()
