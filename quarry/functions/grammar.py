"""Command syntax: templates such as `vlan { <id> [ to <id2> ] } &<1-10>` as regular expressions.

A template is parsed into a tree (sequence, choice, optional, repeated) that is then written as a
pattern; patterns are strings, so that joins on them can run in the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

PIECES = re.compile(r"(?P<times>&<\d+-\d+>)|(?P<slot><[^<>]+>)|(?P<open>[\[{])|(?P<close>[\]}])|(?P<bar>\|)|(?P<word>[^\s\[\]{}|]+)")
PAIRS = {"[": "]", "{": "}"}
MOST = 100_000

ISSUES = "array<struct<cli_index:int,cli:string,code:string,message:string>>"
MESSAGES = {
    "unbalanced_syntax": "Unbalanced or mismatched []/{} groups in the extracted template.",
    "unsupported_syntax": "The extracted template cannot be interpreted by this syntax matcher.",
}


class Unsupported(ValueError):
    """A template that has no meaning as a grammar."""


@dataclass
class Node:
    """One unit of a sequence, and how often it may stand."""

    pattern: str
    low: int = 1
    high: int = 1

    def text(self) -> str:
        if (self.low, self.high) == (1, 1):
            return self.pattern
        return f"(?:{self.pattern})" + ("?" if (self.low, self.high) == (0, 1) else f"{{{self.low},{self.high}}}")


def compiled(template: str) -> str:
    """The pattern of a template; Unsupported if it has none."""
    stack: list[tuple[str, list[list[Node]]]] = [("", [[]])]
    for m in PIECES.finditer(template):
        kind, piece = m.lastgroup, m.group()
        row = stack[-1][1][-1]
        if kind == "open":
            stack.append((piece, [[]]))
        elif kind == "close":
            opened, choices = stack.pop() if len(stack) > 1 else ("", [])
            if PAIRS.get(opened) != piece:
                raise Unsupported("groups don't match")
            body = "|".join("".join(n.text() for n in c) for c in choices)
            stack[-1][1][-1].append(Node(f"(?:{body})", 0 if opened == "[" else 1))
        elif kind == "bar":
            stack[-1][1].append([])
        elif kind == "times":
            low, high = map(int, piece[2:-1].split("-"))
            if not row or low > high or high > MOST:
                raise Unsupported("a repetition of nothing, or out of range")
            row[-1] = Node(row[-1].text(), low, high)
        else:
            word = r"\S+" if kind == "slot" else re.escape(piece)
            row.append(Node(rf"(?:{word}(?:\s+|$))"))
    if len(stack) > 1:
        raise Unsupported("a group is left open")
    return "|".join("".join(n.text() for n in c) for c in stack[0][1])


@lru_cache(maxsize=32768)
def pattern(template: str) -> str | None:
    """The pattern of a template, or None if it has none."""
    try:
        found = compiled(template)
        re.compile(found, re.IGNORECASE)
    except (ValueError, OverflowError, re.error, RecursionError):
        return None
    return found


@lru_cache(maxsize=32768)
def matcher(template: str) -> re.Pattern[str] | None:
    found = pattern(template)
    return None if found is None else re.compile(f"(?:{found})", re.IGNORECASE)


def matches(invocation: str, templates: list[str]) -> bool:
    return any(m is not None and m.fullmatch(invocation.strip()) is not None for m in map(matcher, templates))


def balanced(template: str) -> bool:
    waiting = []
    for c in re.sub(r"&?<[^<>]+>", "", template):
        if c in PAIRS:
            waiting.append(PAIRS[c])
        elif c in PAIRS.values() and (not waiting or waiting.pop() != c):
            return False
    return not waiting


def issues(templates: list[str]) -> list[dict]:
    out = []
    for i, t in enumerate(templates):
        code = "unbalanced_syntax" if not balanced(t) else "unsupported_syntax" if pattern(t) is None else None
        if code:
            out.append({"cli_index": i, "cli": t, "code": code, "message": MESSAGES[code]})
    return out


@pandas_udf(T.StringType())
def pattern_of(template: pd.Series) -> pd.Series:
    """The pattern of each template; null if it has none, so that none reaches rlike that it would refuse."""
    return template.map(lambda t: pattern(t) if t is not None else None)


def syntax_issues(clis: Column) -> Column:
    @pandas_udf(ISSUES)
    def found(c: pd.Series) -> pd.Series:
        return c.map(lambda x: issues(list(x) if x is not None else []))

    return found(clis)


def invocation_matches(calls: DataFrame, templates: DataFrame, on: list[str]) -> DataFrame:
    """Calls joined with the templates that they are whole matches of.

    on: the blocking keys, such as the first word; patterns are made once for each distinct template.
    """
    made = templates.withColumn("pattern", pattern_of(F.col("template"))).filter("pattern IS NOT NULL")
    d = calls.join(made, on)
    return d.filter(F.rlike(F.trim("invocation"), F.concat(F.lit("(?iu)^(?:"), "pattern", F.lit(r")\z")))).drop("pattern")
