"""Registry of named queries: a Spark plan plus (when SQL can express it) an
independent SQL formulation used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _wrap_rounds(sql)
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def _wrap_rounds(sql: str) -> str:
    """``round(x, k)`` → ``(round(x, k) + 0.0)``: SQL engines may return
    negative zero where Spark returns 0.0; adding +0.0 normalises it."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                break
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("(round(" + _wrap_rounds(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1
    return "".join(out)


def rnd(c, name: str | None = None, digits: int = 6):
    """Round as ``round(x·10^d)/10^d`` with halves away from zero: the same
    double a SQL engine's round(x, d) returns, even at decimal ties (a plain
    decimal-string round can differ there), and never negative zero."""
    from pyspark.sql import functions as F
    scale = float(10 ** digits)
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col * F.lit(scale)) / F.lit(scale) + F.lit(0.0)
    return out.alias(name) if name else out


def pyround(x: float, digits: int = 6) -> float:
    import math
    y = x * float(10 ** digits)
    return math.copysign(math.floor(abs(y) + 0.5), y) / float(10 ** digits) + 0.0
