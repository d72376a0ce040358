"""Ratios rounded to two decimals the way exact binary half-up rounding does, in integers."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Odd k for which k / 200 as a double is not below k / 200: ties that round up.
TIES_UP = [k for k in range(1, 200, 2) if Fraction(k / 200) >= Fraction(k, 200)]


def div(a: Column, b: Column) -> Column:
    """Integer division; null where b is 0."""
    return F.when(b != 0, F.call_function("div", a, b))


def hundredths(c: Column, t: Column) -> Column:
    """round(c / t, 2) in hundredths, for integers; null where t is 0."""
    c, t = c.cast("long"), t.cast("long")
    k = div(200 * c, t)
    tie = (F.when(t != 0, 200 * c % t) == 0) & (k % 2 == 1)
    return F.when(tie & k.isin(TIES_UP), div(k + 1, F.lit(2))).when(tie & (k < 200), div(k - 1, F.lit(2))).otherwise(div(200 * c + t, 2 * t))


def let(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with a name for a value that it reads more than once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hundredths_text(c: str, t: str) -> str:
    """``hundredths`` as SQL text."""
    ups = "".join("1" if k in TIES_UP else "0" for k in range(200))
    k = "(200L * z.c div z.t)"
    tie = f"200L * z.c % z.t = 0 AND {k} % 2 = 1"
    body = f"CASE WHEN {tie} AND substring('{ups}', cast(least({k}, 200L) + 1 AS int), 1) = '1' THEN ({k} + 1) div 2 WHEN {tie} AND {k} < 200 THEN ({k} - 1) div 2 ELSE (200L * z.c + z.t) div (2L * z.t) END"
    return let("z", f"named_struct('c', cast({c} AS bigint), 't', nullif(cast({t} AS bigint), 0L))", body)


def least_twice(h: int) -> tuple[int, int]:
    """(a, b) so that ``hundredths(c, t)`` >= h just where 400 * c >= a * t + b, for c >= 0 and t > 0."""
    k = 2 * h - 1
    return 2 * k, int(0 < k < 200 and k not in TIES_UP)


def at_least_text(c: str, t: str, h: int) -> str:
    """``hundredths(c, t)`` >= h as SQL text without the quotient: one comparison; null where t is 0."""
    a, b = least_twice(h)
    return f"400L * {c} >= {a}L * nullif(cast({t} AS bigint), 0L) + {b}L"


def ratio2(c: Column, t: Column) -> Column:
    return hundredths(c, t) / 100.0


def floor2(c: Column, t: Column) -> Column:
    """floor(c / t * 100) / 100 in plain doubles; 0 where t is 0."""
    return F.when(t > 0, F.floor(c.cast("double") / t.cast("double") * 100) / 100.0).otherwise(0.0)


def mean(total: Column, n: Column) -> Column:
    """Integer mean, halves up; null where n is 0."""
    total, n = total.cast("long"), n.cast("long")
    return div(2 * total + n, 2 * n)


def hundredths_sql(c: str, t: str) -> str:
    ups = ", ".join(map(str, TIES_UP))
    k = f"((200 * ({c})) // nullif(({t}), 0))"
    return (
        f"(CASE WHEN (200 * ({c})) % nullif(({t}), 0) = 0 AND {k} % 2 = 1 AND {k} IN ({ups}) THEN ({k} + 1) // 2"
        f" WHEN (200 * ({c})) % nullif(({t}), 0) = 0 AND {k} % 2 = 1 AND {k} < 200 THEN ({k} - 1) // 2"
        f" ELSE (200 * ({c}) + ({t})) // nullif(2 * ({t}), 0) END)"
    )
