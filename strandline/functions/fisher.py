"""One-sided Fisher's exact test on [[a, b], [c, d]] and its phred score, as column expressions."""

from __future__ import annotations

from itertools import accumulate
from math import log, pi

from pyspark.sql import Column
from pyspark.sql import functions as F


#: ln n! below this number is looked up; from it on four terms of Stirling's series leave less than 2e-14.
SMALL = 16
LOG_FACTORIALS = [0.0, *accumulate(log(k) for k in range(1, SMALL))]


def log_factorial(n: Column) -> Column:
    """ln n!, at a cost that does not depend on n; 0 for n below 1."""
    x = F.greatest(n, F.lit(SMALL).cast("long")).cast("double")
    series = x * F.ln(x) - x + 0.5 * F.ln(2 * pi * x) + (1 - (1 - (2 / 7 - 3 / (14 * x * x)) / (x * x)) / (30 * x * x)) / (12 * x)
    return F.when(n >= SMALL, series).otherwise(F.get(F.array(*[F.lit(v) for v in LOG_FACTORIALS]), F.greatest(n, F.lit(0).cast("long")).cast("int")))


def point(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Hypergeometric probability of the table."""
    return F.exp(log_factorial(a + b) + log_factorial(c + d) + log_factorial(a + c) + log_factorial(b + d) - log_factorial(a + b + c + d) - log_factorial(a) - log_factorial(b) - log_factorial(c) - log_factorial(d))


def tail(a: Column, b: Column, c: Column, d: Column, right: bool = True) -> Column:
    """Sum of point probabilities from the table on: a and d grow and b and c shrink (right), or the reverse. Each next term follows from the last by a ratio."""
    steps = (F.least(b, c) if right else F.least(a, d)).cast("int")
    zero = F.struct(point(a, b, c, d).alias("p"), F.lit(0.0).alias("sum"))
    x = [v.cast("double") for v in (a, b, c, d)]

    def step(acc, k):
        k = k.cast("double")
        up, down = ((x[1], x[2]), (x[0], x[3])) if right else ((x[0], x[3]), (x[1], x[2]))
        ratio = (up[0] - k) * (up[1] - k) / ((down[0] + k + 1) * (down[1] + k + 1))
        return F.struct((acc["p"] * ratio).alias("p"), (acc["sum"] + acc["p"]).alias("sum"))

    # the sequence has one step for each further table, and the fold adds the term that it leaves
    return F.aggregate(F.sequence(F.lit(0), steps), zero, step, lambda acc: acc["sum"])


def p_value(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Right tail; where it is .999 or more, the left tail."""
    p = tail(a, b, c, d)
    return F.when(p >= 0.999, tail(a, b, c, d, right=False)).otherwise(p)


def phred_score(p: Column) -> Column:
    """round(-10 log10 p), at most 255; p = 0 gives 255, NaN counts as p = 1."""
    p = F.when(F.isnan(p), 1.0).otherwise(p)
    return F.when(p <= 0, 255).otherwise(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(-10 * F.log10(F.least(p, F.lit(1.0))) + 0.5)))).cast("long")


def p_text(p: Column) -> Column:
    return F.format_string("%1.2e", p)
