"""A keyed permutation of 0..n-1 as a column expression.

The domain is a grid of ``a`` by ``b`` cells with ``a = ceil(sqrt(n))`` and
``b = ceil(n / a)``, so it exceeds n by fewer than ``a`` cells. Each Feistel
round adds a keyed mix of one coordinate to the other, modulo its side, which
can be undone; the whole is a permutation of the grid. Cycle walking repeats it
until the value falls below n. That is a permutation of 0..n-1, and a value
needs another step with a chance below 1/sqrt(n) only.

All of it is integer arithmetic on values below 2**63, evaluated in the JVM.
``permute_int`` and ``invert_int`` compute the same on Python integers, for
readers who want one slot.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Steps that one expression walks; ``walk_all`` adds passes for rows that need more.
WALK = 12
_MASK = (1 << 31) - 1


def grid(n: int) -> tuple[int, int]:
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _round_keys(key: int) -> list[tuple[int, int]]:
    out, x = [], (key * 2 + 1) & _MASK
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % _MASK
        y = x
        x = (x * 48271 + 11) % _MASK
        out.append((y | 1, x))
    return out


def _mix_int(v: int, mul: int, add: int) -> int:
    v = ((v % _MASK) * mul + (v // _MASK) + add) % _MASK
    v = v ^ (v >> 15)
    v = (v * 1103515245 + 12345) % _MASK
    return v ^ (v >> 13)


def _step_int(x: int, a: int, b: int, keys: list[tuple[int, int]]) -> int:
    left, right = x // b, x % b
    for i, (mul, add) in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mix_int(right, mul, add)) % a
        else:
            right = (right + _mix_int(left, mul, add)) % b
    return left * b + right


def permute_int(x: int, n: int, key: int) -> int:
    """Slot of row number ``x``; the same value as the column expression."""
    (a, b), keys = grid(n), _round_keys(key)
    y = _step_int(x, a, b, keys)
    while y >= n:
        y = _step_int(y, a, b, keys)
    return y


def invert_int(slot: int, n: int, key: int) -> int:
    """Row number that was given ``slot``."""
    (a, b), keys = grid(n), _round_keys(key)
    y = slot
    while True:
        left, right = y // b, y % b
        for i, (mul, add) in reversed(list(enumerate(keys))):
            if i % 2 == 0:
                left = (left - _mix_int(right, mul, add)) % a
            else:
                right = (right - _mix_int(left, mul, add)) % b
        y = left * b + right
        if y < n:
            return y


def _step(x: str, a: int, b: int, keys: list[tuple[int, int]]) -> str:
    """SQL of one pass over the grid, as a fold over the round keys."""
    rounds = ",".join(f"struct({i % 2} AS odd, {mul}L AS m, {add}L AS c)" for i, (mul, add) in enumerate(keys))
    mixed = lambda v: (
        f"transform(transform(transform(array((({v} % {_MASK}L) * r.m + {v} div {_MASK}L + r.c) % {_MASK}L),"
        f" v -> v ^ shiftright(v, 15)), v -> (v * 1103515245L + 12345L) % {_MASK}L), v -> v ^ shiftright(v, 13))[0]")
    left = f"if(r.odd = 0, (s.l + {mixed('s.r')}) % {a}L, s.l)"
    right = f"if(r.odd = 1, (s.r + {mixed('s.l')}) % {b}L, s.r)"
    return (f"aggregate(array({rounds}), struct({x} div {b}L AS l, {x} % {b}L AS r),"
            f" (s, r) -> struct({left} AS l, {right} AS r), s -> s.l * {b}L + s.r)")


def permute(column: str, n: int, key: int) -> Column:
    """The permuted value of a long column in 0..n-1; ``WALK`` steps at most, see ``walk_all``."""
    (a, b), keys = grid(n), _round_keys(key)
    return F.expr(f"aggregate(sequence(1, {WALK - 1}), {_step(f'`{column}`', a, b, keys)},"
                  f" (y, i) -> if(y < {n}L, y, {_step('y', a, b, keys)}))")


def walk_all(df: DataFrame, column: str, n: int, key: int) -> DataFrame:
    """Walk on the rows of a written table whose value in ``column`` is still outside 0..n-1.

    A row is left over with a chance below n**(-WALK/2), so this reads one
    maximum and returns the table itself, save for very small n.
    """
    while (df.agg(F.max(column)).first()[0] or 0) >= max(n, 1):
        df = df.withColumn(column, F.when(F.col(column) < n, F.col(column)).otherwise(permute(column, n, key)))
    return df
