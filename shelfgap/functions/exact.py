"""Sums and means of doubles that do not depend on the order of the rows.

Floating-point addition is not associative, so a shuffled sum may change in its last digits between
runs and flip ties in a later ranking. Here every double is taken apart into whole numbers, which add
up exactly in any order. A value falls into a bin of 64 powers of two; within the bin it is a whole
multiple of one unit, cut into limbs of 22 bits, so that a limb's sum stays within a long for 2^41
rows. Rows are first added per key and bin, of which amounts of one kind mostly have one, then the few
bins of a key are put together from the largest down. The result is the exact sum of the values,
rounded once; all bins go the same way, whatever the values are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_BITS = 64
LIMB_BITS = 22
LIMBS = 6
#: The lowest bit of a value, 52 below its highest one, is in the bin; one more for a logarithm that
#: is rounded down too far.
_BELOW = BIN_BITS // 2 + 53
_SPECIAL = 1 << 10  # the bin of infinities and of what is no number

#: An aggregate of the rows, and the one that puts its partial results together.
Partial = tuple[Column, Callable[[Column], Column]]


# Expressions are SQL text, where a column may use those before it in the same list; as columns built
# one by one they would take seconds to put together.


def _factors(of_bin: str, sign: str) -> tuple[str, str]:
    """Two factors that lead from values to units of a bin (``sign`` is -) or back (+). One alone may
    be beyond a double."""
    up = f"({sign}({of_bin} * {BIN_BITS} - {_BELOW}))"
    half = f"floor({up} / 2)"
    return f"pow(2D, {half})", f"pow(2D, {up} - {half})"


def _binned(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each value ``v`` as its bin ``v_b`` (NULL for zero) and limbs ``v_0`` and so on, below zero with
    it."""
    half = BIN_BITS // 2
    columns = []
    for v in names:
        far, more = _factors(f"{v}_b", "-")
        columns += [
            f"abs({v}) as {v}_a",
            f"""case when {v}_a = 0 then null
              when {v}_a >= {2.0**-half!r}D and {v}_a < {2.0**half!r}D then 0
              when isnan({v}_a) or {v}_a = double('infinity') then {_SPECIAL}
              else int(floor((floor(log2({v}_a)) + {half}) / {BIN_BITS})) end as {v}_b""",
            f"""case when {v}_b = 0 then {v}_a * {2.0**_BELOW!r}D
              when {v}_b <> {_SPECIAL} then {v}_a * {far} * {more} end as {v}_r{LIMBS}""",
        ]
        for k in range(LIMBS - 1, -1, -1):
            unit = f"{2.0 ** (k * LIMB_BITS)!r}D"
            columns.append(f"floor({v}_r{k + 1} / {unit}) as {v}_q{k}")
            columns.append(f"{v}_r{k + 1} - {v}_q{k} * {unit} as {v}_r{k}")
        columns += [f"if({v} < 0, -{v}_q{k}, {v}_q{k}) as {v}_{k}" for k in range(LIMBS)]
    return df.selectExpr("*", *columns)


_PIECES = ("t3", "t2", "t1", "t0")


def _in_pieces(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The limbs' sums of each value as four doubles ``v_t3`` to ``v_t0``, largest first, that hold them
    exactly: all but the first are below the next one's unit in size. Carries are cut towards zero, so
    no piece is larger than the sum asks for."""
    unit = 1 << LIMB_BITS
    columns = []
    for v in names:
        columns.append(f"{v}_0 as {v}_c0")
        for k in range(LIMBS - 1):
            columns.append(f"{v}_{k + 1} + ({v}_c{k} div {unit}) as {v}_c{k + 1}")
            columns.append(f"{v}_c{k} % {unit} as {v}_m{k}")
        far, more = _factors(f"{v}_b", "+")
        columns += [f"{far} as {v}_f", f"{more} as {v}_g"]
        pairs = [f"{v}_m{k} + {v}_m{k + 1} * {unit}" for k in (2, 0)]
        for name, x, limb in zip(_PIECES, (f"{v}_c5", f"{v}_m4", *pairs), (5, 4, 2, 0)):
            columns.append(f"double({x}) * {2.0 ** (limb * LIMB_BITS)!r}D * {v}_f * {v}_g as {v}_{name}")
    return df.selectExpr("*", *columns)


def _left(a: str, b: str, whole: str, away: str) -> str:
    """What rounding ``a + b`` to ``whole`` has left out, where ``away`` is ``whole - a``; nothing
    beyond all doubles."""
    left = f"({a} - ({whole} - {away})) + ({b} - {away})"
    return f"if(abs({whole}) = double('infinity'), 0D, {left})"


def _rounded(s: str, c: str, d: str) -> str:
    """The sum of three numbers of which each is less than the last bit of the one before: the first,
    unless the second is just half of that bit, which the third then decides."""
    tie = f"signum({c}) * signum({d}) > 0 and ({s} + {c} * 2) - {s} = {c} * 2"
    return f"if({tie}, {s} + {c} * 2, {s})"


#: The additions that make the sum of four pieces: (first, second, name of the sum, of what is left).
#: What an addition leaves out goes to a second number, and what that leaves out to a third.
_STEPS = [
    ("t3", "t2", "s1", "e1"),
    ("s1", "t1", "s2", "e2"),
    ("s2", "t0", "s3", "e3"),
    ("e1", "e2", "c1", "f1"),
    ("c1", "e3", "c2", "f2"),
    ("f1", "f2", "d1", "x1"),
    ("s3", "c2", "s4", "c3"),
    ("c3", "d1", "c4", "d2"),
    ("s4", "c4", "s5", "c5"),
]


def _of_one_bin(v: str) -> list[str]:
    """``v_one``: the sum of the pieces of the only bin, rounded once."""
    columns = [f"coalesce(get({v}_parts, 0).{t}, 0D) as {v}_{t}" for t in _PIECES]
    for a, b, whole, left in _STEPS:
        a, b, w = f"{v}_{a}", f"{v}_{b}", f"{v}_{whole}"
        columns += [f"{a} + {b} as {w}", f"{w} - {a} as {w}_y", f"{_left(a, b, w, f'{w}_y')} as {v}_{left}"]
    return [*columns, f"{_rounded(f'{v}_s5', f'{v}_c5', f'{v}_d2')} as {v}_one"]


def _let(value: str, name: str, then: str) -> str:
    """``then`` with a name for a value that is computed once: that of a list of one element."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _plus(a: str, b: str, name: str, then: Callable[[str, str], str]) -> str:
    """``then`` of the rounded sum and of what the rounding has left out."""
    left = _left(f"{name}a.a", f"{name}a.b", f"{name}a.w", f"({name}a.w - {name}a.a)")
    done = _let(f"named_struct('w', {name}a.w, 'l', {left})", f"{name}b", then(f"{name}b.w", f"{name}b.l"))
    return _let(f"named_struct('a', {a}, 'b', {b}, 'w', {a} + {b})", f"{name}a", done)


def _of_many_bins(parts: str) -> str:
    """The same for keys of several bins, from the largest down."""

    def state(s: str, c: str, d: str) -> str:
        return f"named_struct('s', {s}, 'c', {c}, 'd', {d})"

    add = _plus("n.s", "x", "p", lambda s, e: _plus("n.c", e, "q", lambda c, f: state(s, c, f"n.d + {f}")))
    upper = _plus("n.s", "n.c", "p", lambda s, c: state(s, c, "n.d"))
    lower = _plus("n.c", "n.d", "p", lambda c, d: state("n.s", c, d))
    pieces = ", ".join(f"part.{t}" for t in _PIECES)
    terms = f"flatten(transform(sort_array({parts}, false), part -> array({pieces})))"
    whole = f"aggregate({terms}, {state('0D', '0D', '0D')}, (n, x) -> {add})"
    for narrow in (upper, lower, upper):
        whole = _let(whole, "n", narrow)
    return _let(whole, "n", _rounded("n.s", "n.c", "n.d"))


def totals(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    means: Mapping[str, Column] | None = None,
    others: Mapping[str, Partial] | None = None,
) -> DataFrame:
    """One row per key with sums and means of doubles, NULL if all values are, and ``others``.

    Any infinity or NaN among the values makes the result what adding them in any order would.
    """
    sums, means, others = sums or {}, means or {}, others or {}
    values = {f"_v{n}": c.cast("double") for n, c in enumerate([*sums.values(), *means.values()])}
    binned = _binned(df.withColumns(values), list(values))
    first, again = [], []
    for v in values:
        whole = [F.sum(f"{v}_{k}").alias(f"{v}_{k}") for k in range(LIMBS)]
        odd = F.sum(F.when(F.col(f"{v}_b") == _SPECIAL, F.col(v))).alias(f"{v}_odd")
        first += [*whole, odd, F.count(v).alias(f"{v}_n")]
        part = F.struct(F.col(f"{v}_b").alias("b"), *[F.col(f"{v}_{t}").alias(t) for t in _PIECES])
        kept = F.col(f"{v}_b").isNotNull() & (F.col(f"{v}_b") != _SPECIAL)
        again += [
            F.collect_list(F.when(kept, part)).alias(f"{v}_parts"),
            F.sum(f"{v}_odd").alias(f"{v}_odd"),
            F.sum(f"{v}_n").alias(f"{v}_n"),
        ]
    first += [column.alias(name) for name, (column, _) in others.items()]
    again += [merge(F.col(name)).alias(name) for name, (_, merge) in others.items()]
    per_bin = binned.groupBy(*keys, *[f"{v}_b" for v in values]).agg(*first)
    merged = _in_pieces(per_bin, list(values)).groupBy(*keys).agg(*again)
    merged = merged.selectExpr("*", *[c for v in values for c in _of_one_bin(v)])

    def total(v: str) -> Column:
        exact = f"if(size({v}_parts) <= 1, {v}_one, {_of_many_bins(f'{v}_parts')})"
        return F.expr(f"if({v}_n > 0, coalesce({v}_odd, {exact}), null)")

    named = list(zip([*sums, *means], values))
    results = [total(v).alias(name) for name, v in named[: len(sums)]]
    results += [F.try_divide(total(v), F.col(f"{v}_n")).alias(name) for name, v in named[len(sums) :]]
    return merged.select(*keys, *results, *others)
