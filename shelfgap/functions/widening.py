"""Column types that two tables can share without losing a value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE: list[tuple[T.DataType, int]] = [  # and how many decimal digits they may have
    (T.ByteType(), 3),
    (T.ShortType(), 5),
    (T.IntegerType(), 10),
    (T.LongType(), 20),
]
_RANKS = [t for t, _ in _WHOLE]
#: Whole numbers of these types are exact in the floating-point type.
_EXACT_IN = {T.FloatType(): _RANKS[:2], T.DoubleType(): _RANKS[:3]}


def promoted(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds every value of both, or None if there is none.

    Whole numbers go to wider ones, to decimals with room for all their digits, and to floating-point
    numbers that hold them exactly; floats go to doubles, decimals to those with as many digits on
    either side of the point. An untyped NULL goes to anything. All other types have to be equal.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _RANKS and b in _RANKS:
        return _RANKS[max(_RANKS.index(a), _RANKS.index(b))]
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if x in _RANKS and y in _EXACT_IN:
            return y if x in _EXACT_IN[y] else T.DoubleType() if x in _EXACT_IN[T.DoubleType()] else None
        if x in _RANKS and isinstance(y, T.DecimalType):
            return promoted(T.DecimalType(dict(_WHOLE)[x], 0), y)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = scale + max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def aligned(existing: DataFrame, incoming: DataFrame, evolve: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both tables with one type per common column.

    Incoming columns are widened to the existing type. With ``evolve`` an existing column is widened
    as well where the incoming type is the wider one. Any other difference raises, as does, without
    ``evolve``, a column that one side lacks.
    """
    ours = {f.name: f.dataType for f in existing.schema}
    theirs = {f.name: f.dataType for f in incoming.schema}
    if not evolve and set(ours) != set(theirs):
        raise ValueError(f"columns differ: {sorted(set(ours) ^ set(theirs))}")
    types = {}
    for name in ours.keys() & theirs.keys():
        common = promoted(ours[name], theirs[name])
        if common is None or (common != ours[name] and not evolve):
            was, new = ours[name].simpleString(), theirs[name].simpleString()
            raise ValueError(f"column {name}: {new} does not fit into {was}")
        types[name] = common
    return _typed(existing, types), _typed(incoming, types)


def _typed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    columns = []
    for f in df.schema:
        wanted = types.get(f.name, f.dataType)
        column = F.col(f"`{f.name}`")
        columns.append(column if wanted == f.dataType else column.cast(wanted).alias(f.name))
    return df.select(*columns)
