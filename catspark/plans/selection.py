"""Order statistics without a sort: the first n rows, or rows m to n, of a table.

Order columns become one byte string that sorts as they do.  Rows are counted
by the first bytes of that string, the prefix that holds the asked position is
kept, and its rows are counted by the next bytes, until one string is left.
Each pass is an aggregate of at most 65,536 counts; no row is moved and
nothing is written.  The rows up to that string are then a plain filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType

STEP = 2  # bytes a pass
_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def order_key(df: DataFrame, order: list[str]) -> Column:
    """Binary key that sorts like ``order`` (ascending, nulls first); whole numbers and strings.

    A string ends with two zero bytes, and a zero byte inside it is followed
    by a one, so that no string's end is mistaken for more of it.
    """
    parts = []
    for name in order:
        kind = df.schema[name].dataType
        c = F.col(name)
        if isinstance(kind, _WHOLE):  # the sign bit turned: 16 digits that sort as the number
            digits = F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
            body = F.unhex(digits)
        elif isinstance(kind, StringType):
            body = F.encode(F.concat(F.replace(c, F.lit("\0"), F.lit("\0\x01")), F.lit("\0\0")),
                            "UTF-8")
        else:
            raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
        parts.append(F.coalesce(F.concat(F.lit(b"\x01"), body), F.lit(b"\x00")))
    return F.concat(*parts)


def key_at(df: DataFrame, key: Column, position: int) -> tuple[bytes, int] | None:
    """(key of the row at ``position``, 1 for the first; rows with smaller keys); None beyond the end."""
    keys = df.select(key.alias("k"))
    prefix, below = b"", 0
    while True:
        n = len(prefix)
        counts = (keys.groupBy(F.substring("k", n + 1, STEP).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"),
                       (F.min("k") == F.max("k")).alias("one")))
        # at most 256 + 256 ** STEP rows
        for r in sorted(counts.collect(), key=lambda r: bytes(r["p"])):
            if below + r["n"] >= position:
                break
            below += r["n"]
        else:
            return None
        if r["one"]:
            return bytes(r["k"]), below
        prefix += bytes(r["p"])
        keys = keys.where(F.substring("k", 1, len(prefix)) == F.lit(prefix))


def rows_between(df: DataFrame, order: list[str], offset: int, nrows: int | None,
                 counted: DataFrame | None = None) -> DataFrame:
    """Rows offset + 1 to offset + nrows of ``df`` in ``order`` (in no particular order).

    Rows that agree in all order columns are interchangeable.  ``counted`` may
    be a written table of the order columns, if ``df`` is costly to read.
    """
    if nrows is not None and nrows <= 0:
        return df.limit(0)
    key = order_key(df, order)
    counted = df if counted is None else counted
    if offset:
        start = key_at(counted, key, offset + 1)
        if start is None:
            return df.limit(0)
        low, before = start
        skip = offset - before  # rows equal to the first one that belong to earlier pages
    else:
        low, skip = None, 0
    stop = None if nrows is None else key_at(counted, key, offset + nrows)
    keyed = df.withColumn("_key", key)
    if stop is None:
        inside = keyed if low is None else keyed.where(F.col("_key") > F.lit(low))
        parts = [inside]
    else:
        high, under = stop
        inside = keyed.where(F.col("_key") < F.lit(high))
        parts = [inside if low is None else inside.where(F.col("_key") > F.lit(low))]
        if low is None or high != low:
            parts.append(keyed.where(F.col("_key") == F.lit(high)).limit(offset + nrows - under))
    if low is not None:
        equal = keyed.where(F.col("_key") == F.lit(low))
        if stop is not None and stop[0] == low:
            parts.append(equal.limit(nrows))
        elif skip:
            parts.append(equal.limit(equal.count() - skip))
        else:
            parts.append(equal)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_key")


def first_rows(df: DataFrame, order: list[str], n: int,
               counted: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``order`` (in no particular order)."""
    return rows_between(df, order, 0, n, counted)
