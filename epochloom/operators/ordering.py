"""Row numbers, rolling means and fill-forward that hold when one key owns most of the rows.

A plain window sorts all rows of a key in one task. Here the order is cut into ranges first, by bounds from a
sorted sample that become literals of the plan, so every use and every retry sees the same ranges. Rows are
numbered inside (key, range) groups, however hot a key is; counts per group combine before their shuffle, and
their running sums are added. There are as many ranges as the largest key needs. Nothing is stored: the input is
read for its count, the sample, the counts and the rows, so store one that is dear to compute. It must be deterministic, and the order total over
``keys + order``; rows that tie on it keep an arbitrary order. The caller's columns travel under names of
their own, so none can clash with the names used here.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.functions.columns import column
from epochloom.shared import shuffles_released

BLOCK_ROWS = 100_000
#: Rows of a key that need no more than one range.
KEY_ROWS = 10_000
#: Ranges are as many as the session's shuffle partitions, up to this; the sample has ``SAMPLED`` rows for each.
MOST_RANGES = 4096
SAMPLED = 32
#: So many bounds are compared one after another in generated code; more are searched.
FEW_BOUNDS = 32


class _Sort:
    """One item of an order: its value, direction and place of NULLs."""

    def __init__(self, item):
        self.value, self.down, self.nulls_first = item, False, True
        if isinstance(item, str):
            self.value = column(item)
        elif item._jc.node().getClass().getSimpleName() == "SortOrder":
            node = item._jc.node()
            self.down = "Descending" in node.sortDirection().toString()
            self.nulls_first = "NullsFirst" in node.nullOrdering().toString()
            java = SparkSession.active().sparkContext._jvm.org.apache.spark.sql.Column
            self.value = type(item)(java(node.child()))

    def sorted(self, value: Column) -> Column:
        if self.down:
            return value.desc_nulls_first() if self.nulls_first else value.desc_nulls_last()
        return value.asc_nulls_first() if self.nulls_first else value.asc_nulls_last()

    def before(self, a: Column, b: Column) -> Column:
        """Whether ``a``, which differs from ``b``, sorts before it."""
        return F.coalesce(a > b if self.down else a < b, a.isNull() if self.nulls_first else b.isNull())


class Ranges:
    """Consecutive ranges of an order, by bounds that are literals of every plan that uses them.

    Bounds are drawn from a sorted sample when this is made. Equal values share a range; each range holds
    about as many of the rows as any other.
    """

    def __init__(self, df: DataFrame, order: Sequence, count: int | None = None, rows: int | None = None):
        self.sorts, self.count = [_Sort(item) for item in order], 1
        self._kinds, self._picked = "", []
        ranges = min(MOST_RANGES, count or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        values = df.select(F.struct(*[s.value.alias(f"o{i}") for i, s in enumerate(self.sorts)]).alias("at"))
        rows = (values.count() if rows is None else rows) if ranges > 1 else 0
        if not rows:
            return
        share = SAMPLED * ranges / rows
        drawn = (values.sample(share, seed=1) if share < 1 else values).repartition(1).sortWithinPartitions(
            *[s.sorted(F.col(f"at.o{i}")) for i, s in enumerate(self.sorts)]
        )
        sample = [r.at for r in drawn.select(F.to_json("at").alias("at")).collect()]  # SAMPLED rows for each range
        if not sample:
            return
        picked, names = [json.loads(sample[len(sample) * i // ranges]) for i in range(1, ranges)], values.schema["at"].dataType.names
        # as few order columns as tell the bounds apart
        tuples = [tuple(str(bound.get(name)) for name in names) for bound in picked]
        self._width = next(w for w in range(1, len(names) + 1) if len({t[:w] for t in tuples}) == len(set(tuples)))
        kept = T.StructType(values.schema["at"].dataType.fields[: self._width])
        self._kinds, self.count = kept.simpleString(), ranges
        self._picked = [json.dumps({n: bound[n] for n in kept.names if n in bound}) for bound in picked]

    def place(self, values: Sequence[Column] | None = None) -> Column:
        """The range of a row: how many bounds its order values, or ``values`` in their place, have reached."""
        if not self._picked:
            return F.lit(0)
        mine = ([s.value for s in self.sorts] if values is None else values)[: self._width]
        bounds = F.from_json(F.lit("[" + ",".join(self._picked) + "]"), f"array<{self._kinds}>")

        def reached(bound: Column) -> Column:
            result = F.lit(True)
            for i, (s, value) in reversed(list(enumerate(zip(self.sorts, mine)))):
                edge = bound.getField(f"o{i}")
                result = F.when(edge.eqNullSafe(value), result).otherwise(s.before(edge, value))
            return result

        if len(self._picked) <= FEW_BOUNDS:
            return sum((reached(F.get(bounds, F.lit(i))).cast("int") for i in range(len(self._picked))), F.lit(0))
        return _reached(bounds, len(self._picked), reached)


def _reached(bounds: Column, count: int, reached) -> Column:
    """How many of ``count`` ascending ``bounds`` are reached, found by halving steps."""
    steps = [1 << k for k in reversed(range(count.bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step <= count) & reached(F.get(bounds, at + step - 1)), at + step).otherwise(at),
    )


class _Ranged:
    """``df`` under names of its own, which no column of the caller's begins with in any case of letters.

    ``key`` (one struct), ``part``, and one column for each other of the caller's and of the order. What a row
    carries goes through a shuffle, so nothing is in it twice: keys are read from the struct, and an item of the
    order that is one of the caller's columns from there.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence):
        self.names, sorts, self.tag = df.columns, [_Sort(item) for item in order], "r"
        while any(name.lower().startswith(self.tag) for name in self.names):
            self.tag += "_"
        self.on = [f"{self.tag}key", f"{self.tag}part"]
        ranges = Ranges(df, order, *_sizes(df, keys))
        key = F.struct(*[column(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0))
        self.columns = {k: F.col(self.on[0])[f"k{i}"] for i, k in enumerate(keys) if k in self.names}
        carried = {n: f"{self.tag}c{i}" for i, n in enumerate(self.names) if n not in self.columns}
        self.columns |= {n: F.col(c) for n, c in carried.items()}
        computed = {
            f"{self.tag}o{i}": s.value for i, (s, item) in enumerate(zip(sorts, order))
            if not (isinstance(item, str) and item in self.columns)
        }
        self.rows = df.select(
            *[column(name).alias(c) for name, c in carried.items()],
            *[value.alias(name) for name, value in zip(self.on, (key, ranges.place()))],
            *[value.alias(name) for name, value in computed.items()],
        )
        self.inside = Window.partitionBy(*self.on).orderBy(*[
            s.sorted(F.col(o) if (o := f"{self.tag}o{i}") in computed else self.columns[item])
            for i, (s, item) in enumerate(zip(sorts, order))
        ])
        self.all = Window.partitionBy(self.on[0])
        self.earlier = self.all.orderBy(self.on[1]).rowsBetween(Window.unboundedPreceding, -1)

    def own(self, name: str) -> Column:
        return self.columns[name]

    def named(self, df: DataFrame, **more: Column) -> DataFrame:
        """The caller's columns under their names; those of ``more`` replace or follow them."""
        kept = [self.own(n).alias(n) for n in self.names if n not in more]
        return df.select(*kept, *[value.alias(name) for name, value in more.items()])


def _sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int | None, int | None]:
    """How many ranges the order needs for the largest key, and the rows of all; nothing without keys.

    Ranges cut every key, so that of more than the largest one needs, small keys would make a count for each row.
    """
    if not keys:
        return None, None
    with shuffles_released(df.sparkSession):
        most, rows = df.groupBy(*map(column, keys)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    most_ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most_ranges, -(-(most or 0) // KEY_ROWS))), rows or 0


def number_rows(
    df: DataFrame,
    order: Sequence,
    keys: Sequence[str] = (),
    name: str = "row_no",
    total: str | None = None,
) -> DataFrame:
    """Zero-based row number per key in ``order``; ``total`` names a column for the key's row count."""
    ranged = _Ranged(df, keys, order)
    sizes = ranged.rows.groupBy(*ranged.on).agg(F.count(F.lit(1)).alias("n")).select(
        *ranged.on, F.coalesce(F.sum("n").over(ranged.earlier), F.lit(0)).alias("before"),
        F.sum("n").over(ranged.all).alias("total"),
    )
    numbered = ranged.rows.withColumn("no", F.row_number().over(ranged.inside).cast("long")).join(sizes, ranged.on)
    more = {name: F.col("no") - 1 + F.col("before")}
    if total:
        more[total] = F.col("total")
    return ranged.named(numbered, **more)


def carry_forward(
    df: DataFrame, value: str, order: Sequence, keys: Sequence[str], name: str
) -> DataFrame:
    """Last non-null ``value`` at or before each row of its key, in ``order``."""
    ranged = _Ranged(df, keys, order)
    filled = ranged.rows.withColumns({
        "filled": F.last(ranged.own(value), ignorenulls=True).over(ranged.inside), "no": F.row_number().over(ranged.inside),
    })
    last = filled.groupBy(*ranged.on).agg(F.max_by("filled", "no").alias("last")).select(
        *ranged.on, F.last("last", ignorenulls=True).over(ranged.earlier).alias("carried")
    )
    return ranged.named(filled.join(last, ranged.on), **{name: F.coalesce("filled", "carried")})


def rolling_mean(
    df: DataFrame,
    value: str,
    order: Sequence,
    keys: Sequence[str] = (),
    size: int = 10,
    name: str = "rolling",
    index: str = "row_no",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean of ``value`` over the current and up to ``size - 1`` preceding rows of a key.

    A key is cut into blocks of ``block_rows``. The last ``size - 1`` rows of a block are
    copied to the next one, which makes every block independent of the others.
    """
    block_rows = max(block_rows, size)
    numbered = number_rows(df, order, keys, index)
    names = numbered.columns
    mine = {n: f"c{i}" for i, n in enumerate(names)}
    at = F.col(mine[index])
    own = F.floor(at / block_rows)
    block = F.explode(F.when(at % block_rows > block_rows - size, F.array(own, own + 1)).otherwise(F.array(own)))
    copies = numbered.toDF(*mine.values()).select("*", block.alias("block"))
    span = Window.partitionBy(*[mine[k] for k in keys], "block").orderBy(mine[index]).rowsBetween(1 - size, 0)
    rolled = copies.withColumn("mean", F.avg(mine[value]).over(span)).where(F.col("block") == own)
    kept = [F.col(c).alias(n) for n, c in mine.items() if n not in (index, name)]
    return rolled.select(*kept, at.alias(index), F.col("mean").alias(name))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple. Copies collapse before the shuffle."""
    rest = [name for name in df.columns if name not in set(keys)]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(name) if name in set(keys) else F.col(f"_row.{name}") for name in df.columns]
    )


def tail_rows(df: DataFrame, order: Sequence[str], count: int) -> DataFrame:
    """Last ``count`` rows in ``order``, returned in ascending order."""
    newest = df.orderBy(*[F.col(name).desc() for name in order]).limit(count)
    return newest.orderBy(*order)


def latest_snapshot(df: DataFrame, time: str) -> DataFrame:
    """Rows that carry the greatest ``time``."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())
