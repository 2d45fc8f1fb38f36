import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from epochloom.operators import ordering as OR

pytestmark = pytest.mark.usefixtures("many_partitions")


def skewed(rows=5000, seed=1):
    """One key owns most rows; order values repeat and are tied by ``id``."""
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    return pd.DataFrame(
        [(rng.choice(keys), rng.randint(0, 300), i, rng.choice([0, 1, None])) for i in range(rows)],
        columns=["k", "t", "id", "v"],
    ).astype({"v": "Float64"})


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture
def frame(spark, rows):
    records = [
        (k, int(t), int(i), None if pd.isna(v) else float(v)) for k, t, i, v in rows.itertuples(index=False)
    ]
    return spark.createDataFrame(records, "k string, t long, id long, v double").repartition(8)


def by_id(df, column):
    return {r.id: r[column] for r in df.collect()}


def test_number_rows_per_key(frame, rows):
    numbered = OR.number_rows(frame, ["t", "id"], ["k"], "no", total="n")
    got = {r.id: (r.no, r.n) for r in numbered.collect()}
    ordered = rows.sort_values(["t", "id"])
    groups = ordered.groupby("k", dropna=False)
    want = dict(zip(ordered["id"], zip(groups.cumcount(), groups["id"].transform("size"))))
    assert got == {i: (int(a), int(b)) for i, (a, b) in want.items()}


def test_hot_key_spans_partitions(frame):
    ranges = OR.Ranges(frame, ["t", "id"])
    sizes = [r["count"] for r in frame.where("k = 'hot'").groupBy(ranges.place().alias("part")).count().collect()]
    assert len(sizes) == ranges.count == 8 and max(sizes) < 2 * sum(sizes) / ranges.count


def test_number_rows_overall_and_descending(frame, rows):
    got = by_id(OR.number_rows(frame, [F.col("t").desc(), F.col("id")], (), "no"), "no")
    ordered = rows.sort_values(["t", "id"], ascending=[False, True])["id"]
    assert got == {int(i): n for n, i in enumerate(ordered)}


def test_carry_forward(frame, rows):
    got = by_id(OR.carry_forward(frame, "v", ["t", "id"], ["k"], "last"), "last")
    ordered = rows.sort_values(["t", "id"])
    filled = ordered.groupby("k", dropna=False)["v"].ffill()
    want = {int(i): (None if pd.isna(v) else float(v)) for i, v in zip(ordered["id"], filled)}
    assert got == want


@pytest.mark.parametrize("block", [10, 37, 100_000])
def test_rolling_mean_is_independent_of_block_size(frame, rows, block):
    rolled = OR.rolling_mean(frame.fillna(0.0, ["v"]), "v", ["t", "id"], ["k"], 10, "m", "no", block)
    got = by_id(rolled, "m")
    ordered = rows.fillna({"v": 0.0}).sort_values(["t", "id"])
    want = ordered.groupby("k", dropna=False)["v"].transform(
        lambda s: s.astype(float).rolling(10, min_periods=1).mean()
    )
    assert len(got) == len(rows)
    for i, mean in zip(ordered["id"], want):
        assert got[int(i)] == pytest.approx(mean, abs=1e-9)


def test_latest_per_key_keeps_newest_copy(spark):
    df = spark.createDataFrame(
        [(1, 10, "old"), (1, 12, "new"), (2, 5, "only")] + [(1, 11, "copy")] * 500,
        "epoch_id long, event_time long, label string",
    )
    got = {(r.epoch_id, r.label) for r in OR.latest_per_key(df, ["epoch_id"], ["event_time"]).collect()}
    assert got == {(1, "new"), (2, "only")}


def test_tail_and_snapshot(spark):
    df = spark.range(250).select("id", (F.col("id") / 5).cast("long").alias("t"))
    tail = [r.id for r in OR.tail_rows(df, ["t", "id"], 100).collect()]
    assert tail == list(range(150, 250))
    assert {r.id for r in OR.latest_snapshot(df, "t").collect()} == {245, 246, 247, 248, 249}


@pytest.mark.parametrize("sorts", [
    lambda: [F.col("t").desc(), "id"], lambda: [F.col("v").asc_nulls_last(), F.col("id").desc()],
    lambda: [F.col("v").desc_nulls_first(), "t", "id"], lambda: ["s", "id"],
])
def test_number_rows_follows_any_order(frame, sorts):
    sorts = sorts()
    named = frame.withColumns({"s": F.concat(F.lit("a\"b,"), F.col("t").cast("string"))})
    got = [r.id for r in OR.number_rows(named, sorts, (), "no").orderBy("no").collect()]
    assert got == [r.id for r in named.orderBy(*sorts).collect()]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(12,3)", "double", "string", "binary"])
@pytest.mark.parametrize("few", [0, 32])
def test_order_columns_of_any_type(spark, monkeypatch, kind, few):
    """Bounds that are searched, and bounds that are compared one after another."""
    monkeypatch.setattr(OR, "FEW_BOUNDS", few)
    raw = spark.range(700).select(((F.col("id") * 7919) % 701).alias("n"))
    value = {
        "timestamp": F.timestamp_micros(F.col("n") * 777_777_777), "date": F.date_add(F.lit("2020-01-01"), F.col("n").cast("int")),
        "double": F.when(F.col("n") == 5, F.lit(float("nan"))).otherwise(F.col("n") / 3), "binary": F.lpad(F.col("n").cast("string"), 5, "0"),
        "timestamp_ntz": F.timestamp_micros(F.col("n") * 777_777_777),
    }.get(kind, F.col("n"))
    df = raw.select(F.when(F.col("n") != 9, value.cast(kind)).alias("o"), "n")
    got = [r.n for r in OR.number_rows(df, ["o"], (), "no").orderBy("no").collect()]
    assert got == [r.n for r in df.orderBy("o").collect()]


def test_bounds_that_only_a_later_column_tells_apart(spark):
    """The first order columns are the same in every row."""
    df = spark.range(4000).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"), "id")
    ranges = OR.Ranges(df, ["a", "b", "id"])
    sizes = [r["count"] for r in df.groupBy(ranges.place().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    assert [r.no for r in OR.number_rows(df, ["a", "b", "id"], (), "no").orderBy("id").collect()] == list(range(4000))


INTERNAL = (
    "_at _part _pos _first _before _total _rpart _inside _carried _own _block _no _rows _r0 key part at o0 o1 c0 c1 "
    "n no before total filled last carried mean block row_no r r_ rkey rpart rc0 rc3 ro0 C2"
).split()


def test_no_name_of_the_caller_clashes(spark, frame):
    """A frame that holds every name used inside comes back unchanged."""
    wide = frame.select("*", *[(F.col("id") * 10 + 5).alias(n) for n in INTERNAL if n not in frame.columns])
    want = {tuple(r) for r in wide.drop("row_no").collect()}
    outputs = [
        OR.number_rows(wide, ["C2", "rc0", "t", "id"], ["k", "key"], "new", total="new2").drop("new2"),
        OR.carry_forward(wide, "v", ["t", "id"], ["k"], "new"),
        OR.rolling_mean(wide, "id", ["t", "id"], ["k"], 3, "new", "row_no"),
    ]
    for got in outputs:
        assert {tuple(r) for r in got.select(*[c for c in wide.columns if c != "row_no"]).collect()} == want
    numbered = OR.number_rows(wide, ["_at", "part"], ["key"], "n")
    assert {r.n for r in numbered.collect()} == {0} and numbered.columns.count("n") == 1


def test_nothing_is_stored(spark):
    """Numbering reads no stored table and needs one exchange of the rows, beside those of the counts."""
    numbered = OR.number_rows(spark.range(100).withColumn("k", F.col("id") % 3), ["id"], ["k"], "no")
    assert numbered.inputFiles() == []
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4 and "rangepartitioning" not in plan


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t long")
    assert OR.number_rows(df, ["t"], ["k"]).count() == 0
    assert OR.rolling_mean(df, "t", ["t"], ["k"]).count() == 0


def test_small_keys_are_numbered_in_one_range_each(spark):
    """More ranges than the largest key needs would make a count for about each row, and exchange them."""
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), F.xxhash64("id").alias("t"), "id")
    assert OR._Ranged(df, ["k"], ["t", "id"]).rows.select("rkey", "rpart").distinct().count() == 40


def test_large_keys_are_numbered_over_ranges(spark, frame, rows, monkeypatch, many_partitions):
    """As with one range: numbers, values carried forward and rolling means follow the order over all of them."""
    monkeypatch.setattr(OR, "KEY_ROWS", 10)
    ranged = OR._Ranged(frame, ["k"], ["t", "id"])
    assert ranged.rows.select("rpart").distinct().count() > 1
    test_number_rows_per_key(frame, rows)
    test_carry_forward(frame, rows)
    test_rolling_mean_is_independent_of_block_size(frame, rows, 16)


def test_a_numbered_row_carries_each_column_once(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id", F.lit(1.5).alias("v"))
    assert len(OR._Ranged(df, ["k"], ["id", "v"]).rows.columns) == 4  # key, part, id, v
    assert len(OR._Ranged(df, ["k"], [F.col("id").desc(), "k"]).rows.columns) == 5  # an expression travels besides
    got = {r.id: r.no for r in OR.number_rows(df, [F.col("k"), F.col("id").desc()], ["k"], "no").collect()}
    assert got == {i: 4 - i // 2 for i in range(10)}
