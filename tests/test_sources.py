import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.operators.epochs import EPOCH
from epochloom.plans import batch
from epochloom.shared import shared_path
from epochloom.sources import edf, landing, manifests, runs
from epochloom.sources.edf_write import encode_recording

RATE = 160


def recording(seed, seconds=6, notes=((0, 2, "T1"), (1, 2, "T2"), (4, 1, "T1"))):
    rng = np.random.default_rng(seed)
    signals = {name: rng.uniform(-2e-4, 2e-4, RATE * seconds) for name in ("C3..", "Cz..", "C4..")}
    data = encode_recording(signals, RATE, {n: (-200, 200) for n in signals}, notes, unit="uV")
    return signals, data


def encode_micro(seed):
    """The same recording with samples given in microvolts, as files hold them."""
    signals, _ = recording(seed)
    micro = {n: v * 1e6 for n, v in signals.items()}
    return signals, encode_recording(micro, RATE, {n: (-200, 200) for n in micro},
                                     ((0, 2, "T1"), (1, 2, "T2"), (4, 1, "T1")), unit="uV")


@pytest.fixture
def root(tmp_path):
    originals = {}
    for subject, run, seed in (("S001", "R03", 1), ("S001", "R04", 2), ("S002", "R03", 3)):
        (tmp_path / subject).mkdir(exist_ok=True)
        originals[(subject, run)], data = encode_micro(seed)
        (tmp_path / subject / f"{subject}{run}.edf").write_bytes(data)
    (tmp_path / "S002" / "S002R04.edf").write_bytes(data[:300])  # ends inside the signal headers
    (tmp_path / "S002" / "S002R01.edf").write_bytes(data)  # not a motor run
    (tmp_path / "S002" / "notes.txt").write_text("x")
    return tmp_path, originals


@pytest.mark.parametrize("range_bytes", [1, 1 << 23])
def test_decode(spark, root, range_bytes):
    path, originals = root
    samples, status = edf.decode_recordings(manifests.recording_files(spark, str(path)), range_bytes=range_bytes)
    states = {(r.subject_id, r.run_id): r for r in status.collect()}
    assert len(states) == 5 and states[("S002", "R04")].status == "errors" and states[("S002", "R04")].error
    rows = samples.where("subject_id = 'S001' and run_id = 'R04'").orderBy("time").collect()
    assert len(rows) == 960 and rows[1].time == pytest.approx(1 / RATE)
    for name, signal in originals[("S001", "R04")].items():
        assert np.allclose([r[name] for r in rows], signal, atol=4e-9)
    labels = [rows[t * RATE].task_label for t in range(6)]
    assert labels == ["T1", "T2", "T2", "T0", "T1", "T0"]


def test_a_truncated_recording_lands_once_it_is_whole(spark, root, tmp_path):
    path, _ = root
    file, landing_path = path / "S001" / "S001R03.edf", str(tmp_path / "landing")
    whole = file.read_bytes()
    file.write_bytes(whole[:-1000])
    first = {r.status: r.n for r in batch.ingest(spark, str(path), landing_path).collect()}
    assert first == {"converted": 2, "skipped": 0, "errors": 1, "truncated": 1}
    file.write_bytes(whole)
    again = {r.status: r.n for r in batch.ingest(spark, str(path), landing_path, spark.read.parquet(landing_path)).collect()}
    assert again == {"converted": 1, "skipped": 2, "errors": 1, "truncated": 0}
    assert landing.read_merged(spark, landing_path).where("subject_id = 'S001' and run_id = 'R03'").count() == 960


def test_a_damaged_annotation_block_stops_only_its_file(spark, root):
    path, originals = root
    file = path / "S001" / "S001R03.edf"
    raw = file.read_bytes()
    at = raw.index(b"\x14T")
    file.write_bytes(raw[: at + 1] + b"\xff" + raw[at + 2 :])
    samples, status = edf.decode_recordings(manifests.recording_files(spark, str(path)))
    states = {(r.subject_id, r.run_id): r for r in status.collect()}
    assert states[("S001", "R03")].status == "errors" and "Unicode" in states[("S001", "R03")].error
    landed = {(r.subject_id, r.run_id) for r in samples.select("subject_id", "run_id").distinct().collect()}
    assert landed == {k for k, r in states.items() if r.status == "converted"} and landed


def test_paths_of_stores_and_names_with_blanks(tmp_path):
    from epochloom.sources import files

    for path in (f"{tmp_path}/a b%20c.edf", f"file:{tmp_path}/d e.edf", f"file://{tmp_path}/f#g.edf"):
        files.write_bytes(path, b"0123456789")
        assert files.read_range(path, 3, 4) == b"3456"
    assert (tmp_path / "a b%20c.edf").exists() and (tmp_path / "f#g.edf").exists()
    assert files.open_filesystem("dbfs:/data/x y.edf")[1] == "/dbfs/data/x y.edf"


def test_ingest_is_incremental(spark, root, tmp_path):
    path, _ = root
    landing_path = str(tmp_path / "landing")
    first = {r.status: r.n for r in batch.ingest(spark, str(path), landing_path).collect()}
    assert first == {"converted": 3, "skipped": 0, "errors": 1, "truncated": 0}
    landed = spark.read.parquet(landing_path)
    (path / "S002" / "S002R04.edf").write_bytes((path / "S002" / "S002R03.edf").read_bytes())
    again = {r.status: r.n for r in batch.ingest(spark, str(path), landing_path, landed).collect()}
    assert again == {"converted": 1, "skipped": 3, "errors": 0, "truncated": 0}
    samples = landing.read_merged(spark, landing_path)
    assert samples.count() == 4 * 960
    features = batch.build_features(samples)
    assert features.count() == 4 * 3
    assert features.columns[:4] == [*EPOCH, "task_label"] and features.columns[-1] == "weight"


def test_manifest_diff(spark):
    remote = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    landed = spark.createDataFrame([("a", 10), ("b", 0)], "path string, length long")
    assert {r.path for r in manifests.missing(remote, landed).collect()} == {"b", "c"}


def test_merged_schema_and_partition_pruning(spark):
    path = shared_path(spark, "t")
    df = spark.range(100).select((F.col("id") % 3).alias("subject_id"), F.lit("R1").alias("run_id"), "id", F.col("id").alias("C3"))
    landing.write_partitioned(df, path)
    landing.write_partitioned(df.withColumn("subject_id", F.lit(9)).withColumnRenamed("C3", "C4"), path, mode="append")
    merged = landing.read_merged(spark, path)
    assert {"C3", "C4"} <= set(merged.columns) and merged.count() == 200
    sample = landing.signal_sample(merged, 1, "R1", ["id"], ["id"], 5)
    assert [r.id for r in sample.collect()] == [1, 4, 7, 10, 13]
    assert "PartitionFilters: [isnotnull(subject_id" in sample._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_hot_key_is_split_over_files(spark):
    path = shared_path(spark, "hot")
    df = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("subject_id"), F.lit("R1").alias("run_id"), "id")
    landing.write_partitioned(df, path, rows_per_file=200)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert back.where("subject_id = 1").select(F.input_file_name()).distinct().count() >= 5


def test_latest_files_and_batches(spark):
    path = shared_path(spark, "sink")
    for batch_id in range(5):
        spark.range(3).select((F.col("id") + batch_id * 10).alias("id")).write.parquet(f"{path}/batch_id={batch_id}")
    newest = landing.latest_batches(spark, path, 2)
    assert {r.batch_id for r in newest.collect()} == {3, 4} and newest.count() == 6
    flat = shared_path(spark, "flat")
    for n in range(4):
        spark.range(n, n + 1).coalesce(1).write.mode("append").parquet(flat)
    assert {r.id for r in landing.latest_files(spark, flat, 2).collect()} == {2, 3}


def test_lists_open_no_data_file(spark):
    """Batches and newest files come from names and times; only what is chosen is scanned."""
    path = shared_path(spark, "listed")
    spark.range(60).select("id", (F.col("id") % 12).alias("batch_id"), F.lit("a b/c+é%").alias("run_id")).write.partitionBy(
        "batch_id", "run_id").parquet(path)
    files = landing.landed_files(spark, path, "batch_id", "run_id")
    assert {r.run_id for r in files.collect()} == {"a b/c+é%"} and files.where("length > 0").count() >= 12
    assert "FileScan parquet" not in files._jdf.queryExecution().executedPlan().toString()
    newest = landing.latest_batches(spark, path, 3)
    assert {r.batch_id for r in newest.select("batch_id").distinct().collect()} == {9, 10, 11} and newest.count() == 15
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "PartitionFilters: [batch_id" in plan


def test_compare_runs(spark):
    schema = "run_id string, parent_run_id string, start_time timestamp, params map<string,string>, metrics map<string,double>"
    full = {name: 0.5 for name in runs.RUN_METRICS}
    partial = {name: 0.5 for name in runs.RUN_METRICS[:3]}
    rows = [("b", None, "2026-01-02", {}, full), ("a", None, "2026-01-03", {}, full), ("c", "b", "2026-01-01", {}, full), ("d", None, "2026-01-01", {}, partial)]
    df = spark.createDataFrame([(a, b, __import__("datetime").datetime.fromisoformat(c), d, e) for a, b, c, d, e in rows], schema)
    got = runs.compare_runs(df).collect()
    assert {(r.step, r.run_id) for r in got} == {(0, "b"), (1, "a")} and len(got) == 8


def test_the_bytes_of_samples_are_read_once_and_never_exchanged(spark, root, monkeypatch):
    """Far annotation blocks are read alone, the status needs no samples, and labels come with the ranges."""
    path, _ = root
    monkeypatch.setattr(edf, "GAP_BYTES", 1)
    samples, status = edf.decode_recordings(manifests.recording_files(spark, str(path)), range_bytes=1)
    assert {r.status for r in status.collect()} == {"converted", "errors"}
    assert samples.where("task_label = 'T2'").count() == 4 * 2 * RATE
    plan = samples._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in above


def test_a_recording_without_annotation_signal(spark, tmp_path):
    """Every sample has the default label."""
    (tmp_path / "S1").mkdir()
    signals, data = encode_micro(5)
    count, width = 4, 2 * (3 * RATE + 64)
    fields, at = b"", 256
    for size in (16, 80, 8, 8, 8, 8, 8, 80, 8, 32):  # the header without its last signal
        fields, at = fields + data[at : at + size * (count - 1)], at + size * count
    records = [data[at + r * width : at + r * width + 6 * RATE] for r in range(6)]
    head = data[:184] + b"1024".ljust(8) + data[192:252] + b"3".ljust(4)
    (tmp_path / "S1" / "S1R03.edf").write_bytes(head + fields + b"".join(records))
    samples, status = edf.decode_recordings(manifests.recording_files(spark, str(tmp_path)))
    assert [(r.status, r.error) for r in status.collect()] == [("converted", None)]
    rows = samples.orderBy("time").collect()
    assert {r.task_label for r in rows} == {"T0"} and np.allclose([r["Cz.."] for r in rows], signals["Cz.."], atol=4e-9)


def test_outcomes_reach_the_metrics_file(spark, root, tmp_path):
    from epochloom.plans import jobs

    path, _ = root
    file = path / "S001" / "S001R03.edf"
    file.write_bytes(file.read_bytes()[:-1000])
    jobs.ingest(spark, str(path), str(tmp_path / "landing"), str(tmp_path / "metrics"))
    row = spark.read.json(str(tmp_path / "metrics")).first()
    assert (row.converted, row.skipped, row.errors, row.truncated) == (2, 0, 1, 1)


def test_an_ordinary_key_lands_in_one_file(spark):
    """Spark splits a partition that is larger than it wants one to be; keys must not be split with it."""
    name, path = "spark.sql.adaptive.advisoryPartitionSizeInBytes", shared_path(spark, "many")
    spark.conf.set(name, "64k")
    try:
        df = spark.range(200_000, numPartitions=8).select((F.col("id") % 500).alias("subject_id"), F.lit("R1").alias("run_id"), F.xxhash64("id").alias("v"))
        landing.write_partitioned(df, path)
    finally:
        spark.conf.unset(name)
    assert landing.landed_files(spark, path).count() == 500
    back = landing.read_partitioned(spark, path, df.schema)
    assert back.selectExpr("count(*)", "sum(v % 1000)").first() == df.selectExpr("count(*)", "sum(v % 1000)").first()


def test_landed_rows_read_alike_in_tasks_and_by_spark(spark):
    """Names of folders as Spark writes them, and every type; a table of no rows is one, too."""
    path, twin = shared_path(spark, "odd"), shared_path(spark, "twin")
    odd = ["a b/c+é%", "x=1:2", None, "", "{[^]}", "back\\slash", "it's \"#*?", "tab\tnew\nline"]
    df = spark.createDataFrame([(n % len(odd), odd[n % len(odd)], n) for n in range(40)], "k int, run_id string, n long").select(
        F.when(F.col("k") < 6, F.col("k")).alias("subject_id"), "run_id", F.col("n").alias("c..1"), F.array("n", F.lit(None)).alias("items"),
        F.timestamp_micros("n").alias("at"), F.date_from_unix_date(F.col("n").cast("int")).alias("day"), (F.col("n") / 10).cast("decimal(9,2)").alias("d"),
        F.map_from_arrays(F.array(F.lit("a")), F.array("n")).alias("m"), F.when(F.col("n") % 2 == 0, F.col("n").cast("float")).alias("f"),
        F.struct(F.col("n").cast("byte").alias("b"), F.lit("z").alias("z")).alias("s"), F.encode(F.col("n").cast("string"), "utf-8").alias("raw"),
    )
    df.write.partitionBy("subject_id", "run_id").parquet(twin)
    landing.write_partitioned(df, path)
    text = lambda d: sorted(r.j for r in d.select(F.to_json(F.struct(*[f"`{c}`" for c in sorted(d.columns)])).alias("j")).collect())
    theirs, mine = spark.read.parquet(twin), spark.read.parquet(path)
    assert mine.schema == theirs.schema and text(mine) == text(theirs)
    typed = landing.read_partitioned(spark, path, df.schema).withColumn("subject_id", F.col("subject_id").cast("int"))
    assert text(typed) == text(theirs)
    names = lambda p: {r.f for r in landing.landed_files(spark, p).select(F.regexp_extract("path", "(subject_id=.*)/", 1).alias("f")).collect()}
    assert names(path) == names(twin) and landing.landed_files(spark, path).count() == len(names(twin))
    landing.write_partitioned(df.limit(0), path)
    assert landing.read_partitioned(spark, path, df.schema).count() == 0


def test_a_failed_landing_shows_nothing(spark):
    path = shared_path(spark, "failing")
    df = spark.range(100).select(F.col("id").alias("subject_id"), F.lit("R1").alias("run_id"), "id")
    landing.write_partitioned(df, path)
    broken = df.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        landing.write_partitioned(broken, path, mode="append")
    landing.write_partitioned(df.withColumn("id", F.col("id") + 100), path, mode="append")
    assert landing.landed_files(spark, path).count() == 200
    assert sorted(r.id for r in landing.read_partitioned(spark, path, df.schema).collect()) == list(range(200))


def test_a_column_that_a_landed_file_lacks_is_null(spark):
    path = shared_path(spark, "lacking")
    df = spark.range(10).select(F.col("id").alias("subject_id"), F.lit("R1").alias("run_id"), F.col("id").alias("C3"))
    landing.write_partitioned(df, path, rows_per_file=3)
    landing.write_partitioned(df.withColumnRenamed("C3", "C4"), path, mode="append")
    both = df.withColumn("C4", F.lit(None).cast("long")).schema
    assert landing.read_partitioned(spark, path, both).selectExpr("count(*)", "count(C3)", "count(C4)", "sum(C3)").first() == (20, 10, 10, 45)


def test_recordings_are_listed_in_tasks(spark, tmp_path):
    """At any depth, without hidden names; Spark's own listing would keep an entry for each file in the driver."""
    for name in ("S1/S1R1.edf", "deep/er/S2/S2R1.edf", "S1/notes.txt", "_S3/_S3R1.edf", ".S4/.S4R1.edf", "a=b c%20/S5/S5R1.edf", "S1/x_S1R2.edf"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    files = manifests.recording_files(spark, str(tmp_path))
    theirs = spark.read.format("binaryFile").option("pathGlobFilter", "*.edf").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "length")
    assert {(r.subject_id, r.run_id) for r in files.collect()} == {("S1", "R1"), ("S2", "R1"), ("S5", "R1")}
    assert {(r.path, r.length) for r in files.collect()} == {(r.path, r.length) for r in theirs.collect() if "x_S1" not in r.path}
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "FileScan parquet" in plan
    (tmp_path / "empty").mkdir()
    assert manifests.recording_files(spark, str(tmp_path / "empty")).count() == 0


def test_tasks_of_recordings_follow_their_bytes(spark):
    """Each task costs the driver memory: short recordings share one, whole ranges go by sixteen."""
    def tasks(rows, record_bytes, rows_per_range):
        ranges = spark.range(rows).select(
            F.concat(F.lit("p"), F.col("id") % 50).alias("path"), F.col("id").alias("first_record"),
            F.lit(rows_per_range).cast("long").alias("n_records"), F.lit(record_bytes).cast("long").alias("record_bytes"),
        )
        return edf._spread_ranges(ranges).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    assert tasks(1000, 600, 8) == 2 * cores and tasks(0, 600, 8) == 1
    assert tasks(1000, 1 << 20, 8) == 63 and tasks(40_000, 600, 1) == 40
