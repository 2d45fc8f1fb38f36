"""Every operator as a query on the shared test tables.

Conventions: ``lineitem`` stands for samples (supplier = subject, line status = run, ship date =
time, quantity / discount / tax = channels C3 / Cz / C4, return flag = class); ``events`` for
irregular samples and live predictions; ``embeddings`` for ready-made 64-sample signals.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.constants import BANDS
from epochloom.functions import columns as C
from epochloom.functions.spectrum import band_powers
from epochloom.operators import epochs as EP
from epochloom.operators import features as FE
from epochloom.operators import metrics as ME
from epochloom.operators import model as MO
from epochloom.operators import ordering as OR
from epochloom.operators import spatial as SP
from epochloom.operators import split as SL
from epochloom.operators.intervals import label_by_interval
from epochloom.plans import batch
from epochloom.shared import materialise, shared_path
from epochloom.sources import edf, landing, manifests, runs
from epochloom.streaming import live

FS = 64
CLASSES = ("A", "N", "R")
REST = "N"
CHANNELS = ("C3", "Cz", "C4")
RAW_CHANNELS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")
LINE_ORDER = ("time", *LINE_KEYS, "l_extendedprice", *CHANNELS)
LINE_META = (
    "subject_id", "run_id", "epoch_id", "sample_no", "time", "task_label", *LINE_KEYS, "l_extendedprice",
)
PLACE = ("sample_no",)
EVENT_ORDER = ("ts", "event_id")
HOUR, WEEK = 3600, 7 * 86400
ANCHORS = ("E10", "E30", "E50")
RULES = {"low": (0.02, 0.05), "middle": (0.04, 0.07), "high": (0.06, 0.09)}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that engines that sum in another order agree."""
    return df.select(*[
        F.round(f"`{n}`", digits).alias(n) if kind == "double" else F.col(f"`{n}`")
        for n, kind in df.dtypes
    ])


# -- inputs ---------------------------------------------------------------------------------

def line_samples(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("subject_id"), F.col("l_linestatus").alias("run_id"),
        EP.seconds_of(F.col("l_shipdate")).alias("time"), F.col("l_returnflag").alias("task_label"),
        *LINE_KEYS, "l_extendedprice",
        F.col("l_quantity").alias("C3"), F.col("l_discount").alias("Cz"), F.col("l_tax").alias("C4"),
    )


def line_epochs(spark, sf) -> DataFrame:
    return EP.epochs_by_count(line_samples(spark, sf), LINE_ORDER, samples=FS)


def line_features(spark, sf, quality: bool = False, epochs: DataFrame | None = None) -> DataFrame:
    return FE.epoch_features(
        line_epochs(spark, sf) if epochs is None else epochs, CHANNELS, BANDS, FS, PLACE, label_rule="majority",
        max_samples=None, quality=quality,
    )


def line_normalised(spark, sf) -> DataFrame:
    return batch.normalised_features(
        line_epochs(spark, sf), CHANNELS, BANDS, FS, PLACE, REST, label_rule="majority",
        max_samples=None,
    )


def line_predictions(spark, sf, rule: str = "middle") -> DataFrame:
    """A fixed rule as the classifier: the discount picks the class."""
    low, high = RULES[rule]
    index = F.when(F.col("l_discount") < low, 0.0).when(F.col("l_discount") < high, 1.0).otherwise(2.0)
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("subject_id"), *LINE_KEYS, F.col("l_returnflag").alias("task_label"),
        index.alias("prediction"),
    ).withColumn("pred_label", C.decoded(F.col("prediction"), CLASSES))


def vector_signals(spark, sf) -> dict[str, Column]:
    return {"C3": F.slice("embedding", 1, 32), "C4": F.slice("embedding", 33, 32)}


def vector_features(spark, sf) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    powers = band_powers(vector_signals(spark, sf), FS)
    wide = vectors.select(
        "vec_id", F.concat(F.lit("T"), F.col("label") % 3).alias("task_label"), powers.alias("p")
    ).select("vec_id", "task_label", "p.*")
    return C.lateralization(wide)


def event_predictions(spark, sf) -> DataFrame:
    """Events as live predictions: the type is the truth, the value decides the prediction."""
    events = table(spark, sf, "events")
    guess = F.when(F.col("value") < 8, "click").when(F.col("value") < 30, "view").otherwise("error")
    return events.select(
        "event_id", "user_id", "ts", F.col("event_type").alias("true_label"), guess.alias("pred_label"),
        F.floor(EP.seconds_of(F.col("ts")) / HOUR).alias("epoch_id"),
        (F.col("value") > 30).cast("long").alias("correct"),
    )


def vector_channels(spark, sf) -> DataFrame:
    """Vector positions as channels, with their class mean."""
    cells = table(spark, sf, "embeddings").select(
        F.concat(F.lit("T"), F.col("label") % 3).alias("task_label"),
        F.posexplode("embedding").alias("pos", "v"),
    )
    return cells.groupBy("task_label", "pos").agg(F.avg(F.col("v").cast("double")).alias("value"))


def electrodes(spark, sf) -> DataFrame:
    """One electrode per vector position, spread evenly over a sphere of 95 mm."""
    means = vector_channels(spark, sf).groupBy("pos").agg(F.avg("value").alias("level"))
    size = means.agg(F.max("pos") + 1).scalar()
    z = 1.0 - (2.0 * F.col("pos") + 1.0) / size
    ring, turn = F.sqrt(1.0 - z * z), F.col("pos") * F.lit(2.399963229728653)
    return means.select(
        F.concat(F.lit("E"), F.col("pos")).alias("name"), (0.095 * ring * F.cos(turn)).alias("x"),
        (0.095 * ring * F.sin(turn)).alias("y"), (0.095 * z).alias("z"), "level",
    )


# -- epochs and features --------------------------------------------------------------------

def band_power(spark, sf):
    powers = band_powers({"": F.col("embedding")}, FS)
    return rounded(
        table(spark, sf, "embeddings").select("vec_id", powers.alias("p")).select("vec_id", "p.*")
    )


def epoch_features(spark, sf):
    return rounded(line_features(spark, sf), 4)


def epoch_quality(spark, sf):
    clean = line_features(spark, sf, quality=True)
    return clean.groupBy("subject_id").agg(
        F.count(F.lit(1)).alias("n_epochs"), F.sum("n_bad").alias("n_bad")
    )


def lateralization(spark, sf):
    return rounded(vector_features(spark, sf).select("vec_id", *[f"diff_{b}" for b in BANDS]))


def alpha_by_channel(spark, sf):
    epochs = line_epochs(spark, sf)
    found = C.channel_columns(epochs, LINE_META)
    return rounded(FE.alpha_by_channel(epochs, found, FS, order=PLACE, max_samples=None), 4)


def log_features(spark, sf):
    wide = vector_features(spark, sf)
    names = C.feature_columns(wide, ("vec_id", "task_label"))
    return rounded(wide.select("vec_id", *[C.log_compressed(F.col(n)).alias(n) for n in names]))


def epochs_by_time(spark, sf):
    events = table(spark, sf, "events")
    return EP.epochs_by_time(events, EP.seconds_of(F.col("ts")), HOUR).select(
        "event_id", "user_id", "epoch_id"
    )


def epoch_signals(spark, sf):
    events = EP.epochs_by_time(table(spark, sf, "events"), EP.seconds_of(F.col("ts")), HOUR)
    signals = EP.epoch_signals(events, ["value"], EVENT_ORDER, ("user_id", "epoch_id"))
    cents = F.transform("samples", lambda s: F.round(s["value"] * 100).cast("long").cast("string"))
    return signals.select(
        "user_id", "epoch_id", "segment", "n_samples", F.array_join(cents, ",").alias("signal")
    )


def _weekly(spark, sf):
    return EP.epochs_by_time(table(spark, sf, "events"), EP.seconds_of(F.col("ts")), WEEK)


def epoch_first_label(spark, sf):
    return _weekly(spark, sf).groupBy("user_id", "epoch_id").agg(
        EP.first_label("event_type", EVENT_ORDER).alias("epoch_label")
    )


def epoch_majority_label(spark, sf):
    return _weekly(spark, sf).groupBy("user_id", "epoch_id").agg(
        EP.majority_label("event_type").alias("epoch_label")
    )


def _epoch_totals(epochs: DataFrame) -> DataFrame:
    return epochs.groupBy("subject_id", "run_id", "epoch_id").agg(
        F.count(F.lit(1)).alias("n_samples"), F.round(F.sum("C3"), 4).alias("sum_c3"),
        EP.majority_label("task_label").alias("epoch_label"),
    )


def epochs_by_count(spark, sf):
    return _epoch_totals(line_epochs(spark, sf))


def interval_label(spark, sf):
    events = table(spark, sf, "events").withColumn("time", EP.seconds_of(F.col("ts")))
    hours = 6 + 12 * (F.col("event_id") % 3)
    marks = events.where(F.col("event_type") == "signup").select(
        "user_id", F.col("time").alias("onset"), (hours * 3600).cast("double").alias("duration"),
        F.col("event_id").alias("ann_idx"),
        F.concat(F.lit("S"), F.col("event_id")).alias("description"),
    )
    samples = events.select("event_id", "user_id", "time")
    return label_by_interval(samples, marks, ["user_id"]).select("event_id", "task_label")


def subject_stats(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", *RAW_CHANNELS)
    return rounded(FE.subject_stats(lines, RAW_CHANNELS, ["l_suppkey"]), 4)


def zscore_by_subject(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", *LINE_KEYS, *RAW_CHANNELS)
    return rounded(FE.zscore_by_subject(lines, None, ["l_suppkey"], ("l_suppkey", *LINE_KEYS)))


def class_weight(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_returnflag")
    return FE.with_rest_weight(lines, "l_returnflag", REST)


def balanced_weights(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_returnflag")
    return rounded(FE.balanced_weights(lines, "l_returnflag"))


def class_band_means(spark, sf):
    return rounded(FE.class_band_means(vector_features(spark, sf), ["C3", "C4"], "alpha"))


def class_lateralization(spark, sf):
    return rounded(FE.class_lateralization(vector_features(spark, sf), list(BANDS)))


def class_difference(spark, sf):
    return rounded(FE.class_difference(vector_features(spark, sf), ["C3_alpha", "C4_alpha"], "T2", "T1"))


def band_ranges(spark, sf):
    return rounded(FE.band_ranges(vector_features(spark, sf), ["C3", "C4"], list(BANDS)))


# -- split and metrics ----------------------------------------------------------------------

def _split_rows(spark, sf, train):
    lines = table(spark, sf, "lineitem").select("l_suppkey", *LINE_KEYS)
    return SL.rows_of(lines, SL.subject_split(lines, "l_suppkey"), train, "l_suppkey")


def split_train(spark, sf):
    return _split_rows(spark, sf, True)


def split_test(spark, sf):
    return _split_rows(spark, sf, False)


def split_counts(spark, sf):
    return SL.split_counts(table(spark, sf, "lineitem"), "l_suppkey")


def confusion_matrix(spark, sf):
    return ME.confusion_matrix(line_predictions(spark, sf), "task_label", "pred_label", CLASSES)


def class_prf(spark, sf):
    return rounded(ME.class_scores_long(line_predictions(spark, sf), "task_label", "pred_label", CLASSES))


def macro_f1(spark, sf):
    return rounded(ME.macro_f1(line_predictions(spark, sf), "task_label", "pred_label", CLASSES))


def weighted_metrics(spark, sf):
    return rounded(ME.weighted_metrics(line_predictions(spark, sf), "task_label", "pred_label"))


def weighted_metrics_all(spark, sf):
    """Five event types as true labels, of which two are never predicted."""
    return rounded(ME.weighted_metrics(event_predictions(spark, sf), "true_label", "pred_label", keys=["user_id"]))


def subject_accuracy(spark, sf):
    return rounded(ME.subject_accuracy(line_predictions(spark, sf), "task_label", "pred_label"))


def subject_tiers(spark, sf):
    return rounded(ME.with_subject_tier(
        ME.subject_accuracy(line_predictions(spark, sf), "task_label", "pred_label")
    ))


def decode_labels(spark, sf):
    return line_predictions(spark, sf).select(*LINE_KEYS, "prediction", "pred_label")


def score_flags(spark, sf):
    flag = C.agrees(F.col("pred_label"), F.col("task_label"))
    return line_predictions(spark, sf).select(*LINE_KEYS, flag.alias("correct"))


def kpi_summary(spark, sf):
    """Predictions of the held-out subjects next to the feature table of all."""
    features, predictions = C.lateralization(line_features(spark, sf)), line_predictions(spark, sf)
    held_out = SL.rows_of(predictions, SL.subject_split(predictions), False)
    return rounded(ME.kpi_summary(held_out, features, "task_label", "pred_label"))


def prediction_columns(spark, sf):
    return line_predictions(spark, sf).select("subject_id", "task_label", "prediction")


# -- live analytics -------------------------------------------------------------------------

def rolling_accuracy(spark, sf):
    rolled = ME.rolling_accuracy(event_predictions(spark, sf), EVENT_ORDER, ["user_id"])
    return rounded(rolled.select("event_id", "epoch_idx", "rolling_acc"))


def prediction_timeline(spark, sf):
    return ME.prediction_timeline(event_predictions(spark, sf), EVENT_ORDER).select(
        "event_id", "epoch_idx", "true_label", "pred_label", "marker"
    )


def dedup_latest(spark, sf):
    return OR.latest_per_key(event_predictions(spark, sf), ["epoch_id"], EVENT_ORDER).select(
        "epoch_id", "event_id", "true_label", "correct"
    )


def tail_100(spark, sf):
    newest = OR.latest_per_key(event_predictions(spark, sf), ["epoch_id"], EVENT_ORDER)
    return OR.tail_rows(newest, EVENT_ORDER, 100).select("epoch_id", "event_id", "correct")


def latest_snapshot(spark, sf):
    return OR.latest_snapshot(event_predictions(spark, sf), "epoch_id").select("epoch_id", "event_id")


def live_kpis(spark, sf):
    return rounded(ME.live_kpis(event_predictions(spark, sf), time="ts"))


def _epoch_list(spark, sf) -> DataFrame:
    return line_epochs(spark, sf).select("subject_id", "run_id", "epoch_id").distinct()


def event_time_axis(spark, sf):
    start = F.lit("2026-01-01 00:00:00").cast("timestamp")
    timed = EP.event_times(_epoch_list(spark, sf), start, seconds=2)
    return timed.withColumn("event_us", F.unix_micros("event_time")).drop("event_time")


def loop_replay(spark, sf):
    return EP.loop_replay(_epoch_list(spark, sf), ["epoch_id"], ["subject_id", "run_id"], 0.5, 30)


def latest_files(spark, sf):
    """Rows of the files that the last two of four appends wrote, each of a quarter of the users."""
    path, before = shared_path(spark, "newest"), 0
    events = table(spark, sf, "events").select("event_id", "user_id")
    for quarter in range(4):
        if quarter == 2:
            before = landing.landed_files(spark, path).count()
        events.where(F.col("user_id") % 4 == quarter).repartition("user_id").write.mode("append").parquet(path)
    return landing.latest_files(spark, path, landing.landed_files(spark, path).count() - before)


def latest_batches(spark, sf):
    days = event_predictions(spark, sf).withColumn("batch_id", F.floor(F.col("epoch_id") / 24))
    path = shared_path(spark, "batches")
    landing.write_partitioned(days, path, ["batch_id"])
    return landing.latest_batches(spark, path, 10).select(
        "event_id", F.col("batch_id").cast("long").alias("batch_id")
    )


def union_batches(spark, sf):
    events = table(spark, sf, "events")
    bought = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    other = events.where(F.col("event_type") != "purchase").select("event_id", "user_id", "event_type")
    return landing.union_batches(bought, other)


# -- spatial maps ---------------------------------------------------------------------------

def electrode_lookup(spark, sf):
    """Channels in mixed case against electrodes; those with a negative level are not mounted."""
    channels = vector_channels(spark, sf).withColumn(
        "channel", F.when(F.col("pos") % 2 == 0, F.concat(F.lit("e"), "pos")).otherwise(F.concat(F.lit("E"), "pos"))
    ).select("task_label", "channel", "value")
    mounted = electrodes(spark, sf).where("level > 0").drop("level")
    return rounded(SP.electrode_lookup(channels, mounted))


def electrode_powers(spark, sf):
    """Every electrode with the level of the quieter class channels, NULL where none was recorded."""
    quiet = vector_channels(spark, sf).where("task_label = 'T1' and value > 0").select(
        F.concat(F.lit("e"), "pos").alias("channel"), "value"
    )
    sites = electrodes(spark, sf).select("name", "z")
    return rounded(SP.electrode_powers(sites, quiet, "value"))


def electrode_projection(spark, sf):
    flat = SP.projected(electrodes(spark, sf))
    return rounded(flat.select("name", "px", "py", SP.map_radius(flat).alias("map_radius")))


def scalp_interpolate(spark, sf):
    sites = materialise(electrodes(spark, sf), "montage")
    values = vector_channels(spark, sf).select(
        "task_label", F.concat(F.lit("E"), "pos").alias("name"), "value"
    ).where(F.col("name").isin(*ANCHORS))
    anchors = sites.where(F.col("name").isin(*ANCHORS))
    return rounded(SP.scalp_interpolate(sites, anchors, values, ["task_label"]))


def topomap_grid(spark, sf):
    flat = materialise(SP.projected(electrodes(spark, sf)), "montage")
    values = materialise(vector_channels(spark, sf).select(
        "task_label", F.concat(F.lit("E"), "pos").alias("name"), "value"
    ), "channel-values")
    return rounded(SP.topomap_grid(flat, values, ["task_label"]))


def difference_map(spark, sf):
    """Class difference T2 - T1 at every electrode, from its anchors, with the symmetric range."""
    sites = materialise(electrodes(spark, sf), "montage")
    anchors = sites.where(F.col("name").isin(*ANCHORS))
    wide = table(spark, sf, "embeddings").select(
        F.concat(F.lit("T"), F.col("label") % 3).alias("task_label"),
        *[F.col("embedding")[int(name[1:])].cast("double").alias(name) for name in ANCHORS],
    )
    difference = FE.class_difference(wide, ANCHORS, "T2", "T1")
    mapped = SP.scalp_interpolate(sites, anchors, difference, (), "difference")
    limits = FE.symmetric_range(mapped, "difference", [])
    return rounded(mapped.select(
        "name", "difference", limits.select("vmin").scalar().alias("vmin"),
        limits.select("vmax").scalar().alias("vmax"),
    ))


def live_map_range(spark, sf):
    """Colour range of the live map of every event type's hourly levels."""
    levels = event_predictions(spark, sf).groupBy("true_label", "epoch_id").agg(
        F.avg(F.col("correct").cast("double")).alias("level")
    )
    return rounded(FE.live_range(levels, "level", ["epoch_id"]))


# -- sources and sinks ----------------------------------------------------------------------

def signal_sample(spark, sf):
    """First 20 s (3200 samples) of the recording with the most samples."""
    samples = line_samples(spark, sf)
    sizes = samples.groupBy("subject_id", "run_id").agg(F.count(F.lit(1)).alias("n"))
    longest = sizes.agg(
        F.min_by(F.struct("subject_id", "run_id"), F.struct(-F.col("n"), "subject_id", "run_id")).alias("r")
    )
    return landing.signal_sample(
        samples, longest.select("r.subject_id").scalar(), longest.select("r.run_id").scalar(),
        ["time", *LINE_KEYS, "Cz", "task_label"], LINE_ORDER,
    )


def clean_columns(spark, sf):
    dotted = line_samples(spark, sf).select(
        *LINE_KEYS, F.col("C3").cast("float").alias("C3.."), F.col("Cz").cast("string").alias("Cz."),
        F.col("C4").alias("C4.."),
    )
    clean = C.without_dots(dotted)
    return C.as_double(clean, C.channel_columns(clean, LINE_KEYS))


def partitioned_roundtrip(spark, sf):
    path, samples = shared_path(spark, "landing"), line_samples(spark, sf)
    landing.write_partitioned(samples, path)
    return landing.read_partitioned(spark, path, samples.schema).select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", *LINE_KEYS, "C3", "Cz", "C4"
    )


def merged_scan(spark, sf):
    path = shared_path(spark, "merged")
    samples = line_samples(spark, sf)
    landing.write_table(samples.where("run_id = 'O'").select(*LINE_KEYS, "C3", "Cz"), f"{path}/part=0")
    landing.write_table(samples.where("run_id <> 'O'").select(*LINE_KEYS, "C3", "C4"), f"{path}/part=1")
    return landing.read_merged(spark, path).select(*LINE_KEYS, "C3", "Cz", "C4")


def metrics_json(spark, sf):
    path = shared_path(spark, "metrics")
    metrics = ME.weighted_metrics(line_predictions(spark, sf), "task_label", "pred_label")
    landing.write_metrics(metrics, path)
    return rounded(landing.read_metrics(spark, path, metrics.schema))


def ingest_pending(spark, sf):
    listed = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderpriority").alias("run_id")
    )
    landed = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("subject_id"))
    wanted = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    return manifests.pending(listed, landed, ["subject_id"], wanted)


def manifest_missing(spark, sf):
    remote = table(spark, sf, "orders").select(F.col("o_orderkey").alias("path"))
    landed = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(
        F.count_if(F.col("l_linestatus") == "F").alias("length")
    )
    return manifests.missing(remote, landed)


def ingest_outcomes(spark, sf):
    """The ingest job over files of which some are cut in the header, damaged, too short, or landed before."""
    root, place = write_recordings(spark, sf, flawed=True), F.col("number") % 5
    listed = manifests.recording_files(spark, root)
    number = F.substring("subject_id", 2, 6).cast("int") + F.substring("run_id", 2, 2).cast("int")
    landed = materialise(listed.withColumn("number", number).where(place == 4).select("subject_id", "run_id"), "landed")
    return batch.ingest(spark, root, shared_path(spark, "landing"), landed, runs=None)


def scoring_defaults(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    joined = documents.join(table(spark, sf, "labels"), "doc_id", "left")
    predicted = F.concat(F.lit("T"), F.col("quality"))
    filled = C.scoring_defaults(
        F.when(F.col("quality") == 1, F.col("source")), F.col("toxic"), predicted,
        {"T0": 1.0 - F.col("quality"), "T1": F.col("quality")},
    )
    return joined.select("doc_id", *[value.alias(name) for name, value in filled.items()])


def _flawed(data: bytes, number: int) -> bytes:
    """Of five files one is cut in its header, one has a broken annotation, and one lacks its end."""
    if number % 5 == 1:
        return data[:300]
    if number % 5 == 2:
        first = re.search(rb"\+0(\.0)?\x14\x14\x00", data).end()
        mark = data.index(b"\x14", first) + 1
        return data[:mark] + b"\xff" + data[mark + 1 :]
    return data[:-100] if number % 5 == 3 else data


def write_recordings(spark, sf, seconds: int = 8, flawed: bool = False) -> str:
    """Cut samples into bounded recordings and write each as an EDF+ file from its own group.

    A subject's last, shorter recording is one record, so that no sample is left over.
    """
    root = shared_path(spark, "recordings")
    place, whole = F.col("_no"), FS * seconds
    cut = OR.number_rows(line_samples(spark, sf), LINE_ORDER, ["subject_id"], "_no").select(
        "subject_id", "task_label", *CHANNELS, F.floor(place / whole).alias("epoch_id"), (place % whole).cast("int").alias("sample_no")
    )

    def write(key: tuple, group: pa.Table) -> pa.Table:
        from epochloom.sources.edf_write import encode_recording
        from epochloom.sources.files import write_bytes

        group = group.sort_by("sample_no")
        number, run = (k.as_py() for k in key)
        subject, run_id, half = f"S{number:06d}", f"R{run:02d}", seconds // 2
        marks = [(0, half, group["task_label"][0].as_py()), (half - 1, 2, "T9")]
        data = encode_recording(
            {name: group[name].to_numpy() for name in CHANNELS}, FS,
            {"C3": (-32768, 32767), "Cz": (-327.68, 327.67), "C4": (-327.68, 327.67)}, marks,
            record_samples=None if len(group) == whole else len(group),
        )
        write_bytes(f"{root}/{subject}/{subject}{run_id}.edf", _flawed(data, number + run) if flawed else data)
        return pa.table({"n": pa.array([len(data)], pa.int64())})

    written = cut.groupBy("subject_id", "epoch_id").applyInArrow(write, "n long")
    written.agg(F.sum("n")).collect()
    return root


def decode_recordings(spark, sf):
    files = manifests.recording_files(spark, write_recordings(spark, sf))
    samples, _ = edf.decode_recordings(files, range_bytes=1 << 11)
    return rounded(samples.select("subject_id", "run_id", "time", *CHANNELS, "task_label"))


# -- experiment runs ------------------------------------------------------------------------

def compare_runs(spark, sf):
    """Every order is a run whose metrics come from its own lines."""
    scored = line_predictions(spark, sf).withColumnRenamed("l_orderkey", "run")
    metrics = ME.weighted_metrics(scored, "task_label", "pred_label", keys=["run"])
    lines = scored.groupBy("run").agg(F.count(F.lit(1)).alias("n_lines"))
    metrics = metrics.join(lines, "run").withColumn("f1", F.when(F.col("n_lines") > 2, F.col("f1")))
    orders = table(spark, sf, "orders")
    joined = metrics.join(orders, metrics["run"] == orders["o_orderkey"]).drop("o_totalprice")
    records = runs.run_record(
        joined, F.col("run"), F.col("o_orderdate"), {"n_lines": F.col("n_lines")},
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")),
    )
    return rounded(runs.compare_runs(records))


def run_log(spark, sf):
    path = shared_path(spark, "runs")
    for name, (low, high) in RULES.items():
        metrics = ME.weighted_metrics(line_predictions(spark, sf, name), "task_label", "pred_label")
        record = runs.run_record(
            metrics, F.lit(name), F.lit("2026-01-01").cast("timestamp"),
            {"low": F.lit(low), "high": F.lit(high)},
        )
        runs.append_runs(record, path)
    return rounded(spark.read.parquet(path).select(
        "run_id", F.col("params")["low"].alias("low"), F.col("params")["high"].alias("high"),
        *[F.col("metrics")[m].alias(m) for m in runs.RUN_METRICS],
    ))


# -- models ---------------------------------------------------------------------------------

def _tuned(spark, sf):
    features = materialise(line_normalised(spark, sf), "normalised")
    training, test = SL.train_test(features)
    names = C.feature_columns(features)
    model = MO.tune_forest(MO.forest_pipeline(names), training, folds=3)
    return model, test, names


def checked(scored: DataFrame) -> DataFrame:
    """Keys and label of scored epochs with what must hold for any model: the form SQL can state."""
    chances = [F.col(f"proba_{c}") for c in CLASSES]
    chosen = F.element_at(F.create_map(*[x for c in CLASSES for x in (F.lit(c), F.col(f"proba_{c}"))]), F.col("pred_label"))
    return scored.select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", "epoch_id", "task_label",
        (F.abs(sum(chances[1:], chances[0]) - 1.0) < 1e-9).alias("sums_to_one"),
        (chosen == F.greatest(*chances)).alias("likeliest"),
        (F.col("correct") == (F.col("pred_label") == F.col("task_label")).cast("long")).alias("flagged"),
    )


def rf_predictions(spark, sf):
    """Held-out epochs scored by the tuned forest."""
    model, test, _ = _tuned(spark, sf)
    return checked(MO.score(model, test, classes=CLASSES))


def rf_metrics(spark, sf):
    """Metrics of a stored model against MLlib's evaluator on the same predictions; gaps are 0."""
    features = materialise(line_normalised(spark, sf), "normalised")
    path = shared_path(spark, "cv-model")
    model, _ = batch.train(features, path, classes=CLASSES)
    metrics = batch.evaluate_stored(features, path, classes=CLASSES)[1]
    held_out = model.transform(SL.train_test(features)[1])
    gaps = [
        F.round(F.abs(F.col(ours) - F.lit(MulticlassClassificationEvaluator(metricName=theirs).evaluate(held_out))), 6).alias(f"{ours}_gap")
        for ours, theirs in (("accuracy", "accuracy"), ("f1", "f1"), ("precision_weighted", "weightedPrecision"), ("recall_weighted", "weightedRecall"))
    ]
    return metrics.select(*gaps, F.col("accuracy").between(0.0, 1.0).alias("in_range"))


def cv_grid(spark, sf):
    return MO.grid_scores(spark, _tuned(spark, sf)[0]).select(
        "num_trees", "max_depth", F.col("avg_accuracy").between(0.0, 1.0).alias("in_range")
    )


def feature_importance(spark, sf):
    """Every feature once; importances are shares, and the first tier holds the largest."""
    model, _, names = _tuned(spark, sf)
    ranked = materialise(ME.with_importance_tier(MO.feature_importances(spark, model, names)), "importances")
    total, most = ranked.agg(F.sum("importance")).scalar(), ranked.agg(F.max("importance")).scalar()
    return ranked.select(
        "feature", F.col("importance").between(0.0, 1.0).alias("in_range"), (F.abs(total - 1.0) < 1e-9).alias("shares"),
        ((F.col("importance") < most) | (F.col("tier") == "top")).alias("tiered"),
    )


def _live_training(spark, sf):
    # Stored, so that the shuffle which numbers the samples goes before the one which collects them.
    epochs = materialise(line_epochs(spark, sf).select(*EP.EPOCH, *PLACE, "task_label", *CHANNELS), "line-epochs")
    return materialise(C.lateralization(line_features(spark, sf, epochs=epochs)), "live-features")


def live_rf(spark, sf):
    features = _live_training(spark, sf)
    model = MO.fit_live(features, C.feature_columns(features), trees=20, depth=6)
    return checked(MO.score(model, features, classes=CLASSES))


def separable_labels(spark, sf):
    """A live model of quantities that one threshold separates tells them apart without error.

    Lines with a quantity from 21 to 30 are left out: they are the gap that separates the two labels.
    """
    lines = table(spark, sf, "lineitem").where("l_quantity <= 20 OR l_quantity >= 31").select(
        *LINE_KEYS, F.col("l_quantity").cast("double").alias("quantity"), F.col("l_tax").cast("double").alias("tax"),
        F.when(F.col("l_quantity") <= 20, "A").otherwise("N").alias("task_label"),
    )
    model = MO.fit_live(lines, ["quantity", "tax"], trees=10, depth=4)
    return MO.score(model, lines, classes=CLASSES).select(*LINE_KEYS, "pred_label", "correct")


def model_roundtrip(spark, sf):
    """The model that is fitted and stored at the first call scores as the one read at the second."""
    features = _live_training(spark, sf)
    path = shared_path(spark, "live-model")
    names = C.feature_columns(features)
    fit = lambda: MO.fit_live(features, names, trees=10, depth=5)
    keys = ["subject_id", "run_id", "epoch_id"]
    first, stored = (
        MO.score(MO.load_or_fit(spark, path, fit), features, classes=CLASSES).select(
            *keys, F.struct("pred_label", *[f"proba_{c}" for c in CLASSES]).alias(f"scores_{i}")
        ) for i in range(2)
    )
    return first.join(stored, keys).select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", "epoch_id", (F.col("scores_0") == F.col("scores_1")).alias("same")
    )


# -- streams --------------------------------------------------------------------------------

def _event_stream(spark, sf, copies: int = 1, closing_seconds: int | None = None) -> DataFrame:
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    landed = events
    for _ in range(copies - 1):
        landed = landed.unionAll(events)
    path = shared_path(spark, "live-events")
    live.land_in_order(landed, "ts", path)
    if closing_seconds:
        live.land_closing_row(landed, "ts", path, closing_seconds)
    return live.sample_stream(spark, path, events.schema)


def _stored(spark, stream, label: str) -> DataFrame:
    path, checkpoint = shared_path(spark, label), shared_path(spark, f"{label}-checkpoint")
    live.run_available(live.table_sink(stream, path, checkpoint))
    return spark.read.schema(stream.schema).parquet(path)


def stream_epochs(spark, sf):
    stream = EP.epochs_by_time(_event_stream(spark, sf), EP.seconds_of(F.col("ts")), HOUR)
    return _stored(spark, stream, "stream-epochs").select("event_id", "user_id", "epoch_id")


def stream_window_epochs(spark, sf):
    """Every hour of every user: the input ends with a row that moves the watermark past the last hour."""
    stream = live.window_epochs(
        _event_stream(spark, sf, closing_seconds=3 * HOUR + 1), "ts", ["user_id"], HOUR, "2 hours",
        [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
         F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type")],
    )
    return _stored(spark, stream, "stream-windows").select(
        "user_id", "epoch_id", "n", F.round("total", 2).alias("total"), "first_type"
    )


def stream_dedup(spark, sf):
    stream = live.deduplicated(_event_stream(spark, sf, copies=2), ["event_id"], "ts", "1 hour")
    return _stored(spark, stream, "stream-dedup").select("event_id", "user_id", "event_type", "value")


def _landed_epochs(spark, sf) -> str:
    """Epochs in the layout of a live input folder, with whole epochs per file; as many files as Spark has partitions."""
    start = F.lit("2026-01-01 00:00:00").cast("timestamp")
    rows = live.live_epochs(line_samples(spark, sf), CHANNELS, start, LINE_ORDER, FS, clock_hz=FS)
    path = shared_path(spark, "live-input")
    live.replay(rows, CHANNELS, path)
    return path


def _sample_stream(spark, path: str, triggers: int = 4) -> tuple[DataFrame, list[str], int]:
    """The stream of a live input in up to ``triggers`` micro-batches, its channels, and how many these are."""
    channels, files = C.landed_channels(spark, path), landing.landed_files(spark, path).count()
    each = max(1, -(-files // triggers))
    return live.sample_stream(spark, path, C.live_schema(channels), each), channels, -(-files // each)


def replay_epochs(spark, sf):
    stream, _, _ = _sample_stream(spark, _landed_epochs(spark, sf))
    landed = _stored(spark, stream, "replayed")
    return _epoch_totals(landed.withColumn("subject_id", F.col("subject_id").cast("long")))


def rule_scorer(wide: DataFrame) -> DataFrame:
    guess = F.when(F.col("C3_alpha") > 15000, "A").when(F.col("C3_alpha") > 11000, "N").otherwise("R")
    chances = {f"proba_{c}": F.when(guess == c, 1.0).otherwise(0.0) for c in CLASSES}
    return wide.withColumns({
        "pred_label": guess, **chances, "correct": C.agrees(guess, F.col("true_label")),
        "run_seq": F.coalesce("run_seq", F.lit(-1).cast("long")),
    })


def _score_sink(spark, source: str, path: str, model=None, scorer=None):
    """The dual sink over a live input, and the number of its micro-batches."""
    stream, channels, batches = _sample_stream(spark, source)

    def process(samples: DataFrame) -> DataFrame:
        return live.scored_epochs(
            samples, model, channels, CHANNELS, fs=FS, classes=CLASSES, max_samples=None, scorer=scorer,
        )

    outputs = {"predictions": live.predictions_of, "topomap": live.topomap_of}
    writer = live.batch_sink(live.observed(stream), process, outputs, path, shared_path(spark, "live-checkpoint"))
    return writer, batches


def _score_stream(spark, source: str, model=None, scorer=None) -> str:
    path = shared_path(spark, "live-output")
    live.run_available(_score_sink(spark, source, path, model, scorer)[0])
    return path


def live_run_statistics(spark, sf):
    """Counts of a bounded run with a processing-time trigger, next to what its sink holds."""
    path = shared_path(spark, "live-output")
    writer, batches = _score_sink(spark, _landed_epochs(spark, sf), path, scorer=rule_scorer)
    stats = live.run_live(writer, 600, "live-statistics", until=batches)
    written = live.committed(spark, path, "predictions").agg(F.count(F.lit(1)).alias("predictions"))
    timed = F.lit(stats["milliseconds_per_epoch"] > 0) & F.lit(stats["milliseconds_per_trigger"] > 0)
    return written.select(
        *[F.lit(stats[name]).cast("long").alias(name) for name in ("rows_read", "rows", "epochs")], "predictions", timed.alias("timed")
    )


def stream_dual_sink(spark, sf):
    """Both outputs, read back and joined: each map row next to its epoch's prediction."""
    path = _score_stream(spark, _landed_epochs(spark, sf), scorer=rule_scorer)
    keys = ["subject_id", "run_id", "epoch_id"]
    predictions = live.committed(spark, path, "predictions").select(*keys, "correct", "run_seq")
    topomap = live.committed(spark, path, "topomap")
    return rounded(topomap.join(predictions, keys).select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", "epoch_id", "channel",
        "alpha_power", "true_label", "pred_label", "correct", "run_seq",
    ), 4)


def stream_score(spark, sf):
    """Every epoch scored in the stream and in one batch by the same model: label and chances agree."""
    features = _live_training(spark, sf)
    model: PipelineModel = MO.fit_live(features, C.feature_columns(features), trees=10, depth=5)
    source = _landed_epochs(spark, sf)
    path = _score_stream(spark, source, model)
    keys, chances = ["subject_id", "run_id", "epoch_id"], [f"proba_{c}" for c in CLASSES]
    streamed = live.committed(spark, path, "predictions").select(*keys, "true_label", "pred_label", *chances)
    samples = spark.read.parquet(source)
    batched = live.predictions_of(live.scored_epochs(
        samples, model, CHANNELS, CHANNELS, fs=FS, classes=CLASSES, max_samples=None,
    )).select(*keys, F.col("pred_label").alias("label"), *[F.col(c).alias(f"b_{c}") for c in chances])
    close = [F.abs(F.col(c) - F.col(f"b_{c}")) < 1e-9 for c in chances]
    return streamed.join(batched, keys).select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", "epoch_id", "true_label",
        (F.col("pred_label") == F.col("label")).alias("same_label"), (close[0] & close[1] & close[2]).alias("same_chances"),
    )


def topomap_explode(spark, sf):
    samples = spark.read.parquet(_landed_epochs(spark, sf))
    scored = live.scored_epochs(
        samples, None, CHANNELS, CHANNELS, fs=FS, classes=CLASSES, max_samples=None, scorer=rule_scorer,
    )
    return rounded(live.topomap_of(scored).select(
        F.col("subject_id").cast("long").alias("subject_id"), "run_id", "epoch_id", "channel",
        "alpha_power", "true_label", "pred_label",
    ), 4)


QUERIES = {
    query.__name__: query
    for query in (
        band_power, epoch_features, epoch_quality, lateralization, alpha_by_channel, log_features,
        epochs_by_time, epoch_signals, epoch_first_label, epoch_majority_label, epochs_by_count,
        interval_label, subject_stats, zscore_by_subject, class_weight, balanced_weights,
        class_band_means, class_lateralization, class_difference, band_ranges, split_train,
        split_test, split_counts, confusion_matrix, class_prf, macro_f1, weighted_metrics, weighted_metrics_all,
        subject_accuracy, subject_tiers, decode_labels, score_flags, kpi_summary,
        prediction_columns, rolling_accuracy, prediction_timeline, dedup_latest, tail_100,
        latest_snapshot, live_kpis, event_time_axis, loop_replay, latest_batches, latest_files, union_batches,
        electrode_lookup, electrode_powers, electrode_projection, scalp_interpolate, topomap_grid, difference_map,
        live_map_range, signal_sample,
        clean_columns, partitioned_roundtrip, merged_scan, metrics_json, ingest_pending,
        manifest_missing, ingest_outcomes, scoring_defaults, decode_recordings, compare_runs,
        run_log, rf_predictions, rf_metrics, cv_grid, feature_importance, live_rf, separable_labels,
        model_roundtrip, stream_epochs, stream_window_epochs, stream_dedup, replay_epochs,
        stream_dual_sink, live_run_statistics, stream_score, topomap_explode,
    )
}
