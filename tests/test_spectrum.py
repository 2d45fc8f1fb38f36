import numpy as np
import pytest
from pyspark.sql import functions as F

from epochloom.constants import BANDS, MOTOR_CHANNELS
from epochloom.functions.columns import lateralization
from epochloom.functions.spectrum import band_bins, band_powers
from epochloom.operators.features import alpha_by_channel, epoch_features
from epochloom.operators.epochs import EPOCH

FS, SAMPLES = 160, 320
TIME = np.linspace(0, 2, SAMPLES, endpoint=False)
SINE = np.sin(2 * np.pi * 10 * TIME)


def numpy_power(signal, low, high, fs=FS):
    if len(signal) < 2:
        return 0.0
    bins = band_bins(len(signal), fs, low, high)
    return float((np.abs(np.fft.rfft(signal)) ** 2)[bins].mean()) if bins.size else 0.0


def powers_of(spark, signals, **options):
    df = spark.createDataFrame(
        [(i, None if s is None else [None if v is None else float(v) for v in s]) for i, s in enumerate(signals)],
        "id int, x array<double>",
    )
    out = df.select("id", band_powers({"": F.col("x")}, FS, **options).alias("p")).select("id", "p.*")
    return [r.asDict() for r in out.orderBy("id").collect()]


def test_sine_has_its_power_in_alpha(spark):
    row = powers_of(spark, [SINE])[0]
    assert row["alpha"] > 100 * row["theta"]
    assert row["gamma"] < 1e-6


def test_lengths_share_a_batch_without_padding(spark):
    rng = np.random.default_rng(3)
    signals = [rng.standard_normal(n) for n in (0, 1, 2, 3, 4, 7, 319, 320, 320, 321)]
    for row, signal in zip(powers_of(spark, signals), signals):
        for band, limits in BANDS.items():
            assert row[band] == pytest.approx(numpy_power(signal, *limits), rel=1e-9, abs=1e-12)


def test_minimum_length_is_a_parameter(spark):
    short = [1.0, 2.0, 4.0]
    bands = {"all": (0.0, 80.1)}
    assert powers_of(spark, [short], min_samples=4, bands=bands)[0]["all"] == 0.0
    assert powers_of(spark, [short], min_samples=2, bands=bands)[0]["all"] > 0.0


def test_missing_samples_give_nan_and_missing_signals_null(spark):
    broken = [1.0, None] * 10
    rows = powers_of(spark, [broken, None, [1.0, float("nan")] * 10])
    assert np.isnan(rows[0]["alpha"]) and rows[1]["alpha"] is None and np.isnan(rows[2]["alpha"])


def samples_frame(spark, epochs, extra_channels=()):
    """Rows of ``{(subject, run, epoch): {channel: signal}}`` in random order."""
    rows = []
    for (subject, run, epoch), channels in epochs.items():
        names = list(channels)
        for i in range(len(channels[names[0]])):
            rows.append((subject, run, epoch, i / FS, "T1", *[float(channels[n][i]) for n in names]))
    np.random.default_rng(0).shuffle(rows)
    names = list(next(iter(epochs.values())))
    schema = "subject_id string, run_id string, epoch_id long, time double, task_label string, "
    cast = [(str(r[0]), str(r[1]), int(r[2]), float(r[3]), str(r[4]), *map(float, r[5:])) for r in rows]
    return spark.createDataFrame(cast, schema + ", ".join(f"{n} double" for n in names)).repartition(8)


@pytest.fixture(scope="module")
def epochs():
    rng = np.random.default_rng(7)
    return {
        ("S001", "R04", e): {name: rng.standard_normal(SAMPLES) for name in MOTOR_CHANNELS} for e in range(4)
    }


def test_epoch_features_match_numpy_whatever_the_row_order(spark, epochs):
    wide = lateralization(epoch_features(samples_frame(spark, epochs)))
    assert wide.columns == [*EPOCH, "task_label", *[f"{c}_{b}" for c in MOTOR_CHANNELS for b in BANDS],
                            *[f"diff_{b}" for b in BANDS]]
    rows = {r.epoch_id: r for r in wide.collect()}
    assert len(rows) == 4
    for (_, _, epoch), channels in epochs.items():
        for name, signal in channels.items():
            for band, limits in BANDS.items():
                assert rows[epoch][f"{name}_{band}"] == pytest.approx(numpy_power(signal, *limits), rel=1e-9)
        assert rows[epoch].diff_alpha == pytest.approx(rows[epoch].C3_alpha - rows[epoch].C4_alpha)


def test_alpha_of_every_channel(spark):
    signals = {("S001", "R04", 0): {"C3": SINE, "C4": np.zeros(SAMPLES), "Oz": SINE * 2}}
    rows = alpha_by_channel(samples_frame(spark, signals), ["C3", "C4", "Oz"]).collect()
    power = {r.channel: r.alpha_power for r in rows}
    assert set(power) == {"C3", "C4", "Oz"} and min(power.values()) >= 0.0
    assert power["C3"] > 100 * power["C4"] and power["Oz"] == pytest.approx(4 * power["C3"])


@pytest.mark.parametrize("length", [101, 500])
def test_long_epochs_are_exact(spark, many_partitions, length):
    """Epochs beyond the limit take the distributed transform; the others stay on the short path."""
    rng = np.random.default_rng(length)
    epochs = {
        ("S001", "R04", 0): {"C3": rng.standard_normal(length), "C4": rng.standard_normal(length)},
        ("S001", "R04", 1): {"C3": rng.standard_normal(60), "C4": rng.standard_normal(60)},
        ("S002", "R04", 0): {"C3": rng.standard_normal(length + 9), "C4": rng.standard_normal(length + 9)},
    }
    frame = samples_frame(spark, epochs)
    rows = {(r.subject_id, r.epoch_id): r for r in
            epoch_features(frame, ["C3", "C4"], max_samples=100, quality=True).collect()}
    assert len(rows) == 3
    for (subject, _, epoch), channels in epochs.items():
        for name, signal in channels.items():
            for band, limits in BANDS.items():
                got = rows[(subject, epoch)][f"{name}_{band}"]
                assert got == pytest.approx(numpy_power(signal, *limits), rel=1e-8), (subject, name, band)
    alpha = alpha_by_channel(frame, ["C3", "C4"], max_samples=100).collect()
    for r in alpha:
        want = numpy_power(epochs[(r.subject_id, r.run_id, r.epoch_id)][r.channel], *BANDS["alpha"])
        assert r.alpha_power == pytest.approx(want, rel=1e-8)
