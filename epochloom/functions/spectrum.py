"""Band power of equal-rate signals, as one vectorised Arrow function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from epochloom.constants import BANDS, SAMPLING_HZ


def band_bins(length: int, fs: float, low: float, high: float) -> np.ndarray:
    frequencies = np.fft.rfftfreq(length, 1.0 / fs)
    return np.flatnonzero((frequencies >= low) & (frequencies < high))


def _batch_power(signals: pa.ListArray, fs, bands, min_samples) -> np.ndarray:
    """Rows x bands. Signals of one length are stacked and transformed together, never padded."""
    rows = len(signals)
    lengths = np.asarray(signals.value_lengths().fill_null(0), dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if rows else lengths
    values = signals.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    power = np.zeros((rows, len(bands)))
    for length in np.unique(lengths):
        if length < max(min_samples, 1):
            continue
        where = np.flatnonzero(lengths == length)
        block = values[starts[where][:, None] + np.arange(length)]
        spectrum = np.abs(np.fft.rfft(block, axis=1)) ** 2
        for position, (low, high) in enumerate(bands):
            bins = band_bins(int(length), fs, low, high)
            if bins.size:
                power[where, position] = spectrum[:, bins].mean(axis=1)
    return power


def band_powers(
    signals: Mapping[str, Column],
    fs: float = SAMPLING_HZ,
    bands: Mapping[str, tuple[float, float]] = BANDS,
    min_samples: int = 2,
) -> Column:
    """Struct of ``<prefix>_<band>`` doubles for named signal arrays.

    The power of a band is the mean of ``|rfft|**2`` over its bins ``low <= f < high``, without
    scaling, taper or detrending. It is 0.0 when a band holds no bin or the signal is shorter
    than ``min_samples``. A NULL or NaN sample makes that signal's powers NaN; a NULL signal
    gives NULL. An empty prefix yields plain band names.
    """
    names = [f"{prefix}_{band}" if prefix else band for prefix in signals for band in bands]
    limits = [tuple(map(float, limit)) for limit in bands.values()]
    result = T.StructType([T.StructField(name, T.DoubleType()) for name in names])

    @F.arrow_udf(result)
    def powers(*columns: pa.Array) -> pa.Array:
        fields = []
        for column in columns:
            block = _batch_power(column, fs, limits, min_samples)
            missing = np.asarray(column.is_null())
            fields += [pa.array(block[:, i], mask=missing) for i in range(block.shape[1])]
        return pa.StructArray.from_arrays(fields, names)

    return powers(*[signal.cast("array<double>") for signal in signals.values()])


def partial_transform(slice_: np.ndarray, before: int, total: int, low: int, high: int) -> np.ndarray:
    """What samples ``before`` .. of a signal of ``total`` add to its bins ``low`` .. ``high`` - 1.

    A chirp turns the sum over any run of bins into one convolution (Bluestein); phases are reduced in
    integers first.
    """
    n, bins = len(slice_), high - low
    if not n or bins < 1:
        return np.zeros(max(bins, 0), dtype=complex)

    def chirp(index: np.ndarray) -> np.ndarray:
        return np.exp(-1j * np.pi * ((index * index) % (2 * total)) / total)

    j, k = np.arange(n, dtype=np.int64), np.arange(low, high, dtype=np.int64)
    size = 1 << (n + bins - 2).bit_length() if n + bins > 2 else 1
    shift = np.exp(-2j * np.pi * ((low * j) % total) / total)  # bins from 0 on
    lags = np.zeros(size, dtype=complex)
    lags[:bins] = np.conj(chirp(k - low))
    lags[size - n + 1 :] = np.conj(chirp(j[1:]))[::-1]
    found = np.fft.ifft(np.fft.fft(slice_ * shift * chirp(j), size) * np.fft.fft(lags))[:bins] * chirp(k - low)
    return found * np.exp(-2j * np.pi * np.array([(int(b) * before) % total for b in k]) / total)


#: One number that a slice adds: to a band's power where the slice is the ``whole`` signal, else to a bin.
SLICE_ENTRY = T.ArrayType(T.StructType([
    T.StructField("channel", T.IntegerType()), T.StructField("whole", T.BooleanType()), T.StructField("bin", T.LongType()),
    T.StructField("re", T.DoubleType()), T.StructField("im", T.DoubleType()),
]))


def slice_entries(
    signals: Sequence[Column], before: Column, total: Column, fs: float, bands: Mapping[str, tuple[float, float]],
    min_samples: int = 2,
) -> Column:
    """What slices of equal places in their signals add up to: see ``SLICE_ENTRY``.

    ``before`` samples of the signal come ahead of the slice, and it has ``total``. ``bin`` is the place of the
    band for whole signals.
    """
    limits = [tuple(map(float, limit)) for limit in bands.values()]
    reach = min(low for low, _ in limits), max(high for _, high in limits)

    @F.arrow_udf(SLICE_ENTRY)
    def entries(before: pa.Array, total: pa.Array, *columns: pa.Array) -> pa.Array:
        ahead, all_ = (np.asarray(x.to_numpy(zero_copy_only=False), dtype=np.int64) for x in (before, total))
        size = columns[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        whole, rows = size == all_, [[] for _ in range(len(size))]
        for c, column in enumerate(columns):
            power = _batch_power(column.filter(pa.array(whole)), fs, limits, min_samples)
            for row, found in zip(np.flatnonzero(whole).tolist(), power.tolist()):
                rows[row] += [(c, True, b, p, 0.0) for b, p in enumerate(found)]
            for row in np.flatnonzero(~whole).tolist():
                wanted = band_bins(int(all_[row]), fs, *reach)
                if not wanted.size:
                    continue
                low, high = int(wanted[0]), int(wanted[-1]) + 1
                values = column[row].values.cast(pa.float64()).to_numpy(zero_copy_only=False)
                sums = partial_transform(values, int(ahead[row]), int(all_[row]), low, high)
                rows[row] += [(c, False, k, z.real, z.imag) for k, z in zip(range(low, high), sums.tolist())]
        return pa.array([[dict(zip(SLICE_ENTRY.elementType.names, e)) for e in row] for row in rows], _ENTRY_TYPE)

    return entries(before, total, *[signal.cast("array<double>") for signal in signals])


_ENTRY_TYPE = to_arrow_type(SLICE_ENTRY)


def channel_powers(
    signals: Mapping[str, Column],
    fs: float = SAMPLING_HZ,
    band: tuple[float, float] = BANDS["alpha"],
    min_samples: int = 4,
) -> Column:
    """Array of ``(channel, power)`` structs for one band over every named signal."""
    powers = band_powers(signals, fs, {"power": band}, min_samples)
    return F.array(*[
        F.struct(F.lit(name).alias("channel"), powers[f"{name}_power"].alias("power"))
        for name in signals
    ])


def channel_arrays(names: Sequence[str], samples: Column) -> dict[str, Column]:
    """Split an ordered array of sample structs into one array per channel, inside the JVM."""
    return {name: samples.getField(name) for name in names}
