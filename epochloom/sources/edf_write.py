"""EDF+ bytes for one bounded recording; the test inputs of the decoder are made with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np

from epochloom.sources.edf import ANNOTATIONS

TAL_BYTES = 128


def encode_recording(
    signals: Mapping[str, np.ndarray], rate: int, physical: Mapping[str, tuple[float, float]],
    annotations: Sequence[tuple[float, float, str]] = (), unit: str = "V", record_samples: int | None = None,
) -> bytes:
    """Records of one second, or of ``record_samples``. Signals must fill whole records; annotations stand in the record of their onset."""
    size = record_samples or rate
    seconds = size / rate if size % rate else size // rate
    names = [*signals, ANNOTATIONS]
    records = len(next(iter(signals.values()))) // size
    samples = [size] * len(signals) + [TAL_BYTES // 2]

    def cell(value, width):
        return str(value)[:width].ljust(width).encode("latin-1")

    ranges = [physical[name] for name in signals] + [(-1, 1)]
    head = cell("0", 8) + cell("X X X X", 80) + cell("Startdate X X X X", 80)
    head += cell("01.01.85", 8) + cell("00.00.00", 8) + cell(256 * (len(names) + 1), 8)
    head += cell("EDF+C", 44) + cell(records, 8) + cell(seconds, 8) + cell(len(names), 4)
    blocks = (
        (names, 16), ([""] * len(names), 80), ([unit] * len(signals) + [""], 8),
        ([low for low, _ in ranges], 8), ([high for _, high in ranges], 8),
        ([-32768] * len(names), 8), ([32767] * len(names), 8), ([""] * len(names), 80),
        (samples, 8), ([""] * len(names), 32),
    )
    head += b"".join(cell(value, width) for values, width in blocks for value in values)

    digital = []
    for name, values in signals.items():
        low, high = physical[name]
        scaled = (np.asarray(values, dtype=float) - low) * (65535.0 / (high - low)) - 32768
        digital.append(np.rint(scaled).astype("<i2").reshape(records, size))
    body = []
    for record in range(records):
        tal = f"+{record * seconds}\x14\x14\x00"
        for onset, duration, text in annotations:
            if onset // seconds == record:
                tal += f"+{onset:g}\x15{duration:g}\x14{text}\x14\x00"
        raw = tal.encode("utf-8")
        if len(raw) > TAL_BYTES:
            raise ValueError("too many annotations in one record")
        body += [block[record].tobytes() for block in digital] + [raw.ljust(TAL_BYTES, b"\x00")]
    return head + b"".join(body)
