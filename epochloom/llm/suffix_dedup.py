"""Removal of repeated 200-byte strings by a distributed merge sort of suffixes that knows common prefixes.

Every window of ``WINDOW`` bytes is named by its anchor, the place in it where the hash of ``GRAM`` bytes is
least, leftmost on a tie. Equal windows have equal anchors at equal offsets, so only anchors whose gram
occurs again matter. One range exchange by (gram, surroundings) finds them: anchors with equal surroundings,
the bytes of all windows they name, are one class, all of whose windows repeat if it has two members. Where a
gram has several classes, the suffix of one member each is sorted, by gram fingerprint, then bytes. Each task
sorts its
suffixes and front-codes them as runs; runs of one fingerprint range meet in a task and a loser tree merges
them. The tree keeps, with every loser, the prefix it shares with the winner it lost to, so known prefixes
are never compared again, and the merge yields the common prefix of neighbours. At each offset before an
anchor, windows are equal where the merged neighbours share what lies right of the anchor and the bytes left
of it have equal hashes.

Equal whole texts are found by digest first and enter once, with double weight. A gram with more than
``HOT_ROWS`` classes does not go to one merging task: its windows are counted by their digests in an aggregation that combines before the shuffle. Texts are kept in a table
bucketed by a row key, which later steps read without moving texts again.

Behaviour: NULL text counts as empty; texts shorter than a window lose nothing. Repeated rows and NULL
identifiers are documents like others, so repeated rows of ``WINDOW`` bytes or more lose everything. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.grouped import runs
from epochloom.llm.stages import bounded_batches, discard
from epochloom.llm.word_tokens import slices
from epochloom.shared import materialise, remove, scratch, shared_path

WINDOW, GRAM = 200, 64
REACH = WINDOW - GRAM
HOT_ROWS = 50_000
#: Suffixes in a run, and about as many as a merging task takes.
RUN_ROWS, RANGE_ROWS = 1 << 14, 16_000
#: Bytes of text in a bucket, and anchors in a range, for which their numbers are chosen.
BUCKET_BYTES, RANGE_ANCHORS = 16 << 20, 250_000
_PLACE = np.uint64((1 << 28) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)


def _spread(z: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser; fixed constants."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on; zero bytes follow the end."""
    h, power, step = _BYTES[data], _BASE, 1
    while step < GRAM:
        later = np.zeros_like(h)
        later[:-step] = h[step:]
        h *= power
        h += later
        power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
        step *= 2
    return _spread(h)


def anchors(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fingerprint, text, place, first and last window of each anchor; ``edges`` bound the texts in ``data``."""
    none = tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < WINDOW:
        return none
    h = _grams(data)
    least = (h & ~_PLACE) | np.arange(len(data), dtype=np.uint64)
    step = 1
    while 2 * step <= REACH + 1:
        np.minimum(least[:-step], least[step:], out=least[:-step])
        step *= 2
    rest = REACH + 1 - step
    least[: len(least) - rest] = np.minimum(least[: len(least) - rest], least[rest:])
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    starts = np.flatnonzero(np.arange(len(data)) + WINDOW <= edges[text + 1])
    if not len(starts):
        return none
    place = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[starts[1:]] != text[starts[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place, owner = place[first], text[starts[first]]
    base = edges[owner]
    return h[place], owner, place - base, starts[first] - base, starts[last] - base


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    up, down = (np.full(n, np.uint64(x)) for x in (int(_BASE), inverse))
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def surroundings(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of ``data[low:high]`` for each pair."""
    up, down = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:-1])])
    return _spread((total[high] - total[low]) * down[low] + (high - low).astype(np.uint64))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "_text", 1 << 18):
            raw = [(t or "").encode() for t in piece.column("_text").to_pylist()]
            edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
            data = np.frombuffer(b"".join(raw), dtype=np.uint8)
            h, owner, place, first, last = anchors(data, edges)
            context = surroundings(data, edges[owner] + first, edges[owner] + last + WINDOW)
            weight = np.minimum(piece.column("_copies").to_numpy(), 2).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)), pa.array(context.view(np.int64)), piece.column("_k").take(pa.array(owner)),
                    pa.array(place, pa.int32()), pa.array(place - first, pa.int16()), pa.array(place - last, pa.int16()),
                    pa.array(weight[owner]),
                ],
                names=["h", "context", "_k", "place", "far", "near", "weight"],
            )


_MARKS = "h long, context long, _k long, place int, far short, near short, weight {}"


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of one range, sorted by gram and surroundings, that are not alone with their gram.

    ``weight`` becomes that of the class within the range. The first and the last gram of the range come
    whole, marked by ``edge``, and their outermost classes are marked by ``rim``, because other ranges may
    have more of them: a gram or class that many texts share fills several ranges.
    """
    part = TaskContext.get().partitionId()

    def classes(table: pa.Table, opening: bool, closing: bool) -> pa.RecordBatch:
        h, context, weight = (table.column(c).to_numpy() for c in ("h", "context", "weight"))
        new_gram = np.ones(len(h), dtype=bool)
        new_gram[1:] = h[1:] != h[:-1]
        new_class = new_gram.copy()
        new_class[1:] |= context[1:] != context[:-1]
        gram, kind = np.cumsum(new_gram) - 1, np.cumsum(new_class) - 1
        heavy = np.bincount(kind, weights=weight)[kind]
        several = np.bincount(gram, weights=new_class)[gram] > 1
        edge = ((gram == 0) & opening) | ((gram == gram[-1]) & closing)
        rim = ((kind == 0) & opening) | ((kind == kind[-1]) & closing)
        some = np.flatnonzero((np.bincount(gram)[gram] > 1) | (heavy > 1) | edge)
        kept = table.drop_columns(["weight"]).take(pa.array(some))
        for name, values in (
            ("weight", heavy.astype(np.int64)), ("several", several), ("leader", new_class), ("edge", edge), ("rim", rim),
        ):
            kept = kept.append_column(name, pa.array(values[some]))
        return kept.append_column("part", pa.array(np.full(len(some), part, dtype=np.int32)))

    held, opening = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        h = table.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        held = table.slice(cut)
        if cut:
            yield from classes(table.slice(0, cut), opening, False).to_batches()
            opening = False
    if held is not None:
        yield from classes(held, opening, True).to_batches()


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes are known to be equal."""
    end = min(len(a), len(b))
    while known < end:
        stop = min(known + 32, end)
        x, y = a[known:stop], b[known:stop]
        if x != y:
            differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return stop - (differ.bit_length() + 7) // 8
        known = stop
    return end


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Prefix shared with the string before, and the rest, of sorted strings."""
    shared = np.zeros(len(strings), dtype=np.uint16)
    for i in range(1, len(strings)):
        shared[i] = shared_prefix(strings[i - 1], strings[i], 0)
    return shared, [s[n:] for s, n in zip(strings, shared.tolist())]


def merged(coded: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Order (run, place) of the strings of front-coded runs, and the prefix each shares with the one before.

    A loser tree. An entry holds the prefix it shares with the last string put out; of two entries the one
    with the longer such prefix comes first, and only equal prefixes are compared, from their end on.
    """
    width = 1
    while width < len(coded):
        width *= 2
    text: list[bytes | None] = [None] * width
    at, known = [-1] * width, [0] * width

    def advance(run: int) -> None:
        at[run] += 1
        shared, rest = coded[run] if run < len(coded) else ([], [])
        if at[run] < len(rest):
            known[run] = shared[at[run]]
            text[run] = (text[run] or b"")[: known[run]] + rest[at[run]]
        else:
            text[run] = None

    def play(one: int, two: int) -> tuple[int, int]:
        """Winner and loser; the loser then knows what it shares with the winner."""
        a, b = text[one], text[two]
        if b is None:
            return one, two
        if a is None:
            return two, one
        if known[one] != known[two]:
            return (one, two) if known[one] > known[two] else (two, one)
        n = shared_prefix(a, b, known[one])
        ahead = n == len(a) or (n < len(b) and a[n] < b[n])
        winner, loser = (one, two) if ahead else (two, one)
        known[loser] = n
        return winner, loser

    losers = [0] * width
    for run in range(width):
        advance(run)
    level = list(range(width))
    node = width
    while len(level) > 1:
        node //= 2
        games = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        losers[node : node + len(games)] = [loser for _, loser in games]
        level = [winner for winner, _ in games]
    winner, order, prefixes = level[0], [], []
    while text[winner] is not None:
        order.append((winner, at[winner]))
        prefixes.append(known[winner])
        advance(winner)
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, prefixes


_RUN = (
    ("k", pa.int64(), "bigint"), ("place", pa.int32(), "int"), ("far", pa.int16(), "smallint"), ("near", pa.int16(), "smallint"),
    ("weight", pa.int64(), "bigint"), ("shared", pa.int32(), "int"), ("rest", pa.binary(), "binary"), ("left", pa.binary(), "binary"),
)


def _runs(ranges: int) -> Callable:
    """Front-coded runs of the suffixes at anchors, one for each range."""

    def emit(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        by_range: dict[int, list] = {}
        for row in sorted(held):
            by_range.setdefault(int.from_bytes(row[0][:8], "big") * ranges >> 64, []).append(row)
        for number, rows in by_range.items():
            rights, lefts, *columns = (list(c) for c in zip(*rows))
            shared, rest = front_coded(rights)
            columns += [shared.tolist(), rest, lefts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32())]
                + [pa.ListArray.from_arrays([0, len(c)], pa.array(c, t)) for c, (_, t, _) in zip(columns, _RUN)],
                names=["range", *[name for name, _, _ in _RUN]],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for piece in slices(batch, "_text", 1 << 18):
                for k, text, found in zip(*[piece.column(n).to_pylist() for n in ("_k", "_text", "_anchors")]):
                    raw = text.encode()
                    for a in found:
                        place, far, near = a["place"], a["far"], a["near"]
                        right = (a["h"] & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big") + raw[place : place + WINDOW - near]
                        held.append((right, raw[place - far : place], k, place, far, near, a["weight"]))
                if len(held) >= RUN_ROWS:
                    yield from emit(held)
                    held = []
        yield from emit(held)

    return cut


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of repeated windows, from the merged runs of each range."""
    for group in runs(batches, ("range",)):
        coded, lists = [], {n: [] for n in ("k", "place", "far", "near", "weight", "left")}
        for row in range(len(group)):
            coded.append((group.column("shared")[row].as_py(), group.column("rest")[row].as_py()))
            for n, values in lists.items():
                values.append(group.column(n)[row].values)
        order, prefixes = merged(coded)
        before = np.cumsum([0, *[len(c[0]) for c in coded]])
        order = np.array([before[run] + at for run, at in order])
        k, place, far, near, weight = (
            np.concatenate([v.to_numpy() for v in lists[n]])[order].astype(np.int64) for n in ("k", "place", "far", "near", "weight")
        )
        shared = np.array(prefixes) - 8
        lefts = [v for values in lists["left"] for v in values.to_pylist()]
        sides = np.zeros((len(order), REACH), dtype=np.uint8)
        for i, at in enumerate(order.tolist()):
            side = np.frombuffer(lefts[at], dtype=np.uint8)
            sides[i, : len(side)] = side[::-1]
        hashed = np.zeros(len(order), dtype=np.uint64)
        repeated = np.zeros((len(order), REACH + 1), dtype=bool)
        for offset in range(REACH + 1):
            if offset:
                hashed = _spread(hashed * _BASE + _BYTES[sides[:, offset - 1]])
            some = np.flatnonzero((near <= offset) & (offset <= far))
            if not len(some):
                continue
            same_right = np.cumsum(shared < WINDOW - offset)[some].astype(np.uint64)
            key = _spread(same_right * _BASE) ^ hashed[some]
            _, group_of = np.unique(key, return_inverse=True)
            repeated[some, offset] = np.bincount(group_of, weights=weight[some])[group_of] >= 2
        edge = np.zeros((len(order), 1), dtype=bool)
        steps = np.diff(np.hstack([edge, repeated, edge]).astype(np.int8), axis=1)
        row, low = np.nonzero(steps == 1)
        _, high = np.nonzero(steps == -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[row]), pa.array(place[row] - (high - 1)), pa.array(place[row] - low)], names=["_k", "first", "last"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, text, found in zip(*[batch.column(n).to_pylist() for n in ("_k", "_text", "_anchors")]):
            raw = text.encode()
            starts = [(s, a["weight"]) for a in found for s in range(a["place"] - a["far"], a["place"] - a["near"] + 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([blake2b(raw[s : s + WINDOW], digest_size=16).digest() for s, _ in starts], pa.binary()),
                    pa.array([k] * len(starts), pa.int64()), pa.array([s for s, _ in starts], pa.int64()),
                    pa.array([w for _, w in starts], pa.int64()),
                ],
                names=["digest", "_k", "start", "weight"],
            )


def joined_spans(firsts: list[int], lasts: list[int]) -> list[tuple[int, int]]:
    """Maximal covered stretches [from, to) of windows that start at first .. last."""
    out: list[list[int]] = []
    for first, last in sorted(zip(firsts, lasts)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + WINDOW)
        else:
            out.append([first, last + WINDOW])
    return [(a, b) for a, b in out]


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in spans]]
    return b"".join(raw[a:b] for a, b in zip(ends, [*[a for a, _ in spans], len(raw)]))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, digest, n_bytes, copies) and, for each digest with repeats, what to remove.

    The second has digest, spans (an array of from and to in bytes), n_removed, n_spans and kept_sha256. Both
    are stored; whatever else was, the texts included, is removed.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    name, folder = f"epochloom_texts_{uuid.uuid4().hex}", shared_path(spark, "bucketed-texts")
    try:
        with scratch(spark) as keep:
            listed, cuts = _spans(docs, doc_id, text, name, folder)
            return keep(listed, "documents"), keep(cuts, "cuts")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, folder)


def _spans(docs: DataFrame, doc_id: str, text: str, name: str, folder: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("_text")).withColumn("digest", _digest(F.col("_text")))
    listed = materialise(rows.select("doc_id", "digest", F.octet_length("_text").cast("long").alias("n_bytes")), "digests")
    texts = listed.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("_rep"), F.first("n_bytes").alias("n_bytes"))
    texts = materialise(texts, "texts")
    long = texts.where(F.col("n_bytes") >= WINDOW).select(
        F.xxhash64("_rep", "digest").alias("_k"), F.col("digest").alias("_digest"), F.col("copies").alias("_copies")
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = texts.where(F.col("n_bytes") >= WINDOW).agg(F.sum("n_bytes").alias("n")).first().n or 0
    buckets = max(least, -(-size // BUCKET_BYTES))
    found = rows.where(F.octet_length("_text") >= WINDOW).withColumn("_k", F.xxhash64("doc_id", "digest")).join(long, "_k")
    one = found.where("digest = _digest").dropDuplicates(["_k"]).select("_k", "_digest", "_copies", "_text")
    (
        one.repartition(buckets, "_k").write.format("parquet").bucketBy(buckets, "_k")
        .option("path", folder).saveAsTable(name)
    )
    stored = spark.table(name)

    marked = materialise(stored.select("_k", "_text", "_copies").mapInArrow(_anchored, _MARKS.format("byte")), "anchors")
    order = ("h", "context", "_k")
    ranged = materialise(
        marked.repartitionByRange(max(least, -(-marked.count() // RANGE_ANCHORS)), *order).sortWithinPartitions(*order).mapInArrow(
            _classed, _MARKS.format("long") + ", several boolean, leader boolean, edge boolean, rim boolean, part int"
        ),
        "repeated-anchors",
    )
    discard(marked)
    # grams and classes that lie across ranges: two of each for every range at most
    grams = ranged.where("edge").groupBy("h").agg(F.countDistinct("part").alias("_parts")).where("_parts > 1")
    kinds = (
        ranged.where("rim").groupBy("h", "context", "part").agg(F.max("weight").alias("_w"))
        .groupBy("h", "context").agg(F.sum("_w").alias("_whole"), F.min("part").alias("_lead"), F.count(F.lit(1)).alias("_parts"))
        .where("_parts > 1")
    )
    again = (
        ranged.join(F.broadcast(grams.select("h", F.lit(True).alias("across"))), "h", "left")
        .join(F.broadcast(kinds.select("h", "context", "_whole", "_lead")), ["h", "context"], "left")
        .withColumn("across", F.coalesce("across", F.lit(False)))
        .withColumn("weight", F.coalesce("_whole", "weight"))
        .withColumn("leader", F.col("leader") & F.coalesce(F.col("part") == F.col("_lead"), F.lit(True)))
    )
    resolved = again.where("weight > 1").select("_k", (F.col("place") - F.col("far")).alias("first"), (F.col("place") - F.col("near")).alias("last"))
    leaders = materialise(
        again.where("leader AND (several OR across)").select("h", "_k", "place", "far", "near", "weight"), "suffixes"
    )
    sizes = leaders.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    hot = materialise(sizes.where(F.col("n") > HOT_ROWS), "hot-grams")
    ranges = -(-leaders.count() // RANGE_ROWS) or 1
    each = F.collect_list(F.struct("h", "place", "far", "near", "weight")).alias("_anchors")
    cool = leaders.join(hot, "h", "left_anti").groupBy("_k").agg(each)
    coded = materialise(
        stored.join(cool, "_k").select("_k", "_text", "_anchors").mapInArrow(
            _runs(ranges), "range int, " + ", ".join(f"{name} array<{kind}>" for name, _, kind in _RUN)
        ),
        "suffix-runs",
    )
    merged_runs = coded.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(_found, "_k long, first long, last long")
    stretches = resolved.union(merged_runs)
    if not hot.isEmpty():
        windows = materialise(
            stored.join(leaders.join(hot, "h", "left_semi").groupBy("_k").agg(each), "_k").select("_k", "_text", "_anchors")
            .mapInArrow(_windows, "digest binary, _k long, start long, weight long"), "hot-windows",
        )
        often = windows.groupBy("digest").agg(F.sum("weight").alias("n")).where("n > 1").select("digest")
        stretches = stretches.union(
            windows.join(often, "digest").select("_k", F.col("start").alias("first"), F.col("start").alias("last"))
        )
    spans = materialise(
        stretches.groupBy("_k").agg(F.collect_list(F.struct("first", "last")).alias("_stretches")), "stretches"
    )

    @F.pandas_udf("spans array<struct<start: bigint, end: bigint>>, n_removed long, n_spans long, kept_sha256 string")
    def removed(texts: pd.Series, stretches: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, stretches):
            raw = text.encode()
            spans = joined_spans([s["first"] for s in found], [s["last"] for s in found])
            out.append((
                [{"start": a, "end": b} for a, b in spans], sum(b - a for a, b in spans), len(spans), sha256(cut_out(raw, spans)).hexdigest()
            ))
        return pd.DataFrame(out, columns=["spans", "n_removed", "n_spans", "kept_sha256"])

    cuts = stored.where("_copies = 1").join(spans, "_k").select(
        F.col("_digest").alias("digest"), removed("_text", "_stretches").alias("_r")
    ).select("digest", "_r.*")
    return listed.join(texts.select("digest", "copies"), "digest"), cuts


def repeats_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    listed, cuts = repeated_spans(docs, doc_id, text)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= WINDOW)
    own = F.lower(F.hex("digest"))
    return listed.join(cuts.drop("spans"), "digest", "left").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", own)).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated stretches cut from the text; bytes that no longer make a character go too."""
    listed, cuts = repeated_spans(docs, doc_id, text)
    whole = listed.where((F.col("copies") > 1) & (F.col("n_bytes") >= WINDOW)).select("digest").distinct()
    nothing = F.array().cast("array<struct<start: bigint, end: bigint>>")
    known = cuts.select(F.col("digest").alias("_digest"), "spans").union(whole.select("digest", nothing))

    @F.pandas_udf("string")
    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([
            cut_out(t.encode(), [(s["start"], s["end"]) for s in some]).decode("utf-8", "ignore") if len(some) else ""
            for t, some in zip(texts, spans)
        ], dtype=object)

    own = F.coalesce(column(text), F.lit(""))
    joined = docs.withColumn("_digest", _digest(own)).join(known, "_digest", "left")
    changed = F.when(F.col("spans").isNull(), column(text)).otherwise(kept(own, F.coalesce("spans", nothing)))
    return joined.select(*[changed.alias(text) if c == text else column(c) for c in docs.columns])
