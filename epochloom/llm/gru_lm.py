"""Gated recurrent language model over word classes, trained and applied in numpy tasks.

Texts are coded in chunks: each chunk has the sorted hashes of its words and its tokens as places in that
list. The lists meet in hash buckets, where counts of training tokens are added up and go back to the
chunks, so no task or driver ever holds the vocabulary. Frequent words are classes of their own, the others
share a class with words of about the same count; words never seen in training are one more word, in the
class of those seen once. The model is P(class | history) by a GRU with a softmax over the classes, times
P(word | class, history): a binary tree over all words of the class, whose every branch is a logistic
function of the same state. Branches start at the shares of the counts; the share of the unseen word in its
class starts at that of Good and Turing. A tree is as deep as the logarithm of its class, so it grows with the
vocabulary and each of its words is a leaf; nodes share ``NODE_ROWS`` rows of weights by hash. The network is fed the class
of the previous word and, for words that share one, two of ``WORD_ROWS`` rows picked by the word's hash.

Training runs in ``ROUNDS`` rounds, each over another part of the chunks: every task starts from the shared
weights, learns all training documents of its chunk by truncated backpropagation through windows of
``STEPS`` tokens, and the weights are averaged by tokens. Documents lie one after another in parallel
streams; the state passes from window to window and is cleared only where a document begins, in training
and in scoring alike, so a score is the log-likelihood of a whole document.

Behaviour: NULL text counts as empty, which is one end token. Held-out documents add to no count and no
weight. Repeated rows count each; NULL identifiers stay. Words are counted by 64-bit hashes. Other columns
are not read. Without training tokens every word is unseen and has probability one. An empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.functions.columns import column
from epochloom.llm.grouped import runs
from epochloom.llm.stages import bounded_batches, discard
from epochloom.llm.word_tokens import slices
from epochloom.shared import materialise

CHUNK_BYTES = 8 << 20
#: Words with a class of their own, count bands of the others, and the classes in all.
FREQUENT, BANDS = 64, 32
CLASSES = FREQUENT + BANDS
HIDDEN, STEPS, STREAMS, ROUNDS = 16, 16, 256, 3
#: Streams and tokens of a window in scoring, which do not change a score.
SCORED_STREAMS, SCORED_TOKENS = 1024, 8192
#: Parts of a count band: words of one part have equal counts, or counts within an eighth of the band.
PARTS = 8
#: Rows of input weights for words and of output weights for the nodes of the trees.
WORD_ROWS, NODE_ROWS = 1024, 4096
BLOCK = 4096
#: Groups of a window's tokens by their branches, and the least tokens of one.
GROUPS, LEAST_GROUP = 4, 128
#: Log-odds whose probability is one in single precision.
CERTAIN = 1e4
RATE = 0.01
_END = np.uint64(0)


# Counting


def _word_hashes(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_binary())
    _, edges, held = words.buffers()
    edges = np.frombuffer(edges, dtype=np.int64)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else []
    text = memoryview(held or b"")
    found = np.fromiter((xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(edges, edges[1:])), dtype=np.uint64, count=len(words))
    return np.where(found == _END, np.uint64(1), found)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as planes of their first bytes, second bytes and so on; the planes of zeros compress well."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def _unpacked(planes: bytes, kind: type = np.int32) -> np.ndarray:
    planes = np.frombuffer(planes, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, of ``CHUNK_BYTES`` of text at most where they have several."""
    held, size = [], 0
    for batch in batches:
        more = batch.column("_text").nbytes
        if held and size + more > CHUNK_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.concat_batches(held)


def _chunks(bits: int) -> Callable:
    """A row for each chunk, and one for each (chunk, hash bucket)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in _joined(batches):
            for piece in slices(batch, "_text", CHUNK_BYTES):
                lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(piece.column("_text"), "")))
                edges = lists.offsets.to_numpy().astype(np.int64)
                named = lists.values.slice(int(edges[0]), int(edges[-1] - edges[0])).dictionary_encode()
                edges -= edges[0]
                hashes = np.where(pc.binary_length(named.dictionary).to_numpy() > 0, _word_hashes(named.dictionary), _END)
                # equal hashes are one word; the end is a word of its own; the most frequent word has code 0
                listed, place = np.unique(np.append(hashes, _END), return_inverse=True)
                flat = place[named.indices.to_numpy()] if len(named) else np.zeros(0, np.int64)
                real = flat != place[-1]
                ends = np.concatenate([[0], np.cumsum(real)])[edges[1:]]
                flat = np.insert(flat[real], ends, place[-1])
                lengths = np.diff(ends, prepend=0) + 1
                held = piece.column("_held").to_numpy(zero_copy_only=False).astype(bool)
                order = np.argsort(-np.bincount(flat, minlength=len(listed)), kind="stable")
                number = np.empty(len(order), dtype=np.int32)
                number[order] = np.arange(len(order))
                codes, listed = number[flat], listed[order]
                learned = np.bincount(codes, weights=np.repeat(~held, lengths), minlength=len(listed)).astype(np.int32)
                bucket = (listed >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(listed), np.int32)
                together = np.argsort(bucket, kind="stable")
                listed, learned, sorted_ = listed[together], learned[together], bucket[together].astype(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(sorted_)) + 1).tolist(), len(listed)]
                n = len(cuts) - 1
                ids = piece.column("_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * (n + 1), pa.int64()),
                        pa.array([-1, *sorted_[cuts[:-1]].tolist()], pa.int64()),
                        pa.array([None, *[listed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]], pa.binary()),
                        pa.array([None, *[_packed(learned[a:b]) for a, b in zip(cuts, cuts[1:])]], pa.binary()),
                        pa.ListArray.from_arrays([0, len(ids)] + [len(ids)] * n, ids),
                        pa.array([held.tobytes(), *[None] * n], pa.binary()),
                        pa.array([lengths.astype(np.int64).tobytes(), *[None] * n], pa.binary()),
                        pa.array([_packed(codes), *[None] * n], pa.binary()),
                        pa.array([_packed(bucket), *[None] * n], pa.binary()),
                    ],
                    names=["chunk", "bucket", "hashes", "learned", "ids", "held", "lengths", "codes", "buckets"],
                )
                chunk += 1

    return code


def _band(counts: np.ndarray) -> np.ndarray:
    """Class of words by their count: 0 up to one, then one for each power of two."""
    return np.frexp(np.maximum(counts, 1).astype(np.float64))[1].astype(np.int64) - 1


def _part(counts: np.ndarray) -> np.ndarray:
    """Part of words by their count: band times ``PARTS`` plus the place in the band."""
    share, power = np.frexp(np.maximum(counts, 1).astype(np.float64))
    return (power.astype(np.int64) - 1) * PARTS + ((share - 0.5) * 2 * PARTS).astype(np.int64)


def _ranks(part: np.ndarray) -> np.ndarray:
    """Place of each word among those of its part."""
    order = np.argsort(part, kind="stable")
    size = np.bincount(part)
    out = np.empty(len(part), dtype=np.int64)
    out[order] = np.arange(len(part)) - (np.cumsum(size) - size)[part[order]]
    return out


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each bucket's words, back to the chunks; and the bucket's sums in a row of chunk -1."""
    for group in runs(batches, ("bucket",)):
        hashes = [np.frombuffer(h, dtype=np.uint64) for h in group.column("hashes").to_pylist()]
        learned = np.concatenate([_unpacked(c) for c in group.column("learned").to_pylist()])
        listed, place = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(place, weights=learned, minlength=len(listed)).astype(np.int64)
        parts = np.split(counts[place], np.cumsum([len(h) for h in hashes])[:-1])
        known = counts > 0
        band, part = _band(counts[known]), _part(counts[known])
        ranks = np.zeros(len(listed), dtype=np.int64)
        ranks[known] = _ranks(part)
        placed = np.split(ranks[place].astype(np.int32), np.cumsum([len(h) for h in hashes])[:-1])
        top = np.argsort(-counts, kind="stable")[:FREQUENT]
        top = top[counts[top] > 1]
        n = len(hashes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*group.column("chunk").to_pylist(), -1], pa.int64()),
                pa.array([group.column("bucket")[0].as_py()] * (n + 1), pa.int64()),
                pa.array([*[_packed(p) for p in parts], None], pa.binary()),
                pa.array([None] * n + [np.bincount(band, weights=counts[known], minlength=BANDS).astype(np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([None] * n + [np.bincount(band, minlength=BANDS).tolist()], pa.list_(pa.int64())),
                pa.array([None] * n + [listed[top].view(np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([None] * n + [counts[top].tolist()], pa.list_(pa.int64())),
                pa.array([None] * n + [ranks[top].tolist()], pa.list_(pa.int64())),
                pa.array([*[_packed(p) for p in placed], None], pa.binary()),
                pa.array([None] * n + [np.bincount(part, weights=counts[known], minlength=BANDS * PARTS).astype(np.int64).tobytes()], pa.binary()),
                pa.array([None] * n + [np.bincount(part, minlength=BANDS * PARTS).astype(np.int64).tobytes()], pa.binary()),
            ],
            names=["chunk", "bucket", "counts", "tokens", "words", "top", "top_counts", "top_ranks", "ranks", "part_tokens", "part_words"],
        )


@dataclass(frozen=True)
class Vocabulary:
    """Sums of a training corpus: all a task needs besides the counts of its own words."""

    tokens: int
    words: int
    top: np.ndarray
    top_tokens: np.ndarray
    band_tokens: np.ndarray
    once_share: float

    def log_shares(self) -> np.ndarray:
        """Log share of each class among the training tokens, smoothed: the output bias to start from."""
        tokens = np.concatenate([self.band_tokens, self.top_tokens, np.zeros(FREQUENT - len(self.top_tokens))]) + 0.1
        return np.log(tokens / tokens.sum()).astype(np.float32)

    def classes(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word and log10 of its probability there."""
        place = np.searchsorted(self.top, hashes)
        own = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.top)
        own[inside] = self.top[place[inside]] == hashes[inside]
        band = _band(counts)
        with np.errstate(divide="ignore"):
            inner = np.log10(counts) - np.log10(np.maximum(1, self.band_tokens[band]))
            once = np.log10(self.once_share) + inner
            unseen = np.log10(1 - self.once_share)
        inner = np.where(counts == 0, unseen, np.where(counts == 1, once, inner))
        return np.where(own, BANDS + place, band), np.where(own, 0.0, inner)


@dataclass(frozen=True)
class Decisions:
    """Branches on the way to each word of a chunk, a row for each word, filled up with branches that are certain."""

    size: np.ndarray
    #: Row of the node, twice, and one for a way to the right.
    way: np.ndarray
    prior: np.ndarray

    def of(self, words: np.ndarray, real: np.ndarray) -> tuple:
        """Token, row, side and prior of every branch of a window's tokens; then the tokens that have branches,
        those with most first, and the ends of groups of them. A token's branches lie together, and those of a
        group are filled up to its most."""
        size = np.where(real, self.size.take(words), np.int8(0))
        token = np.argsort(-size, kind="stable")[: np.count_nonzero(size)]
        n = GROUPS if len(token) >= GROUPS * LEAST_GROUP else 1
        ends = [len(token) * g // n for g in range(n + 1)] if len(token) else []
        chosen, wide = words.take(token), [int(size[token[a]]) for a in ends[:-1]]
        groups = list(zip(ends, ends[1:], wide))
        way, prior = (
            np.concatenate([of_word.take(chosen[a:b], axis=0)[:, :w].ravel() for a, b, w in groups] or [of_word[:0].ravel()])
            for of_word in (self.way, self.prior)
        )
        each = np.concatenate([np.repeat(token[a:b], w) for a, b, w in groups] or [token])
        return each, way >> 1, (way & 1).astype(bool), prior, token, groups


@dataclass(frozen=True)
class Trees:
    """Words and tokens of each part without the frequent words, and where each bucket's words begin."""

    tokens: np.ndarray
    words: np.ndarray
    before: np.ndarray
    #: Sorted ``part << 40 | place`` of the frequent words.
    gone: np.ndarray
    once_share: float

    def places(self, bucket: np.ndarray, part: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Number of each word among those of its part in all buckets, frequent words left out."""
        key = (part << 40) | (self.before[bucket, part] + rank)
        return (key & ((1 << 40) - 1)) - (np.searchsorted(self.gone, key) - np.searchsorted(self.gone, part << 40))

    def decisions(self, own: np.ndarray, seen: np.ndarray, part: np.ndarray, place: np.ndarray) -> Decisions:
        """Seen or not, the part of the band, then the bits of the place; one-sided nodes decide nothing."""
        size = np.where(own | ~seen, 0, self.words[part])
        depth = np.array([max(0, int(n) - 1).bit_length() for n in self.words])[part]
        inside = np.flatnonzero(size > 0)
        deep, levels = int(depth[inside].max(initial=0)), (PARTS - 1).bit_length()
        size_of = np.zeros(len(part), dtype=np.int8)
        way = np.ones((1 + levels + deep, len(part)), dtype=np.int16)
        prior = np.full(way.shape, CERTAIN, dtype=np.float32)

        def put(at, words, side, low, high, tree, prefix):
            """The next branch of those of ``words`` whose node is not one-sided."""
            valid = np.flatnonzero((low > 0) & (high > 0))
            words, low, high = words[valid], low[valid].astype(np.float32), high[valid].astype(np.float32)
            key = ((tree[valid] * 64 + at) << 36) + prefix[valid]
            key = (key ^ (key >> 31)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            place = size_of[words].astype(np.int64) * len(part) + words
            way.reshape(-1)[place] = (key >> np.uint64(52)).astype(np.int16) % NODE_ROWS * 2 + (side[valid] != 0)
            prior.reshape(-1)[place] = np.log(high / low)
            size_of[words] += 1

        band, piece = part // PARTS, part % PARTS
        rare = np.flatnonzero(~own & (band == 0))
        ones = np.ones(len(rare))
        put(0, rare, seen[rare], ones * (1 - self.once_share), ones * self.once_share, band[rare], band[rare] * 0)
        sums = np.concatenate([np.zeros((BANDS, 1)), np.cumsum(self.tokens.reshape(BANDS, PARTS), axis=1)], axis=1)
        of_band, of_piece = band[inside], piece[inside]
        for level in range(levels):
            shift = levels - level - 1
            prefix = of_piece >> (shift + 1)
            low, mid, high = (sums[of_band, (2 * prefix + i) << shift] for i in range(3))
            put(1 + level, inside, (of_piece >> shift) & 1, mid - low, high - mid, of_band, prefix)
        for level in range(deep):
            inside = inside[depth[inside] > level]
            shift = depth[inside] - level - 1
            prefix, most = place[inside] >> (shift + 1), size[inside]
            low, mid, high = (np.minimum((2 * prefix + i) << shift, most) for i in range(3))
            put(1 + levels + level, inside, (place[inside] >> shift) & 1, mid - low, high - mid, BANDS + part[inside], prefix)
        most = int(size_of.max(initial=0))
        return Decisions(size_of, *(np.ascontiguousarray(x[:most].T) for x in (way, prior)))


def _trees(summed: DataFrame, vocabulary: Vocabulary, bits: int) -> Trees:
    """Collects a few sums of each hash bucket."""
    parts = BANDS * PARTS
    rows = summed.where("chunk = -1").select("bucket", "part_tokens", "part_words").collect()
    tokens, held = np.zeros(parts, dtype=np.int64), np.zeros((1 << bits, parts), dtype=np.int64)
    for r in rows:
        tokens += np.frombuffer(r.part_tokens, dtype=np.int64)[:parts]
        held[r.bucket] = np.frombuffer(r.part_words, dtype=np.int64)[:parts]
    before, words = np.cumsum(held, axis=0) - held, held.sum(axis=0)
    part = _part(vocabulary.top_tokens)
    bucket = (vocabulary.top >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(part), np.int64)
    ranks = {r.top: r.top_ranks for r in summed.where("chunk = -1").select(
        F.explode(F.arrays_zip("top", "top_ranks"))).select("col.*").where(
        F.col("top").isin(vocabulary.top.view(np.int64).tolist())).collect()}
    rank = np.array([ranks[h] for h in vocabulary.top.view(np.int64).tolist()], dtype=np.int64)
    gone = np.sort((part << 40) | (before[bucket, part] + rank))
    np.subtract.at(tokens, part, vocabulary.top_tokens)
    np.subtract.at(words, part, 1)
    return Trees(tokens, words, before, gone, vocabulary.once_share)


def _rows_of_words(hashes: np.ndarray, coded: np.ndarray) -> np.ndarray:
    """Two input rows of each word, the empty last one for words that have a class of their own or are unseen."""
    mixed = hashes * np.uint64(0xC2B2AE3D27D4EB4F)
    picked = np.stack([mixed >> np.uint64(54), (mixed >> np.uint64(40)) & np.uint64(1023)], axis=1).astype(np.int64) % WORD_ROWS
    return np.where(coded[:, None], picked, WORD_ROWS).astype(np.int16)


def _vocabulary(summed: DataFrame) -> Vocabulary:
    sums = summed.where("chunk = -1")
    bands = {r.pos: r for r in sums.select(F.posexplode(F.arrays_zip("tokens", "words"))).groupBy("pos").agg(
        F.sum("col.tokens").alias("tokens"), F.sum("col.words").alias("words")).collect()}
    tokens = np.array([bands[b].tokens if b in bands else 0 for b in range(BANDS)])
    words = np.array([bands[b].words if b in bands else 0 for b in range(BANDS)])
    top = sums.select(F.explode(F.arrays_zip("top", "top_counts"))).select("col.*").orderBy(
        F.desc("top_counts"), "top").limit(FREQUENT).collect()
    band_tokens = tokens.copy()
    for r in top:
        band_tokens[_band(np.array([r.top_counts]))[0]] -= r.top_counts
    once, twice = int(tokens[0]), int(tokens[1])
    # tokens of a new text that are seen once, against those unseen, as the counts of counts foretell
    share = 2 * (twice // 3) / max(1, once + 2 * (twice // 3)) if once else 0.0
    frequent = np.array([r.top for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(frequent)
    return Vocabulary(
        int(tokens.sum()), int(words.sum()), frequent[order],
        np.array([r.top_counts for r in top], dtype=np.int64)[order], band_tokens,
        min(max(share, 0.0 if not once else 0.05), 0.95),
    )


def _classed(vocabulary: Vocabulary, trees: Trees) -> Callable:
    """A row for each chunk, from its own row, its lists of words and their counts, which lie together."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.log10(vocabulary.tokens + 0.5 * (vocabulary.words + 1))
        for group in runs(batches, ("chunk",)):
            cell = {n: [v for v in group.column(n).to_pylist() if v is not None] for n in ("codes", "lengths", "buckets")}
            codes, bucket = _unpacked(cell["codes"][0]), _unpacked(cell["buckets"][0])
            lengths = np.frombuffer(cell["lengths"][0], dtype=np.int64)
            # the lists hold the words bucket by bucket, each in the order of the codes
            together = np.argsort(bucket, kind="stable")
            counts, hashes, ranks = (np.empty(len(bucket), dtype=t) for t in (np.int64, np.uint64, np.int64))
            for values, name, read_as in (
                (counts, "counts", lambda v: _unpacked(v, np.int64)), (ranks, "ranks", _unpacked),
                (hashes, "hashes", lambda v: np.frombuffer(v, dtype=np.uint64)),
            ):
                parts = sorted((b, v) for b, v in zip(group.column("bucket").to_pylist(), group.column(name).to_pylist()) if v is not None)
                values[together] = np.concatenate([read_as(v) for _, v in parts])
            own = group.filter(pc.less(group.column("bucket"), 0)).combine_chunks()
            kind, _ = vocabulary.classes(hashes, counts)
            part = np.where(kind < BANDS, _part(counts), 0)
            inside = (kind < BANDS) & (counts > 0)
            place = np.zeros(len(part), dtype=np.int64)
            place[inside] = trees.places(bucket[inside], part[inside], ranks[inside])
            starts = np.cumsum(lengths) - lengths
            base = np.log10(counts + 0.5) - floor
            yield pa.RecordBatch.from_arrays(
                [
                    *[own.column(n).combine_chunks() if isinstance(own.column(n), pa.ChunkedArray) else own.column(n) for n in ("chunk", "ids", "held", "lengths", "codes")],
                    *[
                        pa.array([values], pa.binary())
                        for values in (
                            kind.astype(np.uint8).tobytes(), (counts > 0).tobytes(), part.astype(np.int16).tobytes(), _packed(place),
                            _rows_of_words(hashes, inside).tobytes(),
                        )
                    ],
                    *[
                        pa.array([np.add.reduceat(values[codes], starts).astype(np.float64).tobytes()], pa.binary())
                        for values in (base, (counts > 0).astype(np.float64))
                    ],
                ],
                names=["chunk", "ids", "held", "lengths", "codes", "kinds", "seen", "parts", "places", "rows", "base", "known"],
            )

    return read


# The network


def fresh_weights(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        "input": rng.normal(0, 0.1, (CLASSES + 1, 3 * HIDDEN)).astype(np.float32),
        "state": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "output": rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        "bias": np.zeros(CLASSES, dtype=np.float32),
        "words": np.concatenate([rng.normal(0, 0.05, (WORD_ROWS, 3 * HIDDEN)), np.zeros((1, 3 * HIDDEN))]).astype(np.float32),
        "nodes": np.zeros((NODE_ROWS, HIDDEN + 1), dtype=np.float32),
    }


class Streams:
    """Documents laid one after another in parallel streams, longest stream first.

    Tokens lie step by step, those of a step in the order of the streams that still have some. With ``words``,
    the chunk's word of each token, ``rows`` and ``decisions`` are those of these words.
    """

    def __init__(
        self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: np.ndarray | None = None,
        rows: np.ndarray | None = None, decisions: Decisions | None = None, streams: int = STREAMS,
    ):
        n = max(1, min(streams, len(lengths)))
        load = [(0, s) for s in range(n)]
        docs: list[list[int]] = [[] for _ in range(n)]
        for d in np.argsort(-lengths, kind="stable").tolist():
            taken, s = heapq.heappop(load)
            docs[s].append(d)
            heapq.heappush(load, (taken + int(lengths[d]), s))
        docs = sorted(docs, key=lambda d: -int(lengths[np.array(d, dtype=np.int64)].sum()))
        chosen = np.array([d for some in docs for d in some], dtype=np.int64)
        size = lengths[chosen]
        ahead = np.cumsum(size) - size
        held = np.array([len(d) for d in docs])
        self.size = np.bincount(np.repeat(np.arange(n), held), weights=size, minlength=n).astype(np.int64)
        self.live = n - np.cumsum(np.bincount(self.size))[:-1]
        self.first = np.cumsum(self.live) - self.live
        total = int(size.sum())
        short = np.int32 if len(classes) < 1 << 31 else np.int64
        each = np.arange(total, dtype=short)
        place = self.first.astype(short).take(each - np.repeat((np.cumsum(self.size) - self.size).astype(short), self.size))
        place += np.repeat(np.arange(n, dtype=short), self.size)
        at, self.doc, begins = np.empty(total, dtype=short), np.empty(total, dtype=np.int32), np.zeros(total, dtype=bool)
        each += np.repeat((starts[chosen] - ahead).astype(short), size)
        at[place] = each
        self.doc[place] = np.repeat(chosen.astype(np.int32), size)
        begins[place[ahead[size > 0]]] = True
        del place, each
        self.target = classes.take(at).astype(np.int16)
        self.given = np.where(begins, np.int16(CLASSES), classes.take(at - 1, mode="wrap"))
        self.word = None if words is None else words.take(at)
        self.last = None if words is None else np.where(begins, -1, words.take(at - 1, mode="wrap"))
        self.rows = None if rows is None else np.concatenate([rows, np.full((1, 2), WORD_ROWS, rows.dtype)])
        self.decisions = decisions

    def windows(self, steps: int, tokens: int = 0) -> Iterator[tuple]:
        """given, target, document and whether there is a token, for the streams that still have some; then
        the input rows of the words given and the decisions of the target words, if there are words. Windows are
        longer than ``steps`` where that gives no more than ``tokens``."""
        end = 0
        while end < len(self.live):
            at, end = end, end + max(steps, tokens // int(self.live[end]))
            stream = np.arange(self.live[at])
            real = stream < self.live[at:end, None]
            some = np.where(real, self.first[at:end, None] + stream, 0)
            words = (None, None) if self.word is None else (
                self.rows.take(self.last.take(some), axis=0, mode="wrap"), self.decisions.of(self.word.take(some.ravel()), real.ravel())
            )
            yield self.given.take(some), self.target.take(some), self.doc.take(some), real, *words


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.negative(x)
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


def _softplus(x: np.ndarray) -> np.ndarray:
    out = np.negative(np.abs(x))
    np.exp(out, out=out)
    out += 1
    np.log(out, out=out)
    out += np.maximum(x, 0)
    return out


def forward(
    w: dict, given: np.ndarray, state: np.ndarray, rows: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """States (HIDDEN, streams) after each step; what training needs: the states each step starts from, its
    gates and fresh states (update, reset, fresh), and what the state gave them."""
    fed = w["input"].take(given, axis=0)
    if rows is not None:
        fed += w["words"].take(rows[..., 0], axis=0)
        fed += w["words"].take(rows[..., 1], axis=0)
    fed = np.ascontiguousarray(fed.transpose(0, 2, 1))
    turned = np.ascontiguousarray(w["state"].T)
    # gates are 1 / (1 + exp(-x)): the sign is changed once
    for x in (fed[:, : 2 * HIDDEN], turned[: 2 * HIDDEN]):
        np.negative(x, out=x)
    goes_on = given != CLASSES
    breaks = (~goes_on.all(axis=1)).tolist()
    states = np.empty((len(given), *state.shape), dtype=fed.dtype)
    before, moved, change = np.empty_like(states), np.empty_like(fed), np.empty_like(states[:1])[0]
    for masked, x, u, out, there, some in zip(before, fed, moved, states, goes_on, breaks):
        if some:
            np.multiply(state, there, out=masked)
        else:
            masked[...] = state
        np.matmul(turned, masked, out=u)
        gates, fresh = x[: 2 * HIDDEN], x[2 * HIDDEN :]
        gates += u[: 2 * HIDDEN]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[HIDDEN:], u[2 * HIDDEN :], out=change)
        fresh += change
        np.tanh(fresh, out=fresh)
        np.subtract(masked, fresh, out=out)
        out *= gates[:HIDDEN]
        out += fresh
        state = out
    return states, before, fed, moved


def _rows_of_states(states: np.ndarray) -> np.ndarray:
    """States (steps, HIDDEN, streams) and a one as rows of tokens, step by step."""
    out = np.ones((len(states), states.shape[2], HIDDEN + 1), dtype=states.dtype)
    out[:, :, :HIDDEN] = states.transpose(0, 2, 1)
    return out.reshape(-1, HIDDEN + 1)


def class_logits(w: dict, states: np.ndarray) -> np.ndarray:
    """Scores of the classes (CLASSES, tokens), small enough for their exponentials, from states and ones."""
    weights = np.concatenate([w["output"], w["bias"][None]])
    logits = weights.T @ states.T
    if not np.abs(weights).sum(axis=0).max() * max(1.0, np.abs(states).max()) < 60:
        logits -= logits.max(axis=0)
    return logits


def branches(w: dict, states: np.ndarray, decisions: tuple) -> tuple:
    """Log-odds of going right at each branch; states and one of the tokens that have some, the weights of each group."""
    _, row, _, prior, token, groups = decisions
    at = np.ones((len(token), HIDDEN + 1), dtype=states.dtype)
    at[:, :HIDDEN] = states[:, :HIDDEN].take(token, axis=0)
    odds, weights, end = np.empty(len(row), dtype=states.dtype), [], 0
    for a, b, wide in groups:
        begin, end = end, end + (b - a) * wide
        weights.append(w["nodes"].take(row[begin:end], axis=0).reshape(b - a, wide, HIDDEN + 1))
        np.matmul(weights[-1], at[a:b, :, None], out=odds[begin:end].reshape(b - a, wide, 1))
    odds += prior
    return odds, at, weights


def _node_slopes(decisions: tuple, pull: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums over the branches of each row of nodes of pull times state and one."""
    filled = np.zeros((len(at), HIDDEN + 2), dtype=at.dtype)
    filled[:, : HIDDEN + 1] = at
    # two columns as one of complex numbers, which are added up in one go
    columns, end = np.ascontiguousarray(filled.view(np.result_type(at, np.complex64)).T), 0
    row, across, drawn = np.empty(len(pull), dtype=np.intp), np.empty(len(pull), dtype=at.dtype), np.empty(len(pull), dtype=columns.dtype)
    parts = []
    for a, b, wide in decisions[5]:
        begin, end = end, end + (b - a) * wide
        for kept, x in ((row, decisions[1]), (across, pull)):
            kept[begin:end].reshape(wide, b - a)[...] = x[begin:end].reshape(b - a, wide).T
        parts.append((a, b, *(x[begin:end].reshape(wide, b - a) for x in (across, drawn))))
    out = np.zeros((len(columns), NODE_ROWS), dtype=columns.dtype)
    for to, c in zip(out, columns):
        for a, b, left, product in parts:
            np.multiply(left, c[a:b], out=product)
        np.add.at(to, row, drawn)
    return np.ascontiguousarray(out.T).view(at.dtype)[:, : HIDDEN + 1]


def gradients(
    w: dict, given: np.ndarray, target: np.ndarray, real: np.ndarray, state: np.ndarray,
    rows: np.ndarray | None = None, decisions: tuple | None = None, measured: bool = True, g: dict | None = None,
) -> tuple[dict, np.ndarray, float]:
    """Gradient of the mean log loss over one window, the state after it, and the summed loss if ``measured``.

    The gradient is written into ``g``, if that is given.
    """
    g = {k: np.empty_like(v) for k, v in w.items()} if g is None else g
    states, before, fed, moved = forward(w, given, state.T, rows)
    flat = _rows_of_states(states)
    each, wanted, mask = np.arange(len(flat)), target.ravel(), real.ravel()
    n = max(1, np.count_nonzero(mask))
    slope, loss = class_logits(w, flat), 0.0
    if measured:
        loss -= float(slope[wanted, each][mask].sum())
    np.exp(slope, out=slope)
    sums = slope.sum(axis=0)
    if measured:
        loss += float(np.log(sums[mask]).sum())
    slope *= (mask / (sums * n)).astype(slope.dtype)
    slope[wanted, each] -= mask / np.float32(n)
    both = flat.T @ slope.T
    g["output"][...], g["bias"][...] = both[:HIDDEN], both[HIDDEN]
    from_output = slope.T @ w["output"].T
    if decisions is not None and len(decisions[0]):
        right, token, groups = decisions[2], decisions[4], decisions[5]
        odds, at, weights = branches(w, flat, decisions)
        if measured:
            loss += float(_softplus(np.where(right, -odds, odds)).sum())
        pull = _sigmoid(odds)
        pull -= right
        pull /= n
        drawn, end = np.empty((len(token), HIDDEN + 1), dtype=pull.dtype), 0
        for (a, b, wide), of_group in zip(groups, weights):
            begin, end = end, end + (b - a) * wide
            np.matmul(pull[begin:end].reshape(b - a, 1, wide), of_group, out=drawn[a:b, None])
        from_output[token] += drawn[:, :HIDDEN]
        g["nodes"][...] = _node_slopes(decisions, pull, at)
    else:
        g["nodes"][...] = 0
    from_output = np.ascontiguousarray(from_output.reshape(*given.shape, HIDDEN).transpose(0, 2, 1))
    z, r, fresh, inner = fed[:, :HIDDEN], fed[:, HIDDEN : 2 * HIDDEN], fed[:, 2 * HIDDEN :], moved[:, 2 * HIDDEN :]
    # slopes by a state: of the fresh state's, update's and reset's inputs, and of what the state gave the fresh one
    slopes = np.empty((len(given), 4, *state.T.shape), dtype=fed.dtype)
    of_fresh, rest = slopes[:, 0], 1 - z
    np.multiply(rest, 1 - fresh * fresh, out=of_fresh)
    np.multiply(before - fresh, rest * z, out=slopes[:, 1])
    np.multiply(of_fresh, r, out=slopes[:, 3])
    np.multiply(slopes[:, 3], (1 - r) * inner, out=slopes[:, 2])
    goes_on = given != CLASSES
    breaks = (~goes_on.all(axis=1)).tolist()
    later, back = np.zeros_like(states[0]), np.empty_like(states[0])
    for t in range(len(given) - 1, -1, -1):
        d, all_four = from_output[t], slopes[t]
        d += later
        all_four *= d
        np.matmul(w["state"], all_four[1:].reshape(3 * HIDDEN, -1), out=later)
        np.multiply(d, z[t], out=back)
        later += back
        if breaks[t]:
            later *= goes_on[t]
    slopes = slopes.reshape(len(given), 4 * HIDDEN, -1)
    np.sum(before @ slopes[:, HIDDEN:].transpose(0, 2, 1), axis=0, out=g["state"])
    places, used = given.ravel().astype(np.intp), None
    if rows is not None:
        both = rows.reshape(-1, 2)
        used = np.flatnonzero(both[:, 0] < WORD_ROWS)
        first, second = both.take(used, axis=0).T + np.intp(CLASSES + 1)
    # fresh state, update and reset, two columns as one of complex numbers, which are added up in one go
    columns = np.empty((3 * HIDDEN // 2, *given.shape), dtype=np.result_type(slopes, np.complex64))
    columns.real, columns.imag = (slopes[:, k : 3 * HIDDEN : 2].transpose(1, 0, 2) for k in range(2))
    columns = columns.reshape(len(columns), -1)
    out = np.zeros((len(columns), CLASSES + 1 + len(w["words"])), dtype=columns.dtype)
    for to, c in zip(out, columns):
        np.add.at(to, places, c)
        if used is not None:
            some = c.take(used)
            np.add.at(to, first, some)
            np.add.at(to, second, some)
    summed = np.ascontiguousarray(out.T).view(slopes.dtype)
    for k, part in (("input", summed[: CLASSES + 1]), ("words", summed[CLASSES + 1 :])):
        g[k][:, : 2 * HIDDEN], g[k][:, 2 * HIDDEN :] = part[:, HIDDEN:], part[:, :HIDDEN]
    return g, states[-1].T, loss


def learn(w: dict, streams: Streams, rate: float = RATE) -> dict:
    """One pass of Adam over all windows."""
    names, edges = list(w), np.cumsum([0, *(v.size for v in w.values())])
    flat = np.concatenate([v.ravel() for v in w.values()])
    mean, square, slope, step = (np.zeros_like(flat) for _ in range(4))
    w, g = ({k: x[low:high].reshape(w[k].shape) for k, low, high in zip(names, edges, edges[1:])} for x in (flat, slope))
    # a part of all weights at a time stays in the cache
    parts = [[x[at : at + 4 * BLOCK] for x in (flat, mean, square, slope, step)] for at in range(0, len(flat), 4 * BLOCK)]
    state = np.zeros((len(streams.size), HIDDEN), dtype=np.float32)
    for n, (given, target, _, real, rows, decisions) in enumerate(streams.windows(STEPS), 1):
        _, state, _ = gradients(w, given, target, real, state[: given.shape[1]], rows, decisions, measured=False, g=g)
        share = min(1.0, np.count_nonzero(real) / (STREAMS * STEPS / 4))  # windows of a few long documents weigh less
        # (mean / a) / (sqrt(square / b) + 1e-6), with b's root taken out
        a, root = 1 - 0.9**n, (1 - 0.99**n) ** 0.5
        for weights, means, squares, slopes, steps in parts:
            np.multiply(slopes, slopes, out=steps)
            for held, new, part in ((means, slopes, 0.1), (squares, steps, 0.01)):
                new *= part
                held *= 1 - part
                held += new
            np.sqrt(squares, out=steps)
            steps += 1e-6 * root
            np.divide(means, steps, out=steps)
            steps *= rate * share * root / a
            weights -= steps
    return w


def log10_likelihoods(w: dict, streams: Streams, n: int) -> np.ndarray:
    """log10 P(classes) of each whole document, or log10 P(words) if the streams have words."""
    out = np.zeros(n)
    state = np.zeros((HIDDEN, len(streams.size)), dtype=np.float32)
    for given, target, doc, real, rows, decisions in streams.windows(1, SCORED_TOKENS):
        states = forward(w, given, state[:, : given.shape[1]], rows)[0]
        flat, state = _rows_of_states(states), states[-1]
        logits = class_logits(w, flat)
        values = logits[target.ravel(), np.arange(len(logits[0]))]
        values -= np.log(np.exp(logits, out=logits).sum(axis=0))
        values *= real.ravel()
        if decisions is not None and len(decisions[0]):
            odds = branches(w, flat, decisions)[0]
            lost, end = _softplus(np.where(decisions[2], -odds, odds)), 0
            for a, b, wide in decisions[5]:
                begin, end = end, end + (b - a) * wide
                values[decisions[4][a:b]] -= lost[begin:end].reshape(b - a, wide).sum(axis=1)
        out += np.bincount(doc.ravel(), weights=values, minlength=n)
    return out / np.log(10)


def _streams(batch: pa.RecordBatch, row: int, trees: Trees, held: bool) -> tuple[Streams | None, np.ndarray, np.ndarray]:
    """Streams of a chunk's documents, with or without those held out; their lengths and which are held out."""
    types = {"kinds": np.uint8, "seen": bool, "parts": np.int16, "rows": np.int16, "lengths": np.int64, "held": bool}
    cell = {n: np.frombuffer(batch.column(n)[row].as_py(), dtype=t) for n, t in types.items()}
    lengths, out = cell["lengths"], cell["held"]
    chosen = np.ones(len(lengths), dtype=bool) if held else ~out
    if not chosen.any():
        return None, lengths, out
    decisions = trees.decisions(cell["kinds"] >= BANDS, cell["seen"], cell["parts"].astype(np.int64), _unpacked(batch.column("places")[row].as_py(), np.int64))
    starts = np.cumsum(lengths) - lengths
    codes = _unpacked(batch.column("codes")[row].as_py())
    classes = cell["kinds"][codes]
    streams = Streams(
        classes, starts[chosen], lengths[chosen], codes, cell["rows"].reshape(-1, 2), decisions, SCORED_STREAMS if held else STREAMS
    )
    return streams, lengths, out


def _trained(w: dict, trees: Trees) -> Callable:
    """Each chunk learned from the same weights; the means of a task's chunks by tokens."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = 0.0, 0.0
        for batch in batches:
            for row in range(batch.num_rows):
                streams, lengths, held = _streams(batch, row, trees, held=False)
                if streams is None:
                    continue
                new, n = learn(w, streams), float(lengths[~held].sum())
                total = total + n * np.concatenate([new[k].ravel() for k in sorted(new)]).astype(np.float64)
                tokens += n
        if tokens:
            flat = (total / tokens).astype(np.float32)
            blocks = [flat[at : at + BLOCK].tobytes() for at in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.binary()), pa.array([tokens] * len(blocks))],
                names=["block", "values", "tokens"],
            )

    return train


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means of the weights of each block by tokens."""
    for group in runs(batches, ("block",)):
        tokens = np.array(group.column("tokens").to_pylist())
        mean = sum(np.frombuffer(v, dtype=np.float32) * t for v, t in zip(group.column("values").to_pylist(), tokens)) / tokens.sum()
        yield pa.RecordBatch.from_arrays(
            [group.column("block")[:1].combine_chunks() if isinstance(group.column("block"), pa.ChunkedArray) else group.column("block")[:1], pa.array([mean.astype(np.float32).tobytes()], pa.binary())],
            names=["block", "values"],
        )


def _scored(w: dict, trees: Trees, names: list[str]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                streams, lengths, held = _streams(batch, row, trees, held=True)
                base, known = (np.frombuffer(batch.column(n)[row].as_py()) for n in ("base", "known"))
                logs = log10_likelihoods(w, streams, len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[row].values, pa.array(held), pa.array(lengths), pa.array(known.astype(np.int64)),
                        pa.array(base), pa.array(logs),
                    ],
                    names=names,
                )

    return score


def document_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``held_out`` is a column over the input; rows for which it holds are scored but not learned from.
    """
    bounded_batches(docs.sparkSession)
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(column(doc_id).alias("_id"), column(text).alias("_text"), held.alias("_held"))
    kind = rows.schema["_id"].dataType
    ids = T.StructField("ids", T.ArrayType(kind))
    binary = [T.StructField(n, T.BinaryType()) for n in ("held", "lengths", "codes", "buckets")]
    bits = max(0, (rows.rdd.getNumPartitions() - 1).bit_length())
    coded = materialise(
        rows.mapInArrow(_chunks(bits), T.StructType([
            T.StructField("chunk", T.LongType()), T.StructField("bucket", T.LongType()), T.StructField("hashes", T.BinaryType()),
            T.StructField("learned", T.BinaryType()), ids, *binary,
        ])), "coded-chunks",
    )
    lists = coded.where("bucket >= 0").select("chunk", "bucket", "hashes", "learned")
    summed = materialise(
        lists.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _added, "chunk long, bucket long, counts binary, tokens array<long>, words array<long>, top array<long>, top_counts array<long>,"
            " top_ranks array<long>, ranks binary, part_tokens binary, part_words binary"
        ), "word-counts",
    )
    vocabulary = _vocabulary(summed)
    trees = _trees(summed, vocabulary, bits)
    # a row for each chunk, in as many files as chunks or fewer: the rounds and the scores read them without an exchange
    n_chunks = max(1, coded.where("bucket < 0").count())
    joined = coded.drop("learned").unionByName(
        summed.where("chunk >= 0").select("chunk", "bucket", "counts", "ranks"), allowMissingColumns=True
    ).repartition(n_chunks, "chunk").sortWithinPartitions("chunk", "bucket")
    classed = materialise(
        joined.mapInArrow(_classed(vocabulary, trees), T.StructType([
            T.StructField("chunk", T.LongType()), ids,
            *[T.StructField(n, T.BinaryType()) for n in ("held", "lengths", "codes", "kinds", "seen", "parts", "places", "rows", "base", "known")],
        ])).withColumn("turn", F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)).cast("int")), "class-chunks", "turn",
    )
    discard(coded)
    discard(summed)
    weights = fresh_weights() | {"bias": vocabulary.log_shares()}
    shapes = {k: weights[k].shape for k in sorted(weights)}
    for turn in range(ROUNDS):
        mine = classed.where(F.col("turn") == turn)
        # as many values as the network has weights
        means = mine.mapInArrow(_trained(weights, trees), "block long, values binary, tokens double").repartition(
            "block").sortWithinPartitions("block").mapInArrow(_averaged, "block long, values binary").orderBy("block").collect()
        if means:
            flat, at = np.concatenate([np.frombuffer(m["values"], dtype=np.float32) for m in means]), 0
            for k, shape in shapes.items():
                size = int(np.prod(shape))
                weights[k] = flat[at : at + size].reshape(shape)
                at += size
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    return classed.mapInArrow(_scored(weights, trees, names), schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
