"""Alignment of the tokens of two vocabularies over the same bytes.

Both vocabularies cut the bytes of a space and a text into tokens. All tokens of both are sorted by their
start; the running maximum of their ends tells how far the tokens so far reach, and a token that starts there
begins a new group. So groups are cut exactly where both vocabularies end a token. Within a group the
overlapping pairs are expanded; those that end together are links.

Neither vocabulary joins across a single space between other characters, so a text is the sequence of its
blank-led chunks, and a chunk's tokens, groups and links are worked out once per Python worker and kept until
``CACHED_CHUNKS`` or ``CACHED_BYTES`` are reached. The cache only saves time.

How often two ids are linked in the corpus is summed over tasks. Of two tokens that end together the shorter
one's bytes end the longer one's, so at most (tokens x longest token) id pairs are possible in all,
``pair_bound`` of the two vocabularies, whatever the corpus: that table is collected and sent to all tasks.

Behaviour: NULL and empty texts, and texts that either vocabulary does not give back byte for byte, have no
tokens: zeros and an empty string. Strings of special tokens are ordinary text. Repeated rows count each.
Columns other than identifier and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.llm.word_tokens import ragged, slices

CACHED_CHUNKS = 300_000
CACHED_BYTES = 32 << 20
#: Bytes of text that are worked on at a time, and chunks that the libraries get in one call.
SLICE_BYTES = 1 << 20
TOGETHER = 256
#: B's ids lie below this; a pair of ids is ``a * ID_ROOM + b``.
ID_ROOM = 1 << 17
_SPACE = 32
#: First bytes of characters that are no white space in any sense.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = _SOLID[0xC3:0xE0] = _SOLID[0xE4:0xEF] = _SOLID[0xF0:0xF5] = True
_aligners: dict = {}


def aligner(a_file: str, b_file: str) -> ChunkAligner:
    """This worker's aligner for a byte-level vocabulary and a piece vocabulary."""
    if (a_file, b_file) not in _aligners:
        _aligners[a_file, b_file] = ChunkAligner(a_file, b_file)
    return _aligners[a_file, b_file]


def _byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokens(library) -> dict[int, bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    alphabet = _byte_alphabet()
    vocab = library.get_vocab()
    return {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if all(c in alphabet for c in t)}


def piece_tokens(library) -> dict[int, bytes]:
    """Bytes of every id of a piece vocabulary with byte fallback."""
    ids = range(library.get_piece_size())
    return {
        i: bytes([int(library.id_to_piece(i)[1:-1], 16)]) if library.is_byte(i)
        else library.id_to_piece(i).replace("▁", " ").encode()
        for i in ids
    }


def pair_bound(a: dict[int, bytes], b: dict[int, bytes]) -> int:
    """How many id pairs can be linked at all: one token's bytes end with the other's."""
    by_bytes = [{}, {}]
    for known, tokens in zip(by_bytes, (a, b)):
        for raw in tokens.values():
            known[raw] = known.get(raw, 0) + 1
    ends_with = [sum(known.get(raw[i:], 0) for raw in t.values() for i in range(len(raw))) for known, t in zip(by_bytes[::-1], (a, b))]
    return sum(ends_with) - sum(by_bytes[1].get(raw, 0) for raw in a.values())


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Chunks of a space and each text, and the number of chunks of each text.

    A chunk begins with the added space, or with a single space between a character that is no space and one
    that is no white space.
    """
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data if data is not None else b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    begin = offsets[:-1] - offsets[0]
    spaced = np.insert(raw, begin, _SPACE)
    begin = begin + np.arange(len(begin))
    space = spaced == _SPACE
    first = np.zeros(len(spaced), dtype=bool)
    first[1:-1] = space[1:-1] & ~space[:-2] & _SOLID[spaced[2:]]
    first[begin] = True
    starts = np.append(np.flatnonzero(first), len(spaced))
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(spaced.tobytes())])
    return chunks, np.diff(np.searchsorted(starts, np.append(begin, len(spaced))))


@dataclass(frozen=True)
class Aligned:
    """Groups and overlaps of two ways to cut the same bytes."""

    a_group: np.ndarray
    b_group: np.ndarray
    a_of_pair: np.ndarray
    b_of_pair: np.ndarray


def coalesced(a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    """Align two sequences of token lengths with the same sum."""
    end = np.concatenate([np.cumsum(a_size), np.cumsum(b_size)])
    start = end - np.concatenate([a_size, b_size])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    n = len(a_size)
    low = np.searchsorted(end[n:], start[:n], side="right")
    many = np.searchsorted(start[n:], end[:n], side="left") - low
    return Aligned(group[:n], group[n:], np.repeat(np.arange(n), many), ragged(np.arange(len(b_size)), low, many))


class Strings:
    """A string of bytes for each id, laid out for gathering; ids without one have none."""

    def __init__(self, by_id: dict[int, bytes]):
        self.size = np.zeros(max(by_id) + 1, dtype=np.int64)
        self.size[list(by_id)] = [len(raw) for raw in by_id.values()]
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return ragged(self.flat, self.start[ids], self.size[ids]).tobytes()


class ChunkAligner:
    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a.encode_special_tokens = True
        pieces = piece_tokens(self.b)
        if any(b" " in raw.lstrip(b" ") for raw in pieces.values()):
            raise ValueError("pieces that go on after a space are not supported")
        self.bytes_a, self.bytes_b = Strings(byte_level_tokens(self.a)), Strings(pieces)
        #: Every id in decimals, with room for the mark after it.
        self.digits = Strings({i: b"%d," % i for i in range(max(len(self.bytes_a.size), len(self.bytes_b.size)))})
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A, of B, groups; whether the bytes agree
        self.links, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _one_by_one(self, chunks: list[str]) -> list[tuple]:
        """(ids of A, ids of B, whether both give the chunk back) of each chunk."""
        a = [np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = [np.array(ids, dtype=np.int64) for ids in self.b.encode([c[1:] for c in chunks], num_threads=1)]
        none, found = np.zeros(0, dtype=np.int64), []
        for x, y, chunk in zip(a, b, chunks):
            fits = self.bytes_a.joined(x) == chunk.encode() == self.bytes_b.joined(y)
            found.append((x, y, True) if fits else (none, none, False))
        return found

    def _together(self, chunks: list[str]) -> tuple[np.ndarray, ...] | None:
        """Ids of A and of B and their numbers for each chunk, from one text of all; None if they do not fit it."""
        text = "".join(chunks)
        raw = text.encode()
        stops = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        result = []
        for ids, tokens in (
            (self.a.encode(text, add_special_tokens=False).ids, self.bytes_a), (self.b.encode(text[1:]), self.bytes_b),
        ):
            ids = np.array(ids, dtype=np.int64)
            ends = np.cumsum(tokens.size[ids])
            last = np.searchsorted(ends, stops)
            if not len(ends) or last[-1] >= len(ends) or (ends[last] != stops).any() or tokens.joined(ids) != raw:
                return None
            result += [ids, np.diff(last + 1, prepend=0)]
        return tuple(result)

    def _learn(self, chunks: list[str]) -> None:
        """Align chunks that are met for the first time, many in one call of the libraries.

        A chunk that ends with a space would run into the next one, and is encoded alone.
        """
        plain, alone, parts = [c for c in chunks if c[-1] != " "], [c for c in chunks if c[-1] == " "], []
        listed: list[str] = []
        for at in range(0, len(plain), TOGETHER):
            block = plain[at : at + TOGETHER]
            found = self._together(block)
            if found:
                listed += block
                parts.append((*found, np.ones(len(block), dtype=np.int64)))
            else:
                alone += block
        for x, y, fits in self._one_by_one(alone) if alone else ():
            parts.append((x, np.array([len(x)]), y, np.array([len(y)]), np.array([int(fits)])))
        listed += alone
        a_ids, n_a, b_ids, n_b, fits = (np.concatenate(p) for p in zip(*parts))
        sizes = self.bytes_a.size[a_ids], self.bytes_b.size[b_ids]
        found = coalesced(*sizes)
        ends = [np.cumsum(s) for s in sizes]
        together = ends[0][found.a_of_pair] == ends[1][found.b_of_pair]
        a_at, b_at = found.a_of_pair[together], found.b_of_pair[together]
        links = (a_ids[a_at] * ID_ROOM + b_ids[b_at]).astype(np.uint64)
        owner = np.repeat(np.arange(len(listed)), n_a)
        n_links = np.bincount(owner[a_at], minlength=len(listed))
        opens = np.diff(found.a_group, prepend=-1) > 0
        n_groups = np.bincount(owner[opens], minlength=len(listed))
        self.groups += self._written(found, a_ids, b_ids, n_a + n_b)
        self.first = np.append(self.first, len(self.links) + np.cumsum(n_links) - n_links)
        self.size, self.links = np.append(self.size, n_links), np.append(self.links, links)
        self.counts = np.vstack([self.counts, np.column_stack([n_a, n_b, n_groups, fits]).astype(np.int64)])
        self.known.update(zip(listed, range(len(self.known), len(self.known) + len(listed))))
        self.held += sum(map(len, listed))

    def _written(self, found: Aligned, a_ids: np.ndarray, b_ids: np.ndarray, n_tokens: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` of every chunk."""
        side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
        group = np.concatenate([found.a_group, found.b_group])
        order = np.lexsort((side, group))
        ids, group, side = np.concatenate([a_ids, b_ids])[order], group[order], side[order]
        mark = np.full(len(ids), ord(";"), dtype=np.uint8)
        same = group[1:] == group[:-1]
        mark[:-1][same] = np.where(side[1:] == side[:-1], ord(","), ord("|"))[same]
        size = self.digits.size[ids]
        out = ragged(self.digits.flat, self.digits.start[ids], size)
        ends = np.cumsum(size)
        out[ends - 1] = mark
        text = out.tobytes().decode("ascii")
        edges = np.append(0, ends)[np.append(0, np.cumsum(n_tokens))].tolist()
        return [text[low : high - 1] if high > low else "" for low, high in zip(edges, edges[1:])]

    def align(self, texts: pa.Array) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups and links (8 bytes each) of every text."""
        if len(self.known) > CACHED_CHUNKS or self.held > CACHED_BYTES:
            self._forget()
        chunks, per_text = chunks_of(texts)
        coded = chunks.dictionary_encode()
        listed = coded.dictionary.to_pylist()
        new = [c for c in listed if c not in self.known]
        if new:
            self._learn(new)
        known = self.known
        slots = np.fromiter((known[c] for c in listed), dtype=np.int64, count=len(listed))[coded.indices.to_numpy()]
        edge = np.append(0, np.cumsum(per_text))
        sums = np.vstack([np.zeros((1, 4), np.int64), np.cumsum(self.counts[slots], axis=0)])
        whole = np.diff(sums[edge, 3]) == per_text
        counts = np.diff(sums[edge, :3], axis=0) * whole[:, None]
        slot_list, groups = slots.tolist(), self.groups
        strings = [
            ";".join([groups[s] for s in slot_list[low:high]]) if ok else ""
            for low, high, ok in zip(edge.tolist(), edge[1:].tolist(), whole.tolist())
        ]
        kept = slots[np.repeat(whole, per_text)]
        links = ragged(self.links, self.first[kept], self.size[kept])
        n_links = np.diff(np.append(0, np.cumsum(self.size[slots]))[edge]) * whole
        cuts = np.append(0, np.cumsum(n_links)) * 8
        raw = links.tobytes()
        blobs = [raw[low:high] for low, high in zip(cuts.tolist(), cuts[1:].tolist())]
        return [*map(pa.array, counts.T), pa.array(n_links), pa.array(strings, pa.string()), pa.array(blobs, pa.binary())]


def aligned_tokens(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), links (pairs, 8 bytes each)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("_text"))
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text", SLICE_BYTES):
                found = aligner(a_file, b_file).align(piece.column("_text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *found], names=["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, links binary")


def _pairs(links: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a column of links, and how many each row has."""
    sizes = pc.fill_null(pc.binary_length(links), 0).to_numpy(zero_copy_only=False) // 8
    return np.frombuffer(b"".join(links.to_pylist()), dtype=np.uint64), sizes


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often each pair of ids is linked: pair, n. No more rows than ``pair_bound``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new, n = np.unique(_pairs(batch.column("links"))[0], return_counts=True)
            both, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            merged = np.zeros(len(both), np.int64)
            np.add.at(merged, place, np.concatenate([counts, n]))
            keys, counts = both, merged
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], names=["pair", "n"])

    return aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_pair_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of ``links``; read twice, so pass a stored table.

    A link is best if its pair is linked as often as any pair of its B id.
    """
    table = pair_counts(aligned).toArrow()
    keys, n = (table.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    most = np.zeros(ID_ROOM, np.int64)
    np.maximum.at(most, keys % ID_ROOM, n)
    sent = aligned.sparkSession.sparkContext.broadcast((keys.astype(np.uint64), n, n == most[keys % ID_ROOM]))
    names = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = sent.value
        for batch in batches:
            links, sizes = _pairs(batch.column("links"))
            place = np.searchsorted(keys, links)
            edge = np.append(0, np.cumsum(sizes))
            sums = [np.diff(np.append(0, np.cumsum(v[place].astype(np.int64)))[edge]) for v in (best, n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, sums)], names=[*names, "n_best", "count_sum"])

    kinds = [f"{c} {aligned.schema[c].dataType.simpleString()}" for c in names]
    return aligned.mapInArrow(run, ", ".join([*kinds, "n_best long", "count_sum long"]))
