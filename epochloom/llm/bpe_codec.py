"""Byte-level BPE in DuckDB: recursive contraction of token-position rows, ordered aggregation back.

Every partition works for itself. A text is cut where white space begins, which no match of the pattern
crosses; Arrow numbers the distinct pieces, the pattern splits them into words, and words not met before
become rows (word, position, token). A recursive query joins neighbouring tokens with the merge table and
contracts the pair of least rank in each word until no pair merges. A step takes all its occurrences, from the
left, that do not overlap. That equals one at a time in a vocabulary whose tokens' own bytes encode to them,
as a merge then never makes a pair of lower rank; a vocabulary without this property is refused. A query runs ``_steps`` rounds at most, which bounds its rows; unfinished
words go into the next. Decoding aggregates ids in order of position and takes the bytes of each.

Behaviour: NULL text counts as empty and has no ids; NULL ids decode to NULL; an id outside the vocabulary
is an error. Repeated rows give repeated results. Other columns are not read. No special tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochloom.functions.columns import column
from epochloom.llm.stages import bounded_batches
from epochloom.llm.word_tokens import WordCache, slices

#: Bytes of new words in one query, and rows a query may produce.
QUERY_BYTES, QUERY_ROWS = 1 << 18, 2 << 20
CACHED_WORDS = 600_000
#: Fixed value: Unicode white space, which is what the blank class of the pattern means.
SPACES = "\t-\r \x85\xa0  -     　"

#: One step for every live word: the first pair of each run of equal tokens, and every other pair, of least rank.
#: A key is word and token, so that one sort by place and one key a neighbour serve all words.
_CONTRACT = """
WITH RECURSIVE state AS (
    SELECT pos, word::BIGINT << 32 | tok AS key, 0 AS step, true AS live FROM input
  UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT s.*, m.rank, p.rank AS before
        FROM (
            SELECT *, lead(key) OVER w AS next, lag(key) OVER w AS prev, lag(key, 2) OVER w AS prev2
            FROM state WHERE live AND step < {steps} WINDOW w AS (ORDER BY pos)
        ) s LEFT JOIN merges m ON m.pair = CASE WHEN key >> 32 = next >> 32 THEN (key & 4294967295) << 32 | (next & 4294967295) END
            LEFT JOIN merges p ON p.pair = CASE WHEN key >> 32 = prev >> 32 THEN (prev & 4294967295) << 32 | (key & 4294967295) END
    ), best AS (SELECT key >> 32 AS word, min(rank) AS low FROM pairs GROUP BY 1)
    SELECT pos, CASE WHEN rank = low AND (key <> next OR key IS DISTINCT FROM prev) THEN word << 32 | rank ELSE key END,
           step + 1, low IS NOT NULL
    FROM pairs JOIN best ON word = key >> 32
    WHERE low IS NULL OR before IS DISTINCT FROM low OR (prev = key AND prev2 IS NOT DISTINCT FROM prev))
)
SELECT (key >> 32)::INT AS word, pos, (key & 4294967295)::INT AS tok, live
FROM state WHERE NOT live OR step = {steps} ORDER BY pos
"""
#: The same with every second pair of a run, for long words, whose runs may be long.
_CONTRACT_RUNS = """
WITH RECURSIVE state AS (
    SELECT word, pos, tok, 0 AS step, true AS live FROM input
  UNION ALL
    SELECT word, pos, CASE WHEN rank = low AND (tok <> next OR (place - run) % 2 = 0) THEN rank ELSE tok END,
           step + 1, low IS NOT NULL
    FROM (
        SELECT *, min(rank) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS low,
               max(CASE WHEN prev = tok THEN NULL ELSE place END) OVER w AS run
        FROM (
            SELECT s.*, m.rank, p.rank AS before
            FROM (
                SELECT *, lead(tok) OVER w AS next, lag(tok) OVER w AS prev, row_number() OVER w AS place
                FROM state WHERE live AND step < {steps} WINDOW w AS (PARTITION BY word ORDER BY pos)
            ) s LEFT JOIN merges m ON m.l = tok AND m.r = next LEFT JOIN merges p ON p.l = prev AND p.r = tok
        ) WINDOW w AS (PARTITION BY word ORDER BY pos)
    )
    WHERE low IS NULL OR before IS DISTINCT FROM low OR (prev = tok AND (place - run) % 2 = 0)
)
SELECT word, pos, tok, live FROM state WHERE NOT live OR step = {steps} ORDER BY pos
"""
LONG_WORD = 64

_DECODE = "SELECT doc, list(tok ORDER BY pos) AS toks FROM ids GROUP BY doc ORDER BY doc"

_coders: dict = {}


def coder(path: str, pattern: str) -> Coder:
    """This worker's coder for the rank file at ``path``."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def blank_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut where a run of white space begins, and how many pieces each text has."""
    n = len(texts)
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1]
    if n == 0 or edges[-1] == edges[0]:
        return pa.array([], pa.string()), np.zeros(n, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, blank[:-1]
    if any((data == lead).any() for lead in (0xC2, 0xE1, 0xE2, 0xE3)):  # wider spaces: no cut just behind them
        for found in regex.finditer(_WIDE_SPACE, data.tobytes()):
            if found.end() < len(data):
                before[found.end()] = True
    cut = blank & ~before
    cut[edges[:-1][edges[:-1] < edges[1:]]] = True
    starts = np.flatnonzero(cut).astype(np.int32)
    offsets = np.append(starts, np.int32(len(data)))
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return pieces, np.diff(np.searchsorted(starts, edges))


_WIDE_SPACE = b"|".join(
    regex.escape(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


class Coder(WordCache):
    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        # the library's blanks are Unicode white space
        pattern = pattern.replace("[^\\s", "[^" + SPACES).replace("\\s", f"[{SPACES}]").replace("\\S", f"[^{SPACES}]")
        self.split = regex.compile(pattern).findall
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.sql = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        merges = np.array(
            [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks],
            dtype=np.int32,
        ).reshape(-1, 3)
        pair = merges[:, 0].astype(np.int64) << 32 | merges[:, 1]
        self._load("merges", l=merges[:, 0], r=merges[:, 1], rank=merges[:, 2], pair=pair)
        self.valid = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.valid[list(ranks.values())] = True
        of_rank = {rank: token for token, rank in ranks.items()}
        self.pieces = pa.array([of_rank.get(i) for i in range(len(self.valid))], pa.large_binary())
        if (self._contracted(list(ranks), _CONTRACT_RUNS)[1] != 1).any():
            raise ValueError(f"{path}: some tokens cannot be reached from their own bytes")

    def _load(self, name: str, **columns) -> None:
        self.sql.register("source", pa.table(columns))
        self.sql.execute(f"CREATE TABLE {name} AS FROM source")
        self.sql.unregister("source")

    def _contracted(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = np.arange(len(word), dtype=np.int32)
        tok = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        done = [(np.zeros(0, np.int32), np.zeros(0, np.int32))]
        while len(word):
            self.sql.register("input", pa.table({"word": word, "pos": pos, "tok": tok}))
            steps = max(1, min(32, QUERY_ROWS // len(word)))
            rows = self.sql.sql(query.format(steps=steps)).to_arrow_table()
            word, pos, tok, live = (rows.column(c).to_numpy() for c in ("word", "pos", "tok", "live"))
            done.append((word[~live], tok[~live]))
            word, pos, tok = word[live], pos[live], tok[live]
        word, tok = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return tok[order].astype(np.uint32), np.bincount(word, minlength=len(words))

    def _encode_words(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        block = np.cumsum([0, *map(len, raw)]) // QUERY_BYTES
        edges = [0, *(np.flatnonzero(np.diff(block[:-1])) + 1).tolist(), len(raw)]
        for low, high in zip(edges, edges[1:]):
            for query, chosen in ((_CONTRACT, False), (_CONTRACT_RUNS, True)):
                some = [i for i in range(low, high) if (len(raw[i]) > LONG_WORD) == chosen]
                if some:
                    self._add([words[i] for i in some], *self._contracted([raw[i] for i in some], query))

    def _learn(self, words: list[str]) -> None:
        found = [self.split(w) for w in words]
        new = [p for p in dict.fromkeys(p for pieces in found for p in pieces) if p not in self.known]
        self._encode_words(new)
        several = [(w, pieces) for w, pieces in zip(words, found) if w not in self.known]
        if several:
            slots = np.array([self.known[p] for _, pieces in several for p in pieces], dtype=np.int64)
            ends = np.cumsum([len(pieces) for _, pieces in several])
            total = np.concatenate([[0], np.cumsum(self.size[slots], dtype=np.int64)])[ends]
            self._add([w for w, _ in several], self._ids(slots), np.diff(total, prepend=0))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        if len(self.known) > CACHED_WORDS:
            self._forget()
        pieces, counts = blank_pieces(pc.fill_null(texts, ""))
        named = pieces.dictionary_encode()
        slots = self._slots(named.dictionary)[named.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(self.size[slots], dtype=np.int64)])
        return self._ids(slots), np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes behind the ids of each document."""
        if len(ids) and (ids.max() >= len(self.valid) or not self.valid[ids].all()):
            raise ValueError("an id is outside the vocabulary")
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.sql.register("ids", pa.table({"doc": doc, "pos": np.arange(len(ids)), "tok": ids.astype(np.int32)}))
        rows = self.sql.sql(_DECODE).to_arrow_table()
        out = [b""] * len(counts)
        for chunk_docs, toks in zip(rows.column("doc").chunks, rows.column("toks").chunks):
            pieces = self.pieces.take(toks.flatten())
            edges = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
            ends = np.cumsum(pc.list_value_length(toks).to_numpy())
            data = pieces.buffers()[2]
            for doc, low, high in zip(chunk_docs.to_pylist(), edges[np.append(0, ends[:-1])].tolist(), edges[ends].tolist()):
                out[doc] = data[low:high].to_pybytes()
        return out


def bpe_encoded(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id and ids, as little-endian 32-bit integers in one binary value."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text"):
                ids, counts = coder(ranks, pattern).encode(piece.column("_text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), _blobs(ids, counts)], names=["doc_id", "ids"])

    return rows.mapInArrow(encode, T.StructType([rows.schema["doc_id"], T.StructField("ids", T.BinaryType())]))


def _blobs(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]
    ).cast(pa.binary())


def bpe_decoded(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with the bytes of their ids in ``decoded``."""

    @F.pandas_udf("binary")
    def decode(blobs):
        return blobs.__class__(list(_decoded(blobs, coder(ranks, pattern))), dtype=object)

    return tokens.withColumn("decoded", decode(column(ids)))


def _decoded(blobs, by: Coder) -> Iterator[bytes | None]:
    """Documents in groups of bounded size, as a query takes them."""
    group: list[bytes | None] = []
    held = 0
    for blob in blobs:
        group.append(None if blob is None else bytes(blob))
        held += len(blob or b"")
        if held >= QUERY_ROWS:
            yield from _group(group, by)
            group, held = [], 0
    yield from _group(group, by)


def _group(group: list[bytes | None], by: Coder) -> list[bytes | None]:
    counts = np.array([len(b or b"") // 4 for b in group], dtype=np.int64)
    found = by.decode(np.frombuffer(b"".join(b or b"" for b in group), dtype="<u4"), counts)
    return [None if b is None else f for b, f in zip(group, found)]
