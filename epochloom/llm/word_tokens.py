"""Token ids of whole texts by the ``tokenizers`` library, one library call per distinct word.

The vocabulary lower-cases, drops white space and never joins across it, so the ids of a text are the ids
of its blank-separated words in turn. Arrow splits and numbers the words of a batch; a word ending in an
ASCII letter and marks (``the.``) is looked up as letters and marks, as the vocabulary splits there too.
The words seen so far are kept per Python worker up to ``CACHED_WORDS``; the cache only saves time.
Strings of special tokens in a text are special tokens, as the library reads them by default. Words with
characters beyond ASCII, or with the beginning of a special token, go to the library as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_WORDS = 400_000
SLICE_BYTES = 4 << 20
#: Every special token begins with it.
SPECIAL_OPENING = "<|"
_MARKS = ".,!?;:#$%&*|)\"-"
_encoders: dict = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for the vocabulary file at ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[start : start + length]``."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text; a longer single text is a piece of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(sizes, dtype=np.int64) - 1) // most
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)


class WordCache:
    """Ids of the strings met so far in this worker; subclasses say how new ones are encoded."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.known[""] = 0
        self.flat, self.used = np.zeros(1 << 20, dtype=np.uint32), 0
        self.start, self.size = np.zeros(1 << 18, dtype=np.int64), np.zeros(1 << 18, dtype=np.int32)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, n = len(self.known), len(words)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
        if first + n > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * (first + n)), np.resize(self.size, 2 * (first + n))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + n] = sizes
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + n)))

    def _learn(self, words: list[str]) -> None:
        """Add the ids of words that are not known yet."""
        raise NotImplementedError

    def _slots(self, words: pa.Array) -> np.ndarray:
        listed = words.to_pylist()
        new = [w for w in dict.fromkeys(listed) if w not in self.known]
        if new:
            self._learn(new)
        known = self.known
        return np.fromiter((known[w] for w in listed), dtype=np.int64, count=len(listed))

    def _ids(self, slots: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.start[slots], self.size[slots].astype(np.int64))


class WordEncoder(WordCache):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if not all(content.startswith(SPECIAL_OPENING) for content in special):
            raise ValueError(f"special tokens other than {SPECIAL_OPENING}... are not supported: {special}")
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[str]) -> None:
        """Encode words for the first time: runs of plain words in one text, told apart by their last token."""
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            ids = np.array(self.library.encode(" ".join(part), add_special_tokens=False).ids, dtype=np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self._add(part, ids, np.diff(stops, prepend=0))
            else:
                other += part
        for at in range(0, len(other), 4096):
            part = other[at : at + 4096]
            found = [e.ids for e in self.library.encode_batch_fast(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self._add(part, np.array([i for ids in found for i in ids], dtype=np.uint32), sizes)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each; ``end_id`` closes every text."""
        if len(self.known) > CACHED_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
        offsets -= offsets[0]
        distinct = words.dictionary
        as_is = pc.or_(pc.invert(pc.string_is_ascii(distinct)), pc.match_substring(distinct, SPECIAL_OPENING))
        distinct = pc.if_else(as_is, distinct, pc.ascii_lower(distinct))
        cores = pc.utf8_rtrim(distinct, characters=_MARKS)
        cores = pc.if_else(pc.match_substring_regex(cores, "[a-z]$"), cores, distinct)
        core_bytes = pc.binary_length(cores).to_numpy()
        all_bytes = pc.binary_length(distinct).to_numpy()
        cut = np.flatnonzero(core_bytes < all_bytes)
        listed = distinct.take(pa.array(cut)).to_pylist()
        kept = pc.utf8_length(cores).to_numpy()[cut]
        tail_words = pa.array([w[k:] for w, k in zip(listed, kept)], pa.string()).dictionary_encode()
        unique = cores.dictionary_encode()
        slot = self._slots(unique.dictionary)[unique.indices.to_numpy()]
        tail = np.zeros(len(distinct), dtype=np.int64)
        if len(cut):
            tail[cut] = self._slots(tail_words.dictionary)[tail_words.indices.to_numpy()]
        index = words.indices.to_numpy()
        pairs = np.empty((len(index), 2), dtype=np.int64)
        pairs[:, 0], pairs[:, 1] = slot[index], tail[index]
        sizes = self.size[pairs]
        per_word = sizes.sum(axis=1)
        total = np.concatenate([[0], np.cumsum(per_word)])
        counts = total[offsets[1:]] - total[offsets[:-1]]
        ids = self._ids(pairs.ravel())
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
            counts = counts + 1
        return ids, counts
