import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from epochloom.llm import alignment as AL
from epochloom.llm.queries import aligned_digests

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, links string, n_a int, groups int"
TEXTS = [
    "The quick brown fox, don't you think?", None, "", " ", "  ", " a", "a ", "a  b", "a\n b\n\n  c\t d \t e", "x" * 4000, "naïve café Ünï ßtraße",
    "日本語 と 日本　語 か　 な", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b c", "one ▁two", "ﬁ ½ é ́x", "a\x00b \x01", "I'll we've 'S 's",
    "word " * 3000, "🙂 🙂🙂 👩‍👩‍👧", "foo   bar    baz", "\xa0nbsp \xa0x  y ​z ﻿w", "Привет, мир! как дела", "12 345 6.7e8 #1 -- __x__", "tab\tend\n",
]


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def tokens(libraries, text):
    """Ids and ends of both vocabularies over the whole text, or None."""
    a, b = libraries
    if not text:
        return None
    alphabet = AL._byte_alphabet()
    want = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    raw_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(raw_a) != want or b"".join(raw_b) != want:
        return None
    return [(ids, np.cumsum(list(map(len, raw))).tolist()) for ids, raw in ((ids_a, raw_a), (ids_b, raw_b))]


def groups_and_links(found):
    """By the definition: bytes where both end a token cut groups; tokens with the same end are linked."""
    (_, ends_a), (_, ends_b) = found
    parts, groups, links = ([], []), [], []
    tokens_at = [dict(zip(ends, ids)) for ids, ends in found]
    for end in sorted({*ends_a, *ends_b}):
        for part, at in zip(parts, tokens_at):
            if end in at:
                part.append(str(at[end]))
        if all(end in at for at in tokens_at):
            groups.append("|".join(map(",".join, parts)))
            links.append((tokens_at[0][end], tokens_at[1][end]))
            parts = [], []
    return groups, links


def brute(libraries, rows):
    out, counts = [], Counter()
    for doc_id, text, *_ in rows:
        found = tokens(libraries, text)
        groups, links = groups_and_links(found) if found else ([], [])
        counts.update(links)
        out.append((doc_id, len(found[0][0]) if found else 0, len(found[1][0]) if found else 0, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted((
        (d, n_a, n_b, len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for d, n_a, n_b, g, links in out
    ), key=str)


def test_equals_the_libraries(spark, libraries):
    rng = random.Random(4)
    pieces = [" ", "  ", "\n", "a", "The", "é", "日", "'s", "1", "-", "▁", "\t", "ß", "word", "\xa0", "　", "🙂"]
    texts = TEXTS + ["".join(rng.choices(pieces, weights=[9, 2, 1, 3, 5, 2, 2, 2, 2, 2, 0.2, 1, 1, 5, 0.5, 0.5, 1], k=40)) for _ in range(200)]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, "null key", "x", 1, 2), (0, TEXTS[0], "x", 1, 2)]
    got = aligned_digests(spark.createDataFrame(rows, SCHEMA).repartition(5))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = sorted(map(tuple, got.select(*names).collect()), key=str)
    assert found == brute(libraries, rows)


def test_cache_does_not_matter(monkeypatch):
    one = AL.ChunkAligner(A, B)
    want = [x.to_pylist() for x in one.align(pa.array(TEXTS))]
    monkeypatch.setattr(AL, "CACHED_CHUNKS", 3)
    got = [[x[0] for x in (column.to_pylist() for column in one.align(pa.array([t])))] for t in ["a b c d e", *TEXTS]]
    assert [list(x) for x in zip(*got[1:])] == want


@pytest.mark.parametrize("seed", range(20))
def test_coalescing_equals_pairwise_overlap(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 60)

    def cut():
        ends = sorted({n, *(i for i in range(1, n) if rng.random() < 0.5)})
        return ends, np.diff([0, *ends])

    (a_ends, a), (b_ends, b) = cut(), cut()
    found = AL.coalesced(a, b)
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if a_ends[i] - a[i] < b_ends[j] and b_ends[j] - b[j] < a_ends[i]]
    assert list(zip(found.a_of_pair.tolist(), found.b_of_pair.tolist())) == want
    common = sorted(set(a_ends) & set(b_ends))
    assert found.a_group.tolist() == np.searchsorted(common, a_ends).tolist()
    assert found.b_group.tolist() == np.searchsorted(common, b_ends).tolist()


def test_pair_table_is_bounded():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    assert AL.pair_bound({0: b"ab", 1: b"b"}, {0: b"b", 1: b"xab", 2: b"a"}) == 4
    assert AL.pair_bound(AL.byte_level_tokens(a), AL.piece_tokens(b)) < 1_000_000


def test_empty_table(spark):
    assert aligned_digests(spark.createDataFrame([], SCHEMA)).count() == 0
