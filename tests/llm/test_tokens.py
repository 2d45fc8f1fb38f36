import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from epochloom.llm import simple8b
from epochloom.llm.packing import best_fit, packed_pieces
from epochloom.llm.word_tokens import encoder
from epochloom.shared import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "á. É. don't DON'T's. <|endoftext|> <|ENDOFTEXT|>x", "", None, "  \x0b\x0c ", " a b\x1cc", "x." * 50,
    "é. é.., 'S. ''s' 5.5 12.a. ﬁ İstanbul. ΣΑΣ. 日本語。x.", '-a- (b) "c"', "the The THE the. the, Theé é. é",
    "word " * 20_000, "y" * 30_000, "| a | b", "a" + "́" * 5,
    "a <|endoftext|> b", "a<|endoftext|>b. x<|startoftext|><|endoftext|>.", "<|ENDOFTEXT|>x <|EndOfText|>", "<|endoftext <|endoftext|>a.",
    "J\u030c H\u0331 T\u0308 W\u030a Y\u030a j\u030c", "ÉCOLE. E\u0301COLE, ÀB.", "\u0301a e<|endoftext|>\u0301",
]
SCHEMA = "doc_id long, text string, key int, length string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def rows():
    return [(i, TEXTS[i % len(TEXTS)], i, "l") for i in range(60)] + [(None, "null key", 0, "l"), (7, TEXTS[7], 7, "l")]


def packed_words(values):
    """Simple-8b by its definition, one value at a time."""
    out = []
    for low in range(0, len(values), simple8b.BLOCK):
        block, i = values[low : low + simple8b.BLOCK], 0
        while i < len(block):
            for s, (n, w) in enumerate(zip(simple8b.COUNTS.tolist(), simple8b.WIDTHS.tolist())):
                some = block[i : i + n]
                if all(x < 1 << w for x in some):
                    out.append(s << 60 | sum(x << k * w for k, x in enumerate(some)))
                    i += n
                    break
            else:
                out += [simple8b.ESCAPE << 60, block[i]]
                i += 1
    return out


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("bits", [0, 1, 3, 16, 40, 60, 64])
def test_simple8b_words(n, bits):
    rng = np.random.default_rng(n + bits)
    values = rng.integers(0, 2**bits, size=n, dtype=np.uint64)
    values[::3] >>= np.uint64(bits // 2)
    words, offsets = simple8b.encode(values)
    assert words.tolist() == packed_words(values.tolist())
    assert (simple8b.decode(words, offsets, n) == values).all()


def test_word_encoder_is_the_library(library):
    import pyarrow as pa

    ids, counts = encoder(PATH).encode(pa.array(TEXTS), 1)
    want = [ids_of(library, t) for t in TEXTS]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == np.concatenate(want).tolist()


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_are_encoded_as_by_the_library(library, seed):
    import pyarrow as pa

    rng = random.Random(seed)
    pieces = ["a", "The", "É", "e\u0301", "J\u030c", "\u0331", " ", " ", "\n", "\xa0", ".", ",", "'s", "<|", "|>", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "日", "9", "İ", "ß"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(500)]
    ids, counts = encoder(PATH).encode(pa.array(texts), 1)
    want = [ids_of(library, t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == np.concatenate(want).tolist()


def test_token_files_round_trip(spark, library):
    path = shared_path(spark, "files")
    simple8b.write_token_files(spark.createDataFrame(rows(), SCHEMA).repartition(5), path, PATH)
    whole = simple8b.read_token_files(spark, path).collect()
    by_key = sorted(whole, key=lambda r: r.start)
    assert [r.doc_id for r in by_key] == sorted([r[0] for r in rows()], key=lambda k: -1 if k is None else k)
    texts = {r[0]: r[1] for r in rows()}
    before = 0
    for r in by_key:
        want = ids_of(library, texts[r.doc_id]).tolist()
        assert (r.start, r.n_tokens, r.ids) == (before, len(want), want)
        before += len(want)
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in simple8b.read_token_files(spark, path, checksum=True).collect()}
    assert sums == {(r.doc_id, r.start): crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in whole}


def test_packing_fills_without_gaps(spark, library):
    got = packed_pieces(spark.createDataFrame(rows(), SCHEMA).repartition(5), PATH).collect()
    places, texts = {}, {r[0]: r[1] for r in rows()}
    for r in got:
        want = ids_of(library, texts[r.doc_id])[r.start : r.start + r.length]
        assert r.ids == want.tobytes() and r.ids_crc32 == crc32(r.ids) and r.start == 4096 * r.piece
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 4096
    total = sum(len(ids_of(library, r[1])) for r in rows())
    assert sum(r.length for r in got) == total and len(places) == -(-total // 4096)


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    pieces = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    rooms = []
    for piece in pieces:
        fitting = [i for i, r in enumerate(rooms) if r >= piece]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= piece
        else:
            rooms.append(100 - piece)
    moves, used = best_fit({n: pieces.count(n) for n in set(pieces)}, 100)
    assert used == len(rooms)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    path = shared_path(spark, "files")
    simple8b.write_token_files(empty, path, PATH)
    assert simple8b.read_token_files(spark, path).count() == 0
    assert packed_pieces(empty, PATH).count() == 0
