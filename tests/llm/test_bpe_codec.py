import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from epochloom.llm.bpe_codec import _CONTRACT, _CONTRACT_RUNS, _DECODE, bpe_decoded, bpe_encoded, coder

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SPACES = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　"
TEXTS = [
    "", None, " ", "the cat  sat.\n\n on it's   mat\t\t", "\xa0\xa0\n w", "\x1c\x1d a", "日本語のテキスト。 ok",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|> é é", "x" * 5000, "12345 67,890", "word " * 3000, " \n a",
]
SCHEMA = "doc_id long, text string, ids int, decoded int"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n=150):
    rng = random.Random(4)
    letters = "abcdetionrsäßéñ'sLVE0159!?.#ж日" + SPACES * 2
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_ids_and_round_trip(spark, library):
    texts = TEXTS + random_texts()
    rows = [(i, t, 0, 0) for i, t in enumerate(texts)] + [(None, "no key", 0, 0), (3, TEXTS[3], 0, 0)]
    tokens = bpe_encoded(spark.createDataFrame(rows, SCHEMA).repartition(4), PATH, PATTERN)
    got = bpe_decoded(tokens, PATH, PATTERN).collect()
    assert len(got) == len(rows)
    by_id = dict((r[0], r[1]) for r in rows)
    for r in got:
        text = by_id[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert bytes(r.decoded) == text.encode()


def contracted_one_by_one(ranks, word):
    tokens = [bytes([b]) for b in word]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]
        if not found:
            return [ranks[t] for t in tokens]
        i = min(found)[1]
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]


@pytest.mark.parametrize("query", [_CONTRACT, _CONTRACT_RUNS])
def test_steps_equal_one_contraction_at_a_time(query):
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    words = [t.encode() for t in random_texts(80) if t]
    words += [b"a" * 40, b"ab" * 33, b"aaabaaab" * 9, b"***", b"334", "éé".encode() * 20, b"x"]
    ids, counts = coder(PATH, PATTERN)._contracted(words, query)
    want = [contracted_one_by_one(ranks, w) for w in words]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_null_and_unknown_ids(spark):
    rows = [(1, None), (2, b"")]
    got = bpe_decoded(spark.createDataFrame(rows, "doc_id int, ids binary"), PATH, PATTERN).collect()
    assert {r.doc_id: r.decoded for r in got} == {1: None, 2: b""}
    with pytest.raises(ValueError):
        coder(PATH, PATTERN).decode(np.array([10**6]), np.array([1]))


def test_empty_table(spark):
    assert bpe_decoded(bpe_encoded(spark.createDataFrame([], SCHEMA), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_sliced_arrays():
    texts = pa.array(["drop", "a b", None, "c  d"]).slice(1)
    ids, counts = coder(PATH, PATTERN).encode(texts)
    assert counts.tolist()[1] == 0 and b"".join(coder(PATH, PATTERN).decode(ids, counts)) == b"a bc  d"


def test_words_of_a_query_share_one_sort():
    """A step sorts integer places once, whatever the number of words, and decoding sorts no byte strings."""
    found = coder(PATH, PATTERN)
    found.sql.register("input", pa.table({c: pa.array([0], pa.int32()) for c in ("word", "pos", "tok")}))
    found.sql.register("ids", pa.table({c: pa.array([0], pa.int32()) for c in ("doc", "pos", "tok")}))
    step, back = (found.sql.sql("EXPLAIN " + q).fetchall()[0][1] for q in (_CONTRACT.format(steps=2), _DECODE))
    assert "PARTITION BY" not in step and "JOIN" not in back and "list" in back


def test_neighbouring_words_do_not_merge():
    words = [b"t", b"h", b"e", b"aa", b"aaa", b"a", b"a", b"in", b"g"]
    ids, counts = coder(PATH, PATTERN)._contracted(words, _CONTRACT)
    alone = [coder(PATH, PATTERN)._contracted([w], _CONTRACT)[0].tolist() for w in words]
    assert ids.tolist() == sum(alone, []) and counts.tolist() == list(map(len, alone))


def test_decoded_documents_keep_their_bounds():
    texts = pa.array(["", "a b", None, "日本 x", "", "long " * 70_000, "z"])
    ids, counts = coder(PATH, PATTERN).encode(texts)
    assert coder(PATH, PATTERN).decode(ids, counts) == [(t or "").encode() for t in texts.to_pylist()]
