import hashlib
import re

import pytest

from epochloom.llm.exact_dedup import exact_groups

SCHEMA = "doc_id long, text string, keep_id string, _row int"


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", row[1] or ""), []).append(row)
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(r[0], best[0], len(members), digest) for r in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 20, 70])
def test_groups_match_brute_force(spark, partitions):
    texts = ["a b", "ab", " a\tb\n", "", None, "\x0b\x0c\r", "ä b", "äb ", "a b", "x" * 200_000, None]
    rows = [(i, texts[i % len(texts)], "k", i) for i in range(100)] + [(None, "ab", "k", 0), (5, "a b", "k", 0), (5, "a b", "k", 0)]
    got = exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(partitions)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0
