import random
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from epochloom.llm.stages import kept_documents

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(6)

    def prose(n):
        return " ".join(rng.choice(["river", "stone", "evening", "the", "of", "light", "moved", "and"]) + rng.choice(["", "", "ing", "er", "s"]) + str(rng.choice(["", "", "", "ly"])) + rng.choice(["", ","]) for _ in range(n)) + "."

    texts = [prose(rng.randint(40, 120)) for _ in range(60)]
    texts += [" ".join("###%%%" for _ in range(50 + i)) for i in range(20)]
    exact = prose(80)
    near = prose(100)
    passage = prose(60)
    texts += [exact, exact.replace(" ", "\n"), exact + "  "]
    texts += [near, near.replace("river", "lake", 1), near + " again"]
    texts += [prose(50) + " " + passage + " " + prose(50) for _ in range(3)]
    texts += ["", None]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, int("###" not in (t or "")), 0) for i, t in enumerate(texts[:80])]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, passage


def test_stages(spark, tables):
    folder, rows, passage = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(path := f"{folder}/{name.replace(' ', '_')}")
        docs = spark.read.parquet(path)
        kept.append({r[0]: r for r in docs.collect()} if name != "best-fit packing" else docs.collect())
    graded, unlike, apart, cut, packed = kept
    for stage in kept[:4]:
        assert docs is not None and all(set(stage) <= set(before) for before in kept[: kept.index(stage)])
    assert set(graded) >= set(range(60)) and not set(graded) & set(range(60, 80))
    assert set(unlike) & {80, 81, 82} == {82} and set(unlike) >= set(range(60)) | {83, 84, 85}
    assert set(apart) & {83, 84, 85} == {83} and set(apart) >= set(range(60)) | {82, 86, 87, 88}
    assert all(passage[5:-5] not in cut[d].text and len(cut[d].text) > 200 for d in (86, 87, 88))
    assert cut[82].text == rows[82][1] and all(r.n_chars == len(r.text or "") for r in cut.values())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = defaultdict(int)
    for r in packed:
        tokens[r.doc_id] += r.length
    assert dict(tokens) == {d: 1 + len(library.encode(r.text or "", add_special_tokens=False).ids) for d, r in cut.items()}
    assert len({r.sequence_id for r in packed}) == -(-sum(tokens.values()) // 4096)
    assert corpus_pipeline.run(spark, folder).count() == len(packed)


def test_kept_rows_of_one_identifier(spark):
    docs = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "c", 7), (2, "d", 8), (2, "d", 9)], "doc_id long, text string, _place int")
    from epochloom.llm.exact_dedup import exact_groups
    from epochloom.llm.minhash_dedup import near_documents

    assert sorted(map(str, kept_documents(docs, exact_groups(docs)).select("doc_id", "text").collect())) == sorted(
        map(str, docs.dropDuplicates(["doc_id", "text"]).select("doc_id", "text").collect())
    )
    assert kept_documents(docs, near_documents(docs)).count() == 5
