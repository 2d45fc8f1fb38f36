"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, components.

SuperMinHash lets every shingle visit the slots of a signature in an order of its own, a permutation drawn
step by step, with the rank ``step + uniform`` at each visit; a slot keeps its least rank. The slots of one
shingle are thus spread evenly, which lowers the variance of the estimate. All shingles of a batch take the
same step together, and a document stops once every slot has a rank that later steps cannot beat.

Documents with equal sets are one class and are never paired. Bands of ``ROWS`` slots make ``BANDS`` keys
per class; a pair at similarity 0.8 shares none with probability 1.3e-7. In each bucket the class with the
smallest identifier is compared with the others on full shingle sets, and verified links are joined into
components. Buckets that still hold several components compare the short signatures of all members across
components, block by block. Where at least ``HOPEFUL`` of the slots agree (a pair at 0.8 falls below with a
probability under 1e-8), the members join one cluster, and in each cluster the full sets of such pairs are
compared, again block by block. Blocks put out forests, no pairs, and a pair is left out only when its ends
are connected already.

Behaviour: NULL text and text without words give an empty set, which links with nothing. Fewer words than a
shingle has make one shorter shingle. Rows without an identifier link with nothing and have no component.
Repeated rows are documents of their own, in one component. Shingles are compared by 64-bit hashes.
Columns other than identifier and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochloom.functions.columns import column
from epochloom.llm.components import components
from epochloom.llm.grouped import runs
from epochloom.llm.stages import bounded_batches, row_key
from epochloom.llm.word_tokens import ragged, slices
from epochloom.shared import materialise

ROWS, BANDS = 5, 40
SLOTS = ROWS * BANDS
#: Members that are compared with one pivot in a task.
PIVOT_ROWS = 1000
#: Members of a bucket, and of a cluster, that are compared with one another in a task.
BLOCK_ROWS, CLUSTER_ROWS = 2048, 512
HOPEFUL = 0.63
#: The least similarity for which the bands and HOPEFUL are made.
LEAST_PERCENT = 80
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(z: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser; fixed constants."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_sets(texts: pa.Array, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    edges = lists.offsets.to_numpy().astype(np.int64)
    named = lists.values.slice(int(edges[0]), int(edges[-1] - edges[0])).dictionary_encode()
    edges -= edges[0]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(w) for w in named.dictionary.to_pylist()), dtype=np.uint64, count=len(named.dictionary)
    )
    full = pc.binary_length(named.dictionary).to_numpy() > 0
    index = named.indices.to_numpy()
    real = full[index] if len(index) else np.zeros(0, dtype=bool)
    words = hashes[index[real]]
    edges = np.concatenate([[0], np.cumsum(real)])[edges]
    counts = np.diff(edges)
    doc = np.repeat(np.arange(len(counts)), counts)
    left = edges[1:][doc] - np.arange(len(words))  # words from here to the end of the text
    shingle = np.zeros(len(words), dtype=np.uint64)
    for k in range(words_each):
        nth = np.zeros(len(words), dtype=np.uint64)
        nth[: max(0, len(words) - k)] = words[k:]
        shingle = np.where(left > k, _mixed(shingle * np.uint64(0x9E3779B97F4A7C15) + nth + np.uint64(k + 1)), shingle)
    whole = (left >= words_each) | (np.arange(len(words)) == edges[:-1][doc])
    doc, shingle = doc[whole], shingle[whole]
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    return shingle[new], np.bincount(doc[new], minlength=len(counts))


def superminhash(shingles: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts, slots); a text without shingles keeps unset slots."""
    out = np.full((len(counts), slots), _UNSET, dtype=np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    jumps: list[np.ndarray] = []
    for step in range(slots):
        if not len(doc):
            break
        draw = _mixed(shingles + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        jump = (step + ((draw & np.uint64(0xFFFF)) * np.uint64(slots - step) >> np.uint64(16))).astype(np.int64)
        # what the swaps of the earlier steps have left at that place of the permutation
        slot = jump
        for earlier in range(step - 1, -1, -1):
            slot = np.where(slot == jumps[earlier], earlier, slot)
        rank = np.uint64(step) << np.uint64(48) | draw >> np.uint64(16)
        np.minimum.at(out.reshape(-1), doc * slots + slot, rank)
        open_docs = (out == _UNSET).any(axis=1)
        going = open_docs[doc]
        if not going.all():
            doc, shingles = doc[going], shingles[going]
            jumps = [j[going] for j in [*jumps, jump]]
        else:
            jumps.append(jump)
    return out


def _signed(words_each: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text", 1 << 19):
                shingles, counts = shingle_sets(piece.column("_text"), words_each)
                signature = superminhash(shingles, counts).reshape(len(counts), BANDS, ROWS)
                short = (signature & np.uint64(0xFF)).astype(np.uint8).reshape(len(counts), SLOTS)
                band = np.zeros((len(counts), BANDS), dtype=np.uint64)
                for r in range(ROWS):
                    band = _mixed(band * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, r])
                band = _mixed(band + np.arange(BANDS, dtype=np.uint64))
                ends = np.cumsum(counts).tolist()
                raw = shingles.tobytes()
                names = [
                    blake2b(raw[8 * (e - n) : 8 * e], digest_size=16).digest() if n else None for e, n in zip(ends, counts.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("_id"), piece.column("_row"), pa.array(counts.astype(np.int64)), pa.array(names, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(counts) + 1) * BANDS, pa.int32()), pa.array(band.view(np.int64).ravel())
                        ),
                        pa.array([row.tobytes() for row in short], pa.binary()),
                    ],
                    names=["_id", "_row", "n_shingles", "_set", "_bands", "_short"],
                )

    return sign


def _verified(words_each: int, percent: int) -> Callable:
    """Links of members whose set is similar to their pivot's; the pivot's text comes first in each group."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own, against = None, None, None
        for batch in batches:
            for piece in slices(batch, "_text", 1 << 19):
                shingles, counts = shingle_sets(piece.column("_text"), words_each)
                ends = np.cumsum(counts)
                columns = {n: piece.column(n).to_pylist() for n in ("pivot", "part", "rep", "is_pivot", "_set")}
                linked: tuple[list, list] = ([], [])
                for i, (name, part, rep, is_pivot, wanted) in enumerate(zip(*columns.values())):
                    some = shingles[ends[i] - counts[i] : ends[i]]
                    if blake2b(some.tobytes(), digest_size=16).digest() != wanted:
                        continue  # another row with this identifier
                    if is_pivot:
                        pivot, own, against = name, part, some
                    elif (pivot, own) == (name, part):
                        common = np.intersect1d(some, against, assume_unique=True).size
                        if 100 * common >= percent * (len(some) + len(against) - common):
                            linked[0].append(name)
                            linked[1].append(rep)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in linked], names=["pivot", "rep"])

    return verify


def _forest(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place that every place is connected with."""
    root, before = np.arange(size), None
    while before is None or (root != before).any():
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
    return root


class _Block:
    """The members of two parts of a bucket or a cluster, in order of their identifiers."""

    def __init__(self, group: pa.Table, percent: int):
        order = np.argsort(group.column("rep").to_numpy(), kind="stable")
        self.rep, self.n, self.component, self.part = (
            group.column(c).to_numpy()[order] for c in ("rep", "n", "component", "part")
        )
        self.short = np.frombuffer(b"".join(group.column("_short").to_pylist()), dtype=np.uint8).reshape(len(order), -1)[order]
        self.order, self.percent = order, percent
        self.across = group.column("low")[0].as_py() != group.column("high")[0].as_py()

    def hopeful(self, i: int) -> np.ndarray:
        """Later members of other components whose sizes and short signatures allow a link with member ``i``."""
        rest = slice(i + 1, len(self.rep))
        fits = np.maximum(self.n[rest], self.n[i]) * self.percent <= np.minimum(self.n[rest], self.n[i]) * 100
        fits &= self.component[rest] != self.component[i]
        if self.across:
            fits &= self.part[rest] != self.part[i]
        some = np.flatnonzero(fits) + i + 1
        return some[(self.short[some] == self.short[i]).sum(axis=1) >= HOPEFUL * self.short.shape[1]]

    def linked(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        left, right = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        root = _forest(len(self.rep), left, right)
        some = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(self.rep[root[some]]), pa.array(self.rep[some])], names=["pivot", "rep"])


def _clustered(percent: int) -> Callable:
    """Forests of the hopeful pairs of each (bucket, part, part)."""

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ("name", "low", "high")):
            block = _Block(group, percent)
            pairs = []
            for i in range(len(block.rep) - 1):
                some = block.hopeful(i)
                if len(some):
                    pairs.append((np.full(len(some), i), some))
            if pairs:
                yield block.linked(pairs)

    return cluster


def _settled(percent: int) -> Callable:
    """Forests of the links of each (cluster, part, part), by the full sets of hopeful pairs."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ("name", "low", "high")):
            block = _Block(group, percent)
            raw = group.column("_shingles").to_pylist()
            sets = [np.frombuffer(raw[i], dtype=np.uint64) for i in block.order]
            sizes = np.array([len(x) for x in sets])
            vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            mark = np.zeros(len(vocabulary), dtype=bool)
            pairs = []
            for i in range(len(sets) - 1):
                some = block.hopeful(i)
                if not len(some):
                    continue
                own = flat[starts[i] : starts[i] + sizes[i]]
                mark[own] = True
                ends = np.cumsum(sizes[some])
                common = np.diff(np.concatenate([[0], np.cumsum(mark[ragged(flat, starts[some], sizes[some])])])[np.append(0, ends)])
                mark[own] = False
                some = some[100 * common >= percent * (sizes[some] + sizes[i] - common)]
                pairs.append((np.full(len(some), i), some))
            yield block.linked(pairs)

    return settle


def _meetings(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with every two parts of each name brought together in (name, low, high)."""
    parts = rows.groupBy("name").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_parts"))
    keys = ("name", "low", "high")
    return (
        rows.join(parts, "name")
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("low", F.least("part", "_other")).withColumn("high", F.greatest("part", "_other"))
        .drop("_parts", "_other").repartition(*keys).sortWithinPartitions(*keys)
    )


def _sets(words_each: int) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_text", 1 << 19):
                shingles, counts = shingle_sets(piece.column("_text"), words_each)
                raw, ends = shingles.tobytes(), np.cumsum(counts)
                sets = [raw[8 * (e - n) : 8 * e] for e, n in zip(ends.tolist(), counts.tolist())]
                same = [blake2b(x, digest_size=16).digest() == w for x, w in zip(sets, piece.column("_set").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("rep"), pa.array(sets, pa.binary())], names=["rep", "_shingles"]
                ).filter(pa.array(same))

    return read


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words_each: int, percent: int) -> DataFrame:
    """The pairs (pivot, rep, rows of their bucket) whose full sets are similar. A pivot's text goes once to each part of its members."""
    # as many parts as the bucket's size asks for, to a power of two
    parts = F.pow(F.lit(2), F.ceil(F.log2(F.col("rows") / PIVOT_ROWS + 1))).cast("long")
    part = parts * (1 << 31) + F.pmod(F.xxhash64("rep"), parts)
    members = pairs.select("pivot", part.alias("part"), "rep", F.lit(False).alias("is_pivot"))
    pivots = members.select("pivot", "part").distinct().select("pivot", "part", F.col("pivot").alias("rep"), F.lit(True).alias("is_pivot"))
    wanted = members.union(pivots).join(classes.select("rep", "_set"), "rep")
    rows = wanted.join(texts.withColumnRenamed("_id", "rep"), "rep")
    grouped = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.desc("is_pivot"))
    return grouped.select("pivot", "part", "rep", "is_pivot", "_set", "_text").mapInArrow(
        _verified(words_each, percent), "pivot long, rep long"
    )


def near_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, row_key. Identifiers are integers.

    Linked are documents whose sets of ``words_each``-word shingles share ``percent`` per cent of their union.
    Less than ``LEAST_PERCENT`` is refused: the bands would miss more pairs than stated.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"less than {LEAST_PERCENT} per cent needs more bands")
    bounded_batches(docs.sparkSession)
    rows = docs.select(column(doc_id).cast("long").alias("_id"), column(text).alias("_text"))
    named = rows.withColumn("_row", row_key(F.col("_id"), F.col("_text")))
    signed = materialise(
        named.mapInArrow(_signed(words_each), "_id long, _row long, n_shingles long, _set binary, _bands array<long>, _short binary"), "signatures"
    )
    usable = signed.where("_id IS NOT NULL AND _set IS NOT NULL")
    classes = materialise(
        usable.groupBy("_set").agg(
            F.min("_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("_bands").alias("_bands"),
            F.first("_short").alias("_short"),
        ),
        "shingle-classes",
    )
    entered = classes.select(F.explode("_bands").alias("key"), "rep", "n")
    pivots = entered.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("rep", "n")).alias("pivot")).where("rows > 1")
    crowded = materialise(
        entered.join(pivots, "key").select("key", "rep", "n", "rows", F.col("pivot.rep").alias("pivot"), F.col("pivot.n").alias("pivot_n")),
        "buckets",
    )
    alike = F.greatest("n", "pivot_n") * percent <= F.least("n", "pivot_n") * 100
    pairs = materialise(crowded.where((F.col("rep") != F.col("pivot")) & alike).groupBy("pivot", "rep").agg(F.max("rows").alias("rows")), "pairs")
    links = materialise(_links(pairs, classes, rows, words_each, percent), "document-links")
    joined = components(links, "pivot", "rep")

    # buckets in which several components meet
    placed = crowded.select("key", "rep").join(joined, F.col("rep") == F.col("node"), "left").select(
        F.col("key").alias("name"), "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = placed.groupBy("name").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    members = placed.join(mixed.select("name"), "name").join(classes.select("rep", "n", "_short"), "rep")
    hopeful = materialise(
        _meetings(members, BLOCK_ROWS).mapInArrow(_clustered(percent), "pivot long, rep long"), "hopeful-documents"
    )
    clusters = components(hopeful, "pivot", "rep").toDF("rep", "name").join(classes.select("rep", "n", "_short", "_set"), "rep")
    wanted = clusters.select("rep", "_set").join(rows.withColumnRenamed("_id", "rep"), "rep").select("rep", "_set", "_text")
    sets = wanted.mapInArrow(_sets(words_each), "rep long, _shingles binary").dropDuplicates(["rep"])
    whole = materialise(
        clusters.drop("_set").join(joined, F.col("rep") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "rep")).drop("node").join(sets, "rep"),
        "clusters",
    )
    more = materialise(
        _meetings(whole, CLUSTER_ROWS).mapInArrow(_settled(percent), "pivot long, rep long"), "document-links"
    )
    if not more.isEmpty():
        joined = components(links.union(more), "pivot", "rep")

    answer = classes.join(joined, F.col("rep") == F.col("node"), "left").select("_set", F.coalesce("component", "rep").alias("component_id"))
    linked = usable.select("_id", "_row", "n_shingles", "_set").join(answer, "_set").select(
        "_id", "_row", "n_shingles", "component_id"
    )
    alone = signed.where("_id IS NULL OR _set IS NULL").select(
        "_id", "_row", "n_shingles", F.col("_id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.col("_row").alias("row_key"),
    )
