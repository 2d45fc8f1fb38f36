import itertools

import numpy as np
import pytest

from epochloom.llm import e8_dedup
from epochloom.llm.components import components
from epochloom.llm.e8_dedup import lattice_steps, near_vectors, nearest_points

SCHEMA = "vec_id long, embedding array<float>, label int, rep string"


def brute(ids, x, threshold=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        low = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ids))])
        if (low == label).all():
            return linked.sum(axis=1), label
        label = low


def cloud(seed=0):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(300, 64))]
    for spread in (0.02, 0.1, 0.25, 0.3, 0.33):
        centre = rng.normal(size=64)
        parts.append(centre + spread * rng.normal(size=(40, 64)))
    parts.append(np.repeat(rng.normal(size=(1, 64)), 150, axis=0))
    return rng.permutation(np.vstack(parts)).astype(np.float32)


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) * 2
    points = nearest_points(x)
    assert ((2 * points).astype(int) % 2 == (2 * points).astype(int)[:, :1] % 2).all() and (points.sum(axis=1) % 2 == 0).all()
    for step in lattice_steps():
        assert (((x - points) ** 2).sum(axis=1) <= ((x - points - step) ** 2).sum(axis=1) + 1e-9).all()
    assert len(lattice_steps()) == 241


@pytest.mark.parametrize("cell_rows", [2048, 16])
def test_links_and_components_match_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(e8_dedup, "CELL_ROWS", cell_rows)
    x = cloud()
    ids = (np.random.default_rng(3).permutation(len(x)) * 7).tolist()
    rows = [(i, v.tolist(), 0, "r") for i, v in zip(ids, x)]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()}
    degree, label = brute(ids, x.astype(np.float64))
    assert [got[i].n_links for i in ids] == degree.tolist()
    assert [got[i].component_id for i in ids] == label.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("dims", [16, 24, 32, 128, 300])
def test_recall_at_other_widths(dims):
    """Pairs of cosine 0.95 meet in some cell about as often as at 64 components."""
    rng = np.random.default_rng(dims)
    a = rng.normal(size=(4000, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = e8_dedup.cell_codes(a), e8_dedup.cell_codes(b)
    per_table = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3))
    assert per_table.mean() > 0.6 and per_table.any(axis=1).mean() > 0.999


def test_lower_thresholds_are_refused(spark):
    with pytest.raises(ValueError, match="more tables"):
        near_vectors(spark.createDataFrame([], SCHEMA), threshold=0.9)


def test_unusable_vectors_link_with_nothing(spark):
    one = [1.0] * 64
    rows = [
        (1, one, 0, ""), (2, None, 0, ""), (3, [0.0] * 64, 0, ""), (4, [float("nan"), *one[1:]], 0, ""),
        (5, [None, *one[1:]], 0, ""), (6, [float("inf"), *one[1:]], 0, ""), (7, one, 0, ""), (None, one, 0, ""), (8, [], 0, ""),
        (9, one[:3], 0, ""), (7, one, 0, ""), (10, [2.0] * 64, 0, ""),
    ]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    links = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None)
    assert links == sorted(
        [(1, 3, 1, True), (7, 3, 1, False), (7, 3, 1, False), (10, 3, 1, False), *[(i, 0, i, True) for i in (2, 3, 4, 5, 6, 8, 9)]]
    )
    assert [(r.n_links, r.component_id) for r in got if r.vec_id is None] == [(0, None)]


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1), (None, 3)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)],
                                   list(itertools.combinations(range(5), 2)) + [(9, 8), (7, 9)]])
def test_components(spark, links):
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    want = {}
    for a, b in links:
        if a is None or a == b:
            continue
        group = want.get(a, {a}) | want.get(b, {b})
        want.update({n: group for n in group})
    assert got == {n: min(g) for n, g in want.items()}
