"""Hard negatives and near copies of vectors: brute force, bounds, odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from cuelake.llm import hardneg, passes


def clusters(rng, sizes, noise, d=24):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(d)
        rows += [centre / np.linalg.norm(centre) + noise * rng.standard_normal(d) / d**0.5 for _ in range(size)]
    return [[float(x) for x in row] for row in rows]


def linked(vectors, least=0.9):
    """Brute force: {id: (links, component)} of (id, vector or None) rows with distinct ids."""
    ids = [i for i, _ in vectors]
    fine = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v in vectors]
    hit = {i: set() for i in ids}
    for a, (i, v) in enumerate(vectors):
        for b, (j, w) in enumerate(vectors):
            if a != b and fine[a] and fine[b] and np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                hit[i].add(j)
    root = {i: i for i in ids}
    for _ in ids:
        root = {i: min([root[i], *(root[j] for j in hit[i])]) for i in ids}
    return {i: (len(hit[i]), root[i], root[i] == i) for i in ids}


def near(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, vec array<double>, node long, hash string")
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in passes.near_links(frame, **settings).collect()}


def test_links_beyond_the_window(spark):
    """Groups far larger than the window: links are counted whole, and chains are joined."""
    rng = np.random.default_rng(2)
    vectors = clusters(rng, [60, 25, 1, 1], 0.25) + clusters(rng, [40], 0.48)
    t = np.linspace(0, 1.6, 12)
    vectors += [[float(np.cos(x)), float(np.sin(x)), *[0.0] * 22] for x in t]
    rows = [(7 * k % 1009, v, 1, "x") for k, v in enumerate(vectors)]
    assert near(spark, rows, window=16, goal=0.999999) == linked([r[:2] for r in rows])


def test_recall_at_the_least_cosine():
    """Pairs that just reach the cosine, among many others, over the number of passes the goal asks for."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((20_000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * base[:400]).sum(axis=1, keepdims=True) * base[:400]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    units = np.concatenate([base, 0.905 * base[:400] + (1 - 0.905**2) ** 0.5 * side])
    found = set()
    for number in range(passes.passes_for(len(units))):
        order = np.argsort(passes.signs(units, number, 11), kind="stable")
        found |= {tuple(sorted(pair)) for pair in order[passes.forest_of_windows(units[order], 0.9, passes.WINDOW)].tolist()}
    assert len(found & {(k, 20_000 + k) for k in range(400)}) >= 0.9 * 400


def test_forest_joins_what_its_window_shows():
    rng = np.random.default_rng(9)
    units = np.array(clusters(rng, [50, 3, 80], 0.3, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    cos = units @ units.T
    want = np.arange(len(units))
    for _ in units:
        for i in range(len(units)):
            for j in range(i + 1, min(len(units), i + 65)):
                if cos[i, j] >= 0.9:
                    want[[i, j]] = want[[i, j]].min()
    got = np.arange(len(units))
    links = passes.forest_of_windows(units, 0.9, 64)
    for _ in units:
        for i, j in links.tolist():
            got[[i, j]] = got[[i, j]].min()
    assert (got == want).all()


def test_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0], [-3.0, 0.5, 1.0]
    rows = [(1, v), (2, v), (3, [2 * x for x in v]), (4, w), (5, None), (6, []), (7, [0.0] * 3), (8, [1.0, None, 0.0]), (9, [1.0, float("nan"), 0.0]),
            (10, [1.0, float("inf"), 0.0]), (11, [1.0, 2.0]), (12, [1e300, 2e300, 3e300])]
    got = near(spark, [(*r, 1, "x") for r in rows])
    alone = {i: (0, i, True) for i in range(4, 12)}
    assert got == alone | {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 12: (3, 1, False)}
    frame = spark.createDataFrame([(1, v), (1, v), (1, w), (None, v), (None, w), (None, None)], "vec_id long, vec array<float>")
    again = sorted(map(str, map(tuple, passes.near_links(frame).collect())))
    assert again == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (1, 1, 1, True), (None, 2, 1, False), (None, 1, 1, False), (None, 0, None, True)]))
    assert passes.near_links(frame.where("false")).collect() == []
    assert [r["n_links"] for r in passes.near_links(frame.limit(1)).collect()] == [0]


def mined(rows, anchors, low=30, high=90):
    """Brute force of the negatives rule on (id, label, ints) rows with distinct ids."""
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        score = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, other, w in rows if i != a)
        for s, i, _ in [x for x in score if x[2]][:5]:
            fits = [x for x in score if not x[2] and low * -s <= 100 * -x[0] <= high * -s][:10]
            out += [(a, i, rank, x[1], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out)


def negatives(spark, rows, anchors, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, label int, vec array<long>").selectExpr("*", "'x' as row", "1 as chunk")
    asked = spark.createDataFrame([(a,) for a in anchors], "vec_id long")
    return sorted(map(tuple, hardneg.hard_negatives(frame, asked, **settings).collect()))


@pytest.mark.parametrize("settings", [{}, {"block": 4, "chunk": 50}])
def test_negatives_brute_force(spark, settings):
    rng = np.random.default_rng(4)
    v = np.floor(40 * np.array(clusters(rng, [90, 5, 60, 1, 1], 0.8, 12))).astype(int).tolist()
    rows = [(k, int(rng.integers(0, 3)), x) for k, x in enumerate(v)]
    anchors = list(range(0, len(rows), 6))
    want = mined(rows, set(anchors))
    assert len(want) > 200 and negatives(spark, rows, anchors, **settings) == want


def test_bounds_spare_scores():
    """Near anchors: most rows are never scored at a child, and what is left out lies outside the window."""
    rng = np.random.default_rng(1)
    anchors = np.floor(1000 * np.array(clusters(rng, [30], 0.01, 16)))
    rows = np.floor(1000 * np.array(clusters(rng, [1] * 400, 0.0, 16)))
    order, parent, edge = hardneg.spanning_tree(anchors)
    place = np.argsort(order)
    anchors, edge = anchors[order], edge[order]
    parent = np.where(parent[order] < 0, -1, place[parent[order]])
    norms, scored = np.linalg.norm(rows, axis=1), []
    window = (300_000, 400_000)
    hardneg.walk(anchors, parent, edge, rows, norms, lambda a: (np.ones(400, bool), [window]), lambda a, at, score: scored.append((a, set(at.tolist()))))
    for a, at in scored:
        exact = rows @ anchors[a]
        assert {i for i in range(400) if window[0] <= exact[i] <= window[1]} <= at
    assert sum(len(at) for a, at in scored if parent[a] >= 0) < 0.25 * 29 * 400


def test_odd_negatives(spark):
    rows = [(0, 1, [10, 0]), (0, 1, [10, 0]), (1, 1, [10, 1]), (2, 2, [8, 0]), (3, 2, [8, 0]), (4, 2, [10, 0]), (5, 2, [-9, 0]), (6, None, [8, 0]), (None, 2, [8, 0]),
            (7, 2, None), (8, 2, []), (9, 2, [8, None]), (10, 2, [8, 0, 0]), (11, 3, [5, 5]), (12, 2, [0, 0])]
    want = [(0, 1, 1, 2, 100, 80), (0, 1, 2, 3, 100, 80), (0, 1, 3, 11, 100, 50)]
    assert negatives(spark, rows, [0, 6, 7, 99]) == want
    assert negatives(spark, rows, []) == [] and negatives(spark, [], [0]) == []
    same = [(0, 1, [4, 0]), (1, 1, [5, 0]), (1, 1, [6, 0]), (2, 2, [4, 0])]  # an id of two vectors: two rows
    assert negatives(spark, same, [0]) == [(0, 1, 1, 2, 20, 16), (0, 1, 1, 2, 24, 16)]
    big = 1 << 40
    assert negatives(spark, [(0, 1, [1, big]), (1, 1, [3, 4]), (2, 2, [1, 3])], [0]) == [(0, 1, 1, 2, 4 * big + 3, 3 * big + 1)]
