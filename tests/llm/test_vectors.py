"""Near-duplicate vectors of several lengths, shared ids and repeated rows, and recall where there are many more lists than a vector looks into."""

import numpy as np
import pytest

from tests.llm import brute
from wattfold.llm import pq_dedup, queries


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.importable(spark)


SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, threshold=0.9):
    """(vec_id, n_links, component_id) of rows, a distinct (id, vector) being one vertex."""
    own = sorted({(-(2**63) if i is None else i, tuple(x)) for i, x in rows if x and all(v is not None and np.isfinite(v) for v in x) and any(x)})
    parts, n = brute.Union(), [0] * len(own)
    for a, (_, x) in enumerate(own):
        for b in range(a):
            y = own[b][1]
            if len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[a], n[b] = n[a] + 1, n[b] + 1
                parts.link(a, b)
    known = {v: (n[k], own[parts.root(k)][0]) for k, v in enumerate(own)}
    return sorted((i, *known.get((-(2**63) if i is None else i, tuple(x or ())), (0, i))) for i, x in rows)


def test_lengths_shared_ids_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    made = [(k, rng.normal(size=8).tolist()) for k in range(30)]
    made += [(100, [1.0, 2.0, 3.0]), (101, [2.0, 4.0, 6.0]), (102, [-1.0, 0.0, 0.0]), (103, [9.0])]
    made += [(200, made[0][1]), (200, made[0][1]), (201, made[0][1]), (300, made[1][1]), (300, made[2][1]), (301, made[2][1])]
    want = plain(made)
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in pq_dedup.near_duplicates(spark.createDataFrame(made, SCHEMA)).collect())
    assert found == want
    assert {r[:2] for r in found if r[0] in (100, 101, 200, 201)} == {(100, 1), (101, 1), (200, 2), (201, 2)}
    # Unrelated vectors under null ids stay apart.
    null = [(None, made[0][1]), (None, made[1][1]), (5, made[0][1]), (9, made[1][1]), (None, None), (None, [0.0] * 8), (8, [None] * 8), (7, [])]
    found = pq_dedup.near_duplicates(spark.createDataFrame(null, SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in found) == [(0, 0, 0, True)] * 2 + [(0, 1, 0, True)] * 2 + [(5, 1, 0, False), (7, 0, 7, True), (8, 0, 8, True), (9, 1, 0, False)]


def test_a_sample_without_a_usable_vector(spark):
    made = [(k, None if k % 2 else [0.0] * 4) for k in range(20_000)] + [(30_000, [1.0] * 4), (30_001, [1.0] * 4)]
    found = pq_dedup.near_duplicates(spark.createDataFrame(made, SCHEMA)).where("n_links > 0").collect()
    assert sorted((r["vec_id"], r["component_id"]) for r in found) == [(30_000, 30_000), (30_001, 30_000)]


@pytest.mark.parametrize("margin", [None, 1.0])
def test_recall_with_many_lists(spark, margin):
    """24,000 vectors in 48 lists or more, pairs close to the threshold on both sides."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12_000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    cosine = rng.uniform(0.86, 0.96, len(base))[:, None]
    x = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * away])
    df = spark.createDataFrame([(k, row) for k, row in enumerate(x.tolist())], SCHEMA).repartition(4)
    links = (cosine[:, 0] >= 0.9).sum()  # random vectors of 32 dimensions are hardly ever that near
    found = pq_dedup.near_duplicates(df, margin=margin).agg({"n_links": "sum"}).first()[0] / 2
    assert found <= links + 2
    assert found >= (links - 2 if margin == 1 else 0.99 * links)
