"""What keeps tasks, passes and workers' memory few and small, without touching results."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wattfold.llm import jaccard_join, pq_dedup, queries, spans as S, texts as T, window_dedup
from wattfold.llm.components import components


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.importable(spark)


def test_sets_whose_hashes_agree_in_one_half_are_ordered_by_the_other(monkeypatch):
    made = [np.array(x) for x in ([1, 0, 0, 1, 0, 0], [7, 5, 5, 2, 5, 3])]
    more = np.array([1, 9, 4, 8, 4, 6], np.uint64)
    monkeypatch.setattr(T, "shingles", lambda *_: (made[0], made[1].astype(np.uint64), more))
    values, others = jaccard_join.shingle_sets([b"", b""], 3)
    assert [x.tolist() for x in values] == [[3, 5, 5], [2, 7]]
    assert [x.tolist() for x in others] == [[6, 4, 9], [8, 1]]


def test_one_pass_gives_sets_and_counters(spark):
    made = [(k, " ".join(f"w{(k * j) % 11}" for j in range(k))) for k in range(40)]
    docs = S.documents(spark.createDataFrame(made, "doc_id long, text string").repartition(3))
    found = jaccard_join.noted(docs, 3)
    sets, others = jaccard_join.shingle_sets(T.Utf8(pa.array([t for _, t in made], pa.large_string())), 3)
    digests = {k: hashlib.blake2b(x.tobytes() + y.tobytes(), digest_size=16).digest() if len(x) else None for k, (x, y) in enumerate(zip(sets, others))}
    noted = {r["doc_id"]: (r["n_shingles"], r["digest"] and bytes(r["digest"])) for r in found.where("segment is null").collect()}
    assert noted == {k: (len(x), digests[k]) for k, x in enumerate(sets)}
    want = Counter((x >> np.uint64(64 - jaccard_join.COUNTER_BITS)).item() for own in sets for x in own)
    counts = jaccard_join.shingle_counts(found)
    assert {k: int(counts[k]) for k in np.flatnonzero(counts).tolist()} == dict(want)


def test_a_round_of_components_takes_few_tasks(spark):
    links = T.checkpointed(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long").repartition(1))
    context, before = spark.sparkContext, {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    context.setJobGroup("few tasks", "")
    try:
        assert sorted(tuple(r) for r in components(links).collect()) == [(i, 0) for i in range(10)]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few tasks") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    assert tasks < 700


def test_a_worker_keeps_nothing_of_a_window_task():
    text = " ".join(f"w{k * k % 997}" for k in range(60_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text]), pa.array([5, 5])], names=["doc_id", "text", "twin"])
    got = list(window_dedup._leaving_nothing(window_dedup._first_step(4, 20))(iter([batch])))
    plain = list(window_dedup._first_step(4, 20)(iter([batch])))
    assert [x.to_pydict() for x in got] == [x.to_pydict() for x in plain]
    assert len(window_dedup._WORD.up) > 1
    for _ in window_dedup._leaving_nothing(iter)([batch]):
        pass
    assert [len(r.up) for r in (window_dedup._WORD, window_dedup._WINDOW, window_dedup._OTHER, window_dedup._SEED)] == [1] * 4


def test_codes_rule_out_nearly_all_and_lose_no_link():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(2000, 64))
    near = base[:300] + 0.3 * rng.normal(size=(300, 64))
    unit = pq_dedup._unit(np.concatenate([base, near]))
    index = pq_dedup.Index(64, unit, 4)
    own = (unit @ index.centroids.T).argmax(1)
    candidates = pairs = 0
    for at in range(4):
        members = unit[own == at]
        codes, left_out = index.coded(members, np.full(len(members), at))
        found = index.estimates(unit, at, codes)
        found = found if found.shape == (len(members), len(unit)) else found.T
        exact = members @ unit.T
        assert (np.abs(found - exact) <= left_out[:, None] + pq_dedup.ROUNDING).all()
        passed = found >= 0.9 - pq_dedup.ROUNDING - left_out[:, None]
        assert passed[exact >= 0.9].all() and (exact >= 0.9).sum() > len(members)
        candidates, pairs = candidates + passed.sum(), pairs + passed.size
    assert candidates < 0.01 * pairs  # 0.037 with subspaces of eight dimensions
