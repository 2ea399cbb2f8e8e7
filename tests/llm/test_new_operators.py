"""The prefix trie, vantage-point search and hard negatives against plain versions."""

import random
import zlib

import numpy as np
import pytest

from tests.llm import brute
from wattfold.llm import prefix_trie, queries, texts as T


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.importable(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_trie(rows):
    """Nodes of (conv_id, turn, role, text) rows, from dictionaries of whole prefixes."""
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(convs.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + own[h:])
    members, ends = {}, {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        own = below.setdefault(p, [0, 0, 0])  # children, leaves, saved
        own[1] += own[0] == 0
        own[2] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        if p:
            up = below.setdefault(p[:-1], [0, 0, 0])
            up[0] += 1
            up[1] += own[1]
            up[2] += own[2]
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), *below[p], brute.sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in members.items()), key=repr,
    )


def conversations(n, seed=1):
    rng = random.Random(seed)
    made = []
    for c in [*range(0, n), *range(300, 300 + n), 700, 701, -5, -103, 1002, 1003]:
        for t in range(rng.choice([1, 2, 3, 3, 9])):
            made.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None]), rng.choice(["a", "bé", "", None, "a"]) if t < 6 else f"long {rng.randrange(2)}"))
    made = [r for k, r in enumerate(made) if (r[0], r[1], r[2] or "") not in {(x[0], x[1], x[2] or "") for x in made[:k]}]
    return made + [(c, t, "user", "same") for c in range(2000, 2040) for t in range(8)]


@pytest.mark.parametrize("piece, shard", [(32, 20_000), (32, 3), (2, 5), (3, 1), (1, 7)])
def test_trie_equals_plain_prefixes(spark, tmp_path, piece, shard):
    own = conversations(40)
    df = spark.createDataFrame([(*r, "x", 1) for r in own + [(None, 0, "user", "left out")]], "conv_id long, turn long, role string, text string, path string, depth int").repartition(4)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = prefix_trie.trie(df, piece, shard) if shard < 1000 else queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows(found) == plain_trie(own)


def test_trie_of_one_very_long_conversation_and_its_copy(spark):
    own = [(c, t, "user", f"t{t}") for c in (100, 200) for t in range(150)] + [(200, 150, "user", "end"), (300, 0, None, None), (399, 0, "user", "x")]
    assert rows(prefix_trie.trie(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))) == plain_trie(own)


def test_trie_of_nothing_and_of_repeated_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    own = [(100, 1, "user", "a")] * 3
    assert rows(prefix_trie.trie(spark.createDataFrame(own, schema))) == plain_trie(own)


def test_findclose():
    rng = np.random.default_rng(0)
    for n in (1, 2, 70, 3000):
        bits, depth = [], 0
        while len(bits) < 2 * n:
            left = 2 * n - len(bits)
            bits.append(1 if depth == 0 or (depth < left and rng.random() < 0.55) else -1)
            depth += bits[-1]
        want, stack = {}, []
        for i, b in enumerate(bits):
            if b == 1:
                stack.append(i)
            else:
                want[stack.pop()] = i
        at = np.flatnonzero(np.array(bits) == 1)
        assert prefix_trie.Parentheses(np.array(bits)).findclose(at).tolist() == [want[i] for i in at.tolist()]


VECTORS = "vec_id long, embedding array<double>, label int, tau string, cell int"


def vectors(n=1500, size=12, seed=7):
    """Clusters with copies, ties, other lengths, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size))
    x = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, size)) * rng.choice([0.1, 0.5, 2.0], (n, 1))
    x[n // 2 : n // 2 + 60] = x[3]
    made = [(10 * i, [float(v) for v in row], int(rng.integers(0, 4))) for i, row in enumerate(x)]
    made += [(50, made[5][1], 2), (10_000_050, [0.0] * size, 1), (10_000_100, None, 1), (10_000_150, [1.0] * (size - 1) + [None], 1), (10_000_200, [float("nan")] * size, 1), (10_000_250, [], 0)]
    made += [(20_000_000 + 50 * k, [float(k + 1), 1.0, 2.0], k % 2) for k in range(8)] + [(None, made[0][1], 1), (-50, [1e200 * v for v in made[7][1]], 3), (77_777_700, [5.0] * 5, 1)]
    return made + made[100:103]


def plain_nearest(made, every=50, k=5):
    good = {}
    for i, x, *_ in made:
        if x and all(v is not None and np.isfinite(v) for v in x) and any(x):
            good[(T.NO_ID if i is None else i, tuple(x))] = np.array(x) / max(map(abs, x))
    out = []
    for (i, x), a in good.items():
        if i % every == 0 and i != T.NO_ID:
            near = sorted((-float(a @ b / np.sqrt((a @ a) * (b @ b))), j) for (j, y), b in good.items() if j != i and len(y) == len(x))
            out += [(i, r, -s) for r, (s, _) in enumerate(near[:k], 1)]
    return out


@pytest.mark.parametrize("factor, cell", [(1.0, 4096), (1.0, 60), (1.4, 60)])
def test_vantage_search_against_all_pairs(spark, monkeypatch, factor, cell):
    from wattfold.llm import vantage_search

    monkeypatch.setattr(vantage_search, "CELL", cell)
    made = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in made], VECTORS).repartition(5)
    found = vantage_search.nearest(df, factor=factor).collect()
    want = plain_nearest(made)
    got = sorted((r["query_id"], r["rank"], r["score"]) for r in found)
    if factor == 1:
        assert len(got) == len(want)
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 for a, b in zip(got, sorted(want)))
    kth = {q: s for q, r, s in want if r == 5}
    assert sum(s >= kth[q] - 1e-12 for q, _, s in got if q in kth) >= 0.9 * sum(q in kth for q, _, _ in want)
    for r in found:
        assert r["vec_id"] != r["query_id"]
    ranked = [(r["query_id"], -r["score"], r["vec_id"] if r["vec_id"] is not None else T.NO_ID, r["rank"]) for r in found]
    assert ranked == sorted(ranked) or sorted(ranked) == sorted(ranked, key=lambda r: (r[0], r[3]))


def test_vantage_search_of_nothing(spark):
    from wattfold.llm import vantage_search

    assert vantage_search.nearest(spark.createDataFrame([], VECTORS)).count() == 0
    assert vantage_search.nearest(spark.createDataFrame([(50, [0.0], 1, "", 1), (100, None, 1, "", 1)], VECTORS)).count() == 0
    assert [tuple(r) for r in vantage_search.nearest(spark.createDataFrame([(50, [1.0, 0.0], 1, "", 1), (1, [2.0, 0.0], 1, "", 1)], VECTORS)).collect()] == [(50, 1, 1, 1.0)]


def plain_negatives(made):
    good = {}
    for i, x, label, *_ in made:
        if label is not None and x and all(v is not None and np.isfinite(v) for v in x):
            own = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            good[(T.NO_ID if i is None else i, tuple(int(np.floor(256 * v)) for v in x), own)] = None
    out = []
    limit = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    for i, x, label in good:
        if i % 100 or i == T.NO_ID:
            continue
        scored = sorted((-limit(sum(a * b for a, b in zip(x, y))), j, other) for j, y, other in good if j != i and len(y) == len(x))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            far = [(s, k) for s, k, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(far, 1)]
    return sorted((tuple(None if v == T.NO_ID else v for v in r) for r in out), key=repr)


@pytest.mark.parametrize("shard", [8192, 100])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, shard):
    from wattfold.llm import hard_negatives

    monkeypatch.setattr(hard_negatives, "SHARD", shard)
    made = [(i, x, label) for i, x, label in vectors(900, 8)] + [(300_000, [0.25] * 8, None), (100, [0.5] * 8, 9), (31, [1e200] * 4, 2), (400_000, [1e6] * 4, 2), (33, [2e6, 1.0, 1.0, 1.0], 2), (34, [5e5, 1.0, 1e6, 1.0], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in made], VECTORS).repartition(5)
    found = rows(hard_negatives.mine(df))
    assert len(found) > 200 and found == plain_negatives(made)


def test_hard_negatives_of_nothing(spark):
    from wattfold.llm import hard_negatives

    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1, "", 1), (5, [1.0], 1, "", 1), (6, [0.5], 2, "", 1), (6, [0.5], 2, "", 1)], VECTORS)
    assert [tuple(r) for r in hard_negatives.mine(one).collect()] == [(100, 5, 1, 6, 65536, 32768)]


def test_lists_are_read_no_deeper_than_needed():
    from wattfold.llm import hard_negatives

    rng = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([rng.normal(size=(2000, 2)) * 0.01, rng.normal(size=(20, 2)) + 9]))
    lists = hard_negatives.Lists(np.arange(2020), np.zeros(2020, int), x)
    (got, scores), = lists.windows(-1, np.array([3.0, 1.0]), np.ones(2020, bool), [-np.inf], [np.inf], 5)
    want = np.lexsort((np.arange(2020), -(x @ [3.0, 1.0])))[:5]
    assert got.tolist() == want.tolist() and scores == (x @ [3.0, 1.0])[want].astype(int).tolist()
