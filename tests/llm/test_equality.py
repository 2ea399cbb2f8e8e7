"""Texts whose running hashes collide, and texts that share an id: equal means equal contents."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wattfold.llm import fingerprints, jaccard_join, queries, spans as S, texts as T, window_dedup


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.importable(spark)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_mirror_each_other_stay_apart(spark, n):
    rest = [f"w{k}" for k in range(19)]
    made = [(k, " ".join([*rest[:9], word, *rest[9:]])) for k, word in enumerate((thue_morse(n), thue_morse(n, "ba"), thue_morse(n)))]
    made += [(10, thue_morse(n)), (11, thue_morse(n, "ba"))]
    df = spark.createDataFrame(made, "doc_id long, text string")
    found = window_dedup.remove_repeats(df)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in found.collect()) == brute.window_dedup(made)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(df).collect()) == brute.jaccard(made)
    sketch = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(df).collect()}
    assert sketch[10] != sketch[11] and sketch[0] == sketch[2] != sketch[1]


def test_windows_with_equal_hashes_are_compared_in_full():
    import numpy as np

    begin = np.array([0, 3, 6, 9, 12])
    copy = S.later_copies([np.zeros(5, np.uint64)], np.array([0, 0, 1, 1, 1]), np.array([0, 2, 0, 2, 3]), b"a b a c a b a c c d", begin, begin + 3)
    assert copy.tolist() == [False, False, False, False, False]
    begin = np.array([0, 4, 8, 12, 14])
    copy = S.later_copies([np.zeros(5, np.uint64)], np.array([0, 0, 1, 1, 1]), np.array([0, 2, 0, 2, 3]), b"a b a c a b a c c d", begin, begin + 3)
    assert copy.tolist() == [False, False, True, True, False]


@pytest.mark.parametrize("shared", [None, 7])
def test_jaccard_keeps_texts_of_one_id_apart(spark, shared):
    rng = random.Random(3)
    a, b = ([rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(1000)) for _ in range(100)] for _ in range(2))
    a, b = " ".join(a), " ".join(b)
    df = spark.createDataFrame([(shared, a), (shared, b), (15, a + " q"), (19, b + " q"), (19, b + " q"), (20, "alone")], "doc_id long, text string")
    found = jaccard_join.documents_of_classes(df).select("doc_id", "twin", "component_id", "leader").distinct().collect()
    own = T.NO_ID if shared is None else shared
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(own, own), (own, own), (15, own), (19, own), (20, 20)]
    # Two components, each with one leader, although both begin with the same id.
    assert sorted(r["doc_id"] for r in found if r["leader"]) == [own, own, 20]

    import corpus_pipeline

    docs = df.select("doc_id", "text", F.lit("x").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    kept = corpus_pipeline.join_near_copies(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(shared or 0, a), (shared or 0, b), (20, "alone")])
    many = spark.createDataFrame([(shared, f"{a} {k}") for k in range(30)] + [(shared, f"{b} {k}") for k in range(30)], "doc_id long, text string")
    assert many.join(jaccard_join.documents_of_classes(many).where("leader"), F.xxhash64("text") == F.col("twin")).count() == 2
