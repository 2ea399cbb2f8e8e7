"""Every operator against a plain version, on rows with nulls, empty and long texts, ties, copies and clashing columns."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wattfold.llm import bwt_dedup, chat_format, fingerprints, jaccard_join, language_id, piece_codec, pq_dedup, queries, token_counts, window_dedup
from wattfold.llm import texts as T

ODD = [
    None, "", " ", "\n", " \n\t ", "a", " a  b\n", "<|endoftext|> x<|endoftext|>", "it's  we'll\t \n x", "a\u00a0b\u3000 c", "\x1c. \x1d x", "日本語 😀 テスト", "▁ ▁▁x", "a" * 500, "=-" * 300,
    "<0x0A><s></s><unk>", "e\u0301é ñ", "\x00 a\x00", "    indented\n\tcode  ", "trailing ", "the  of", "\r\n x", "héé " * 90, " ".join(f"w{k % 7}" for k in range(200)), " ".join(f"w{k % 41}" for k in range(300)),
]


def texts():
    rng = random.Random(5)
    base = " ".join(f"z{k}" for k in range(3000))
    made = ODD + ["".join(rng.choice("ab") for _ in range(500)) for _ in range(3)] + [base, base[:3000] + " q " + base[2500:9000], base, "é" * 120 + base[100:400]]
    near = [f"h{k}" for k in range(120)]
    for _ in range(60):
        own = list(near)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(120)] = f"X{rng.randrange(50)}"
        made.append(" ".join(own))
    for n in (2, 3, 5, 9, 11, 20, 30, 60, 200):
        own = [rng.choice("abcdefgh") * 2 for _ in range(n)]
        made += [" ".join(own), " ".join(own[:-1] + ["q"]), " ".join(own).upper()]
    return [(3 * i - 7, t) for i, t in enumerate(made)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    queries.importable(spark)
    root = tmp_path_factory.mktemp("llm")
    rows = [(i, t, ("en", "fr", None)[k % 3], (None, "s1", "s2", "é")[k % 4], 0, 1.0, "x") for k, (i, t) in enumerate(texts())]
    # More columns, with names that operators use themselves.
    schema = "doc_id long, text string, lang string, source string, n_chars long, size double, spans string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{root}/documents.parquet")
    return str(root)


@pytest.fixture(scope="module")
def empty(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").limit(0)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pieces_equal_the_library(spark, folder):
    own = piece_codec.Codec(queries.tokenizer("piece_bpe_32k.model"))
    rng = random.Random(1)
    some = [x or "" for x in ODD] + ["".join(rng.choice("ab▁ \n\téß日<>the inging▁▁😀\x00.") for _ in range(rng.randrange(24))) for _ in range(3000)]
    for x in some:
        ids = own.library.encode(x)
        assert own.encode(x) == ids
        assert own.decode(ids) == own.library.decode(ids)
    want = [(i, len(ids := own.library.encode(t or "")), brute.sha(",".join(map(str, ids))), brute.sha(own.library.decode(ids))) for i, t in texts()]
    assert rows(queries.QUERIES["op1_sentencepiece"](spark, folder)) == sorted(want)


def test_fingerprints_estimate_likeness(spark, folder):
    ordered = sorted(texts())
    found = {r["doc_id"]: r for r in queries.QUERIES["op2_fingerprints"](spark, folder).collect()}
    assert len(found) == len(ordered)
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert (found[i]["n_chars"], found[i]["edited_sha256"]) == (len(t), brute.sha(edited))

        def five(x):
            own = brute.words(x)
            return {tuple(own[k : k + 5]) for k in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} - {()}

        a, b = five(t), five(edited)
        if len(a | b) > 2000:
            assert abs(found[i]["near_edited"] - len(a & b) / len(a | b)) < 0.1
        assert 0 <= found[i]["near_next"] <= 1
        if t == after:
            assert found[i]["near_next"] == 1
    x, y = (np.array(v, np.uint64) for v in ([1, 5], [2]))
    assert fingerprints.read(fingerprints.written(x)).tolist() == [1, 5] and fingerprints.merged(x, y).tolist() == [1, 2, 5]


def test_window_dedup_equals_brute_force(spark, folder):
    assert rows(queries.QUERIES["op3_window_dedup"](spark, folder)) == brute.window_dedup(texts())


def test_byte_dedup_equals_brute_force(spark, folder):
    assert rows(queries.QUERIES["op7_bwt_dedup"](spark, folder)) == brute.byte_dedup(texts())


def test_merged_transforms_order_suffixes():
    rng = random.Random(2)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(100, 200))).encode() for _ in range(9)] * 2
    whole = [bwt_dedup.Shard(b"".join(x), np.array([len(p) for p in x])) for x in (parts[:5], parts[5:11], parts[11:])]
    order, group = bwt_dedup.merge(whole, 3)
    place = np.concatenate([x.place + (x.place >= 0) * shift for x, shift in zip(whole, np.cumsum([0] + [sum(map(len, p)) for p in (parts[:5], parts[5:11])]))])[order]
    raw = b"".join(parts)
    known: dict = {}
    ends = np.repeat(np.cumsum([len(p) for p in parts]), [len(p) for p in parts])
    for at, g in zip(place, group):
        if at >= 0 and at + 24 <= ends[at]:
            assert known.setdefault(g, raw[at : at + 24]) == raw[at : at + 24]
    assert len(set(known.values())) == len(known)


def test_language_learns_and_is_held_out(spark, folder):
    rng, made = random.Random(3), []
    syllables = {"aa": ["tha", "ing", "wo"], "bb": ["eau", "que", "le"], "cc": ["ung", "sch", "der"]}
    for i in range(400):
        lang = "abc"[i % 3] * 2
        made.append((i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randrange(5, 60))), lang))
    made += [(1000, None, "aa"), (1001, "123 --", "bb"), (1002, "", None)]
    found = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(made, "doc_id long, text string, lang string")).collect()}
    assert all(found[i]["lang_pred"] == lang and 0 <= found[i]["score"] <= 1 for i, _, lang in made[:400])
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert 40 < sum(r["held_out"] for r in found.values()) < 130
    assert {r["lang_pred"] for r in queries.QUERIES["op4_language_id"](spark, folder).collect()} <= {"en", "fr", "und"}


def test_token_counts_equal_the_library(spark, folder):
    library = token_counts.Counter(queries.tokenizer("byte_bpe_50k.json")).library
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in texts()]
    assert rows(queries.QUERIES["op5_token_counts"](spark, folder)) == sorted(want)


def test_mixture_equals_brute_force(spark, folder):
    found = queries.QUERIES["op6_mixture"](spark, folder).select("doc_id", "size", "target", "taken")
    own = [(i, t, (None, "s1", "s2", "é")[k % 4]) for k, (i, t) in enumerate(texts())]
    for got, want in zip(rows(found), brute.mixture(own), strict=True):
        assert got[:2] == want[:2] and got[3] == want[3] and abs(got[2] - want[2]) < 1e-3


def test_chats_are_read_back(spark, tmp_path):
    hard = "\\</s> <|end|> \\\\[INST] <|image:0:3|> x\n"
    own = [(1, 0, "user", hard), (1, 1, "assistant", hard + "é"), (1, 1, "assistant", None), (2, None, None, "a"), (2, 0, "assistant", "b"), (None, 1, "x|>", "c")]
    spark.createDataFrame(own, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["conv_id"]: r for r in queries.QUERIES["op8_chat_format"](spark, str(tmp_path)).collect()}
    order = {1: [("user", hard), ("assistant", ""), ("assistant", hard + "é")], 2: [("", "a"), ("assistant", "b")], None: [("x|>", "c")], -7: [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]}
    for i, turns in order.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        assert (found[i]["n_turns"], found[i]["turns_sha256"]) == (len(turns), brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (found[i]["loss_chars"], found[i]["loss_sha256"]) == (len(learnt), brute.sha(learnt))


def test_typed_parts_become_placeholders(spark):
    parts = [("text", "see <|end|>", None, None), ("image", None, "a.png", 3), ("audio", None, "b", None), None, ("odd", "y", None, None)]
    one = chat_format.format_chats(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")).first()
    assert [(a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [("image", "a.png", 3), ("audio", "b", 128)]
    assert all(one["formatted"][a["at"] :].startswith(f"<|{a['kind']}:{k}:{a['tokens']}|>") for k, a in enumerate(one["attachments"]))
    assert chat_format.turns(one["formatted"]) == [("user", "see <|end|><|image:0:3|><|audio:1:128|>y"), ("assistant", "")]


def test_vectors_equal_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    x[300:600] = x[:300] + rng.normal(size=(300, 16)) * 0.25
    x[600:800] = x[0] * 3 + rng.normal(size=(200, 16)) * 0.15
    made = [(5 * i, [float(v) for v in row]) for i, row in enumerate(x)]
    made += [(-1, None), (-2, [0.0] * 16), (-3, [1.0] * 15 + [None]), (-4, [float("nan")] * 16), (-5, [float("inf")] + [1.0] * 15), (-6, []), (-7, [1.0] * 3)]
    spark.createDataFrame(made, "vec_id long, embedding array<double>").repartition(6).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {r["vec_id"]: r for r in queries.QUERIES["op9_pq_dedup"](spark, str(tmp_path)).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links, parts = unit @ unit.T >= 0.9, brute.Union()
    np.fill_diagonal(links, False)
    for a, b in zip(*np.nonzero(links)):
        parts.link(5 * int(a), 5 * int(b))
    recall = sum(found[5 * i]["n_links"] for i in range(900)) / links.sum()
    assert 0.9 <= recall <= 1 and all(found[5 * i]["n_links"] <= links[i].sum() for i in range(900))
    assert recall < 1 or all(found[5 * i]["component_id"] == parts.root(5 * i) and found[5 * i]["kept"] == (parts.root(5 * i) == 5 * i) for i in range(900))
    assert all((found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True) for i in range(-7, 0))


def test_jaccard_classes_equal_brute_force(spark, folder):
    assert rows(queries.QUERIES["op10_jaccard_join"](spark, folder)) == brute.jaccard(texts())


def test_jaccard_classes_over_many_chunks(spark, folder, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 3)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows(jaccard_join.classes(df.union(df.where("doc_id > 60")), 2, 80).distinct()) == brute.jaccard(texts(), 2, 80)


def test_part_digests_lose_no_linked_pair():
    rng = np.random.default_rng(6)
    levels = jaccard_join.Levels(90)
    for _ in range(300):
        n = int(rng.integers(5, 300))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        apart = int(rng.integers(0, max(1, n // 9)))
        b = np.unique(np.concatenate([a[apart // 2 :], rng.integers(0, 2**63, apart - apart // 2).astype(np.uint64)]))
        a = np.unique(a)
        if 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)) and (len(a) != len(b) or (a != b).any()):
            common = rng.random()
            stated = [{(k, d) for k, p in levels.schemes(len(x)) for d in jaccard_join.part_digests(x, (x % np.uint64(1 + int(50 * common))).astype(np.int64), k, p, levels.spare[k]).tolist()} for x in (a, b)]
            assert stated[0] & stated[1]


def test_empty_tables(spark, empty):
    for made in (
        piece_codec.encode(empty, queries.tokenizer("piece_bpe_32k.model")), token_counts.count_tokens(empty, queries.tokenizer("byte_bpe_50k.json")), fingerprints.fingerprint(empty), fingerprints.compare_with_next(empty),
        window_dedup.remove_repeats(empty), bwt_dedup.remove_repeats(empty), language_id.identify(empty), jaccard_join.classes(empty), pq_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert made.count() == 0


def test_repeated_rows_and_null_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(None, base), (4, base), (4, base), (9, base + " x")], "doc_id long, text string")
    assert sorted((r["doc_id"] == T.NO_ID, r["n_removed"]) for r in window_dedup.remove_repeats(df).collect()) == [(False, 60), (False, 60), (False, 60), (True, 0)]
    assert {r["component_id"] for r in jaccard_join.classes(df).collect()} == {T.NO_ID}
    assert [r["n_removed"] > 0 for r in bwt_dedup.remove_repeats(df).orderBy("doc_id").collect()] == [False, True, True, True]
    assert fingerprints.compare_with_next(df).count() == 4


def test_components_of_long_chains(spark):
    from wattfold.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (7, 7)], "a long, b long")
    assert rows(components(links)) == [(i, 0) for i in range(41)] + [(100, 100), (103, 100), (105, 100)]


def test_pipeline_keeps_what_it_should(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, folder)
    want = [i for i, t in texts() if t and any(c.isalpha() for c in t)]
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    alone = corpus_pipeline.join_near_copies(spark, kept, folder)
    known = dict(texts())
    leaders = [i for i, _, c in brute.jaccard([(i, known[i]) for i in want], 5, 80) if i == c]
    assert sorted(r["doc_id"] for r in alone.collect()) == leaders
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.remove_repeated_windows(spark, alone, folder).collect()}
    assert [(i, brute.sha(b" ".join(brute.words(cut[i])))) for i in leaders] == [(r[0], r[3]) for r in brute.window_dedup([(i, known[i]) for i in leaders])]
    last = corpus_pipeline.run(spark, folder)
    assert last.where(~F.col("round_trip") & ~F.col("doc_id").isin([i for i, t in texts() if t and ("▁" in t)])).count() == 0
    assert json.dumps(last.columns) == '["doc_id", "source", "ids", "n_tokens", "round_trip"]'


def test_pipeline_writes_the_language_it_finds(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    own = {"aa": "thaing wotha ingwo", "bb": "eauque lequele eaule"}
    made = [(i, f"{own[x]} {i}", x if i < 100 else None, "s", 9) for i in range(120) for x in [("aa", "bb")[i % 2]]] + [(200, "12 --", "aa", "s", 5), (201, None, "bb", "s", 0)]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(made, schema), "").collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(i, ("aa", "bb")[i % 2]) for i in range(120)]


def test_pipeline_keeps_documents_where_nothing_is_learnt(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    made = [(1, "clean text", None, "s", 10), (2, "été", None, None, 3), (3, "12 --", None, "s", 5), (4, None, None, "s", 0), (None, "x", "en", "s", 1)]
    kept = corpus_pipeline.identify_language(spark, spark.createDataFrame(made, schema), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["lang"]) for r in kept) == [(0, "x", "en"), (1, "clean text", None), (2, "été", None)]


def test_byte_dedup_of_a_long_periodic_text(spark, tmp_path):
    made = [(1, "a" * 200_000), (2, "b" * 150), (3, "ab" * 80_000)]
    spark.createDataFrame(made, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(queries.QUERIES["op7_bwt_dedup"](spark, str(tmp_path))) == brute.byte_dedup(made)


def test_shards_where_the_last_part_straddles_a_cut(monkeypatch):
    monkeypatch.setattr(bwt_dedup, "SHARD_BYTES", 1000)
    rng = random.Random(8)
    made = [rng.randbytes(150) for _ in range(13)]
    parts = [x + made[0] for x in made[:10]]  # 3000 bytes
    parts[-1] = parts[-1][:-1]  # the multiple 3000 lies inside the last part
    parts.append(made[11])
    found = bwt_dedup.repeats(parts, np.arange(11), np.zeros(11, np.int64))
    assert list(zip(*(x.tolist() for x in found))) == [(k, 150, len(parts[k])) for k in range(10)]


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(9)
    base, clean, more = (" ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(60)) for _ in range(3))
    for i in (None, 7):
        # Copies at the same place under one id, a clean text of that id, and equal rows, which are one document.
        df = spark.createDataFrame([(i, base + " x"), (i, base + " y"), (i, clean), (i, clean), (8, more), (8, more + " " + base)], "doc_id long, text string")
        ordered = [r["text"] for r in df.distinct().orderBy("doc_id", F.xxhash64("text")).collect()]
        want = {n: r for n, r in zip(ordered, brute.window_dedup(list(enumerate(ordered))), strict=True)}
        found = window_dedup.remove_repeats(df).collect()
        assert sorted((r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in found) == sorted([want[n][1:] for n in [*ordered, clean]])
        want = {n: r for n, r in zip(ordered, brute.byte_dedup(list(enumerate(ordered))), strict=True)}
        found = bwt_dedup.remove_repeats(df).collect()
        assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in found) == sorted([want[n][1:] for n in [*ordered, clean]])


def test_fragments_with_only_a_minimiser_in_common_reach_no_transform(monkeypatch):
    rng, sorted_bytes, own = random.Random(10), [], bwt_dedup.repeats

    def counted(parts, *places):
        sorted_bytes.append(sum(map(len, parts)))
        return own(parts, *places)

    def letters(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    monkeypatch.setattr(bwt_dedup, "repeats", counted)
    phrase, passage = letters(40), letters(120)
    made = [letters(150) + phrase + letters(150) for _ in range(600)] + [letters(n) + passage + letters(150) for n in (30, 200)]
    n = len(made)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(made), pa.array(range(n))], names=["doc_id", "text", "twin"])
    found = list(bwt_dedup._second_step(bwt_dedup._first_step(1)(iter([batch]))))
    spans = [(i, s >> 32, s & 0xFFFFFFFF) for x in found for i, s in zip(x.column(1).to_pylist(), x.column(3).to_pylist())]
    assert {i for i, _, _ in spans} == {n - 1}
    assert (min(a for _, a, _ in spans), max(b for _, _, b in spans)) == (200, 320)
    assert [x[2] for x in brute.byte_dedup(list(enumerate(made)))] == [0] * (n - 1) + [120]
    assert sum(sorted_bytes) < 1500


def test_no_fragment_with_a_window_in_common_is_ruled_out():
    rng, made = random.Random(11), []
    for _ in range(60):
        text = "".join(rng.choice(["th", "on", " ", "tion", "e", "an"]) for _ in range(300))
        if made:  # a passage of an earlier text
            other, at = rng.choice(made), rng.randrange(300)
            text = text[:at] + other[at // 2 : at // 2 + rng.randrange(100, 240)] + text[at:]
        made.append(text)
    made += ["=-" * 90, "x" + "=-" * 80, made[0][:150] + "abcd" * 60]
    texts = T.Utf8(pa.array(made))
    doc, first, last, least = bwt_dedup.fragments(texts)
    held = {texts.text(i)[a:b]: m for i, a, b, m in zip(doc.tolist(), first.tolist(), last.tolist(), least.tolist())}
    parts, marks = list(held), np.array(list(held.values()), np.int64)
    kept = set(np.flatnonzero(bwt_dedup.may_repeat(parts, marks & 0x7FFFFFFF, marks >> 44 == 0)).tolist())
    holders: dict = {}
    for k, part in enumerate(parts):
        for a in range(len(part) - 99):
            holders.setdefault(part[a : a + 100], []).append(k)
    sharing = {k for x in holders.values() if len(x) > 1 for k in x}
    assert len(sharing) > 100 and sharing <= kept
    assert len(kept) < len(parts) * 0.8
