"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from planefold.llm import bottomk, encode, html_text, jaccard, language, mixing, substring, token_counts, token_files, toxicity, words as spans, wu_manber
from planefold.llm.components import components
from planefold.llm.html_blocks import blocks

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket int, hashes string, size int, told boolean"


def table(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, lang, source, 1, 7, "x", 3, True) for d, t, lang, source in rows], DOCS)


def words(n, seed):
    letters = random.Random(seed)
    return " ".join("".join(letters.choices("abcdefgh", k=6)) for _ in range(n))


LONG = words(30_000, 1)
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (4, "one two", "de", "a"),
    (5, LONG, "en", "b"),
    (6, LONG + " more", "en", "b"),
    (7, words(40, 2), None, "a"),
    (7, words(40, 3), "fr", "a"),
    (8, words(40, 2), "fr", ""),
    (8, words(40, 2), "fr", ""),
    (None, words(40, 2), "de", "a"),
    (None, None, None, "b"),
    (9, "one two", "de", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def found(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def brute_removed(rows):
    first: dict = {}
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, ws in split:
        for i in range(len(ws) - 12):
            key = tuple(ws[i : i + 13])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, ws in split:
        gone = {i + k for i in range(len(ws) - 12) if d is not None and first[tuple(ws[i : i + 13])] < d for k in range(13)}
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=repr)


def test_substring_odd_rows(spark, odd, empty):
    columns = ("doc_id", "n_words", "n_removed", "kept")
    assert found(substring.remove_repeated(odd), *columns) == brute_removed([(d, t) for d, t, _, _ in ODD])
    assert substring.remove_repeated(empty).count() == 0


def test_substring_random_passages(spark):
    pick = random.Random(4)
    passages = [words(n, 100 + n) for n in (12, 13, 14, 20, 60)]
    rows = []
    for d in range(60):
        parts = [words(pick.randint(0, 30), 1000 + d)]
        for _ in range(pick.randint(0, 3)):
            parts += [pick.choice(passages), words(pick.randint(0, 9), pick.random())]
        rows.append((d, " ".join(parts)))
    got = found(substring.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "n_removed", "kept")
    assert got == brute_removed(rows)


@pytest.mark.parametrize("n", [0, 1, spans.STEP - 1, spans.STEP, spans.STEP + 1, 2 * spans.STEP, 3 * spans.STEP + 5])
def test_span_hashes(n):
    """Against the polynomial, term by term in Python's integers; shifted copies hash alike."""
    letters, whole = random.Random(n), 1 << 64
    values = np.array([letters.randrange(whole) for _ in range(n)], dtype=np.uint64)
    bounds = sorted(letters.choices(range(n + 1), k=40)) + [0, n]
    start = np.array([min(a, b) for a, b in zip(bounds, bounds[1:])])
    stop = np.array([min(max(a, b), min(a, b) + 30) for a, b in zip(bounds, bounds[1:])])
    for which, base in enumerate(spans._BASES):
        want = [(sum(int(values[i]) * pow(base, i - a, whole) for i in range(a, b)) + b - a) % whole for a, b in zip(start.tolist(), stop.tolist())]
        got = spans.span_hashes(values, start, stop, which)
        assert got.tolist() == spans.mix(np.array(want, dtype=np.uint64)).tolist()
        again = spans.span_hashes(np.r_[values[:7], values], start + min(n, 7), stop + min(n, 7), which)
        assert np.array_equal(got, again)


def test_difference_cover():
    for a, b in itertools.product(range(substring.PERIOD), repeat=2):
        assert any((a + s) % 7 in substring.COVER and (b + s) % 7 in substring.COVER for s in range(7))


def brute_groups(rows):
    def shingles(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
        return frozenset(tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, min(len(ws), 1))))

    sets = [(d, shingles(t)) for d, t in rows]
    tree = jaccard.Sets()
    known = [(d, s) for d, s in sets if d is not None]
    for (a, s), (b, r) in itertools.combinations(known, 2):
        if s and r and 100 * len(s & r) >= 75 * len(s | r):
            tree.join(a, b)
    return sorted(((d, len(s), None if d is None else tree.top(d)) for d, s in sets), key=repr)


def test_jaccard_odd_rows(odd, empty):
    columns = ("doc_id", "n_shingles", "component_id")
    assert found(jaccard.similar_groups(odd), *columns) == brute_groups([(d, t) for d, t, _, _ in ODD])
    assert jaccard.similar_groups(empty).count() == 0


def near_copies():
    pick = random.Random(9)
    rows = []
    for group in range(4):
        base = words(60, group).split()
        for copy in range(14):
            ws = list(base)
            for _ in range(pick.randint(0, 4)):
                ws[pick.randrange(len(ws))] = words(1, pick.random())
            rows.append((len(rows) * 3 % 101, " ".join(ws)))
    return rows


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_jaccard_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies()
    got = found(jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == brute_groups(rows)


def test_divide_skip():
    pick = random.Random(5)
    sets = [np.array(sorted(pick.sample(range(40), pick.randint(8, 30))), dtype=np.uint64) for _ in range(60)]
    lists, of = jaccard._inverted(sets)
    sizes = [len(s) for s in sets]
    for q, own in enumerate(sets):
        want = [r for r, s in enumerate(sets) if 100 * len(set(own) & set(s)) >= 75 * len(set(own) | set(s))]
        assert jaccard.divide_skip([lists[i] for i in of[q]], sizes[q], sizes) == want


def chains(seed):
    """Sets of chains in which only neighbours link, with permuted ids."""
    random_ = random.Random(seed)
    sets = []
    for chain in range(random_.randint(1, 3)):
        base = 10_000 * chain
        sets += [set(range(base + 4 * i, base + 4 * i + 40)) for i in range(random_.randint(2, 14))]
    ids = random_.sample(range(100), len(sets))
    return sorted(zip(ids, sets))


def test_link_chains():
    for seed in range(300):
        rows = chains(seed)
        ids, sets = [i for i, _ in rows], [s for _, s in rows]
        want = jaccard.Sets()
        for (x, a), (y, b) in itertools.combinations(rows, 2):
            if 100 * len(a & b) >= 75 * len(a | b):
                want.join(x, y)
        tree = jaccard.link(ids, ids, [np.array(sorted(s), dtype=np.uint64) for s in sets])
        assert [tree.top(i) for i in ids] == [want.top(i) for i in ids], seed


def test_hot_prefixes_send_one_document():
    hot = np.arange(40, dtype=np.uint64)
    ids = [-5, *range(1, 300)]
    rows = [{"doc_id": i, "n": 40, "n_own": 0, "label": i, "shingles": hot.tobytes()} for i in ids]
    sent = list(jaccard._prefix_rows(4)(pa.RecordBatch.from_pylist(rows[k::3]) for k in range(3)))
    told = sum(sum(np.frombuffer(c, np.uint32)) for batch in sent for c, t in zip(batch.column("counts").to_pylist(), batch.column("told").to_pylist()) if t)
    every = sum(sum(np.frombuffer(c, np.uint32)) for batch in sent for c in batch.column("counts").to_pylist())
    assert told == 297 and every - told == 3 * 2 * 11
    tree = jaccard.Sets()
    for edges in jaccard._meetings(iter(sent)):
        for edge in edges.to_pylist():
            tree.join(edge["u"], edge["v"])
    assert {tree.top(i) for i in ids} == {-5}


def test_one_of_each(odd, empty):
    kept = found(jaccard.one_of_each(odd), "doc_id", "bucket")
    assert kept == sorted([(d, 7) for d in (1, 2, 3, 4, 5, None, None)] + [(7, 7)], key=repr)
    assert jaccard.one_of_each(empty).columns == empty.columns


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 100)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 100}


BENCH = "item_id long, text string, bucket int"


def test_decontamination_odd_rows(spark, odd, empty):
    twelve = words(12, 77)
    items = [(1, twelve), (2, "One, TWO!"), (3, None), (4, ""), (None, words(40, 3)), (1, twelve), (5, "é " + words(3, 78))]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], BENCH)
    docs = table(odd.sparkSession, [*ODD, (20, "x " + twelve.upper() + " y", None, None), (21, "É é " + words(3, 78), None, None)])
    want = {4: (2, 2, ["2"]), 9: (2, 2, ["2"]), 20: (14, 12, ["1"]), 21: (5, 4, ["5"])}
    for block in (wu_manber.BLOCK_WORDS, 5):
        got = wu_manber.contamination(wu_manber.benchmark_hits(docs, bench, block)).collect()
        assert len(got) == len(ODD) + 2
        for row in got:
            if row["doc_id"] in want:
                assert (row["n_words"], row["n_hit"], row["items"]) == want[row["doc_id"]]
            elif row["doc_id"] == 7:
                assert row["n_hit"] in (0, 40) and row["n_items"] == 0
            else:
                assert row["n_hit"] == 0
        kept = wu_manber.drop_contaminated(docs, bench, block)
        assert kept.columns == docs.columns
        assert kept.count() == len(ODD) + 2 - 5
    assert wu_manber.benchmark_hits(empty, bench).count() == 0
    assert wu_manber.contamination(wu_manber.benchmark_hits(docs, bench.limit(0))).agg(F.sum("n_hit")).first()[0] == 0


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix_sources(odd)
    assert got.count() == len(ODD)
    total = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert {r["source"] for r in total} == {None, "", "a", "b"}
    assert sum(r["target"] for r in total) == pytest.approx(1.5 * sum(r["size"] for r in total))
    assert all(r["target"] <= 2 * r["size"] for r in total)
    assert mixing.mix_sources(empty).count() == 0
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns
    assert rows.count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mixed(empty).count() == 0


def test_fit_reaches_budgets():
    pick = random.Random(6)
    for _ in range(200):
        lengths = sorted(pick.sample(range(1, 60), pick.randint(1, 8)))
        counts = [pick.randint(1, 5) for _ in lengths]
        budget = pick.randint(0, sum(n * c for n, c in zip(lengths, counts)))
        taken = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert abs(sum(n * t for n, t in zip(lengths, taken)) - budget) <= max(lengths)
    assert mixing._knapsack([3, 5], [2, 2], 8) != [] and mixing.fit([3, 5], [2, 2], 8) == [1, 1]


def test_mixing_ranks_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 10)
    rows = [(i, "a b c", "hot") for i in range(300)] + [(1000 + i, words(i, i), "cold") for i in range(20)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("hot", "cold"):
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3


def test_token_files_odd_rows(spark, odd, empty):
    path = token_files.fresh_folder(spark)
    token_files.write_tokens(odd, TOKENIZER, path, shard_tokens=500)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    whole = encode.Encoder(TOKENIZER).whole
    order = sorted(((d, t) for d, t, _, _ in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in got] == [d for d, _ in order]
    assert [bytes(r["ids"]) for r in got] == [whole(t or "") + b"\2\0\0\0" for _, t in order]
    path = token_files.fresh_folder(spark)
    token_files.write_tokens(empty, TOKENIZER, path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_repair_round_trip():
    pick = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 1), (3000, 4), (20_000, 300), (50_000, 70_000)):
        ids = (pick.zipf(1.3, n) % top).astype("<u4")
        docs = [(i, part.tobytes()) for i, part in enumerate(np.array_split(ids, 7))]
        row = token_files._shard(docs, 0, 0, 2)
        want = np.concatenate([np.r_[np.frombuffer(x, "<u4"), 2] for _, x in docs])
        assert np.array_equal(token_files.decode(row), want)
        for start, stop in ((0, len(want)), (len(want) // 3, len(want) // 2), (len(want) - 1, len(want))):
            assert np.array_equal(token_files.decode_range(row, start, stop), want[start:stop])
        if n == 20_000:
            assert len(row["symbols"]) < 2 * len(want) * 0.9


def test_repair_goes_on_to_the_end():
    pick = np.random.default_rng(2)
    run = np.full(100_001, 5, dtype="<u4")
    pairs = pick.permutation(65_000)[:6000].astype("<u4").reshape(-1, 2)
    wide = np.r_[np.arange(65_000, dtype="<u4"), pick.permutation(np.repeat(pairs, 9, axis=0)).ravel()]
    for ids in (run, wide, (pick.zipf(1.2, 40_000) % 50).astype("<u4")):
        row = token_files._shard([(1, ids.tobytes())], 0, 0, 2)
        assert np.array_equal(token_files.decode(row), np.r_[ids, 2])
        symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").tolist()[:-1]
        seen = Counter(itertools.pairwise(symbols))
        for symbol, same in itertools.groupby(symbols):
            seen[symbol, symbol] -= (len(list(same)) - 1) // 2
        assert max(seen.values(), default=0) <= 12 // row["width"]
        assert row["width"] == (4 if ids is wide else 2)


def test_chunks_equal_whole_texts():
    own = encode.Encoder(TOKENIZER)
    pick = random.Random(3)
    parts = [" ", "  ", "\n", "a", "é", "1", ".", "'s", "'", " ", "\t", "<|endoftext|>", "\x1f", "漢", " ab", ",", "Éx", "...", "]}", "　"]
    for text in ["", LONG, *("".join(pick.choices(parts, k=pick.randint(1, 14))) for _ in range(3000))]:
        assert own.ids(text) == own.whole(text)


def test_token_counts_cache(spark, odd, empty):
    cache = token_counts.fresh_cache(spark)
    want = sorted([(d, len((t or "").encode()), len(encode.encoder(TOKENIZER).ids(t or "")) // 4) for d, t, _, _ in ODD], key=repr)
    columns = ("doc_id", "n_bytes", "n_tokens")
    assert found(token_counts.token_counts(odd, TOKENIZER, cache), *columns) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t, _, _ in ODD})
    assert found(token_counts.token_counts(odd, TOKENIZER, cache), *columns) == want
    assert spark.read.parquet(cache).count() == stored.count()
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    other = token_counts.token_counts(odd, pieces, cache).filter("doc_id = 4").first()
    from sentencepiece import SentencePieceProcessor

    assert other["n_tokens"] == len(SentencePieceProcessor(model_file=pieces).encode("one two"))
    assert token_counts.token_counts(empty, TOKENIZER, token_counts.fresh_cache(spark)).count() == 0


def test_fingerprints_odd_rows(odd, empty):
    got = bottomk.edited_pairs(odd).collect()
    order = sorted(((d, t or "") for d, t, _, _ in ODD), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (d, t) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(t) // 2
        want.append((d, len(t), t[: len(t) - half] + after[:half]))
    assert sorted([(r["doc_id"], r["n_chars"], r["edited"]) for r in got], key=repr) == sorted(want, key=repr)
    assert all(len(r["sketch"]) <= bottomk.K and r["next_sketch"] is not None for r in got)
    assert bottomk.edited_pairs(empty).count() == 0
    one = odd.filter("doc_id = 4")
    assert bottomk.edited_pairs(one).first()["edited"] == "one one"


def test_sketch_estimates_and_merges(spark):
    rows = [(1, words(3000, 1)), (1, words(2000, 2)), (2, words(10, 3)), (2, None)]
    df = spark.createDataFrame(rows, "g int, text string").withColumn("sketch", bottomk.sketch(F.col("text")))
    parts = {}
    for g, text in rows:
        ws = (text or "").split()
        parts.setdefault(g, set()).update(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    merged = bottomk.merge_sketches(df, ["g"], "sketch").withColumn("n", bottomk.distinct_shingles(F.col("sketch"))).collect()
    for row in merged:
        assert row["n"] == pytest.approx(len(parts[row["g"]]), rel=0.25)
        assert row["n"] == len(parts[row["g"]]) or row["g"] == 1
    both = words(800, 5)
    pair = spark.createDataFrame([(both, both + " " + words(800, 6))], "a string, b string").select(bottomk.sketch(F.col("a")).alias("a"), bottomk.sketch(F.col("b")).alias("b"))
    row = pair.select(bottomk.resemblance(F.col("a"), F.col("b")).alias("r"), bottomk.containment(F.col("a"), F.col("b")).alias("c")).first()
    assert row["r"] == pytest.approx(0.5, abs=0.15) and row["c"] == pytest.approx(1.0, abs=0.2)


def test_fingerprints_run_no_python(odd):
    plan = bottomk.edited_pairs(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_language_odd_rows(spark, odd, empty):
    model = language.train_model(odd)
    got = language.identify(odd, model).collect()
    assert len(got) == len(ODD)
    for row in got:
        assert (row["lang_pred"] == "und") == (row["doc_id"] in (1, 2, 3) or row["doc_id"] is None and row["entropy"] == 0)
        assert 0 <= row["score"] <= 1 and row["rejected"] == (row["lang_pred"] == "und")
    assert language.keep_known(odd, model).columns == odd.columns
    assert language.keep_known(odd, model).count() == len(ODD) - 4
    none = language.train_model(empty)
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_language_learns_from_single_texts(spark):
    rows = [(f"l{i:02}", words(40, i)) for i in range(20)]
    model = language.train_model(spark.createDataFrame(rows, "lang string, text string"))
    assert model.names == [name for name, _ in rows]
    got = model.predict([text for _, text in rows])
    assert list(got["lang_pred"]) == model.names and not got["rejected"].any()


def test_language_probabilities_add_up():
    """Over all next characters the probabilities of a model sum to one."""
    texts = ["abba baab abab", "bab abba ab", "aaab"]
    model = language.Model({"x": language.learn(texts)})
    for context in ("ab", "bb", " a", "zz"):
        total = 0.0
        for letter in "ab ":
            codes = np.array([32] * 4 + [ord(c) for c in context + letter], dtype=np.uint64)
            total += float(np.exp(model._log(codes, np.array([len(codes) - 1]), language.ORDER)[0, 0]))
        rest = float(np.exp(model._log(np.array([32] * 4 + [ord(c) for c in context + "q"], dtype=np.uint64), np.array([6]), language.ORDER)[0, 0]))
        assert total + rest * (language.ALPHABET - 3) == pytest.approx(1, abs=1e-3)


def test_language_rejects_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train_model(docs)
    noise = random.Random(8)
    texts = ["".join(noise.choices("qxzjkvwbпркщ漢字", k=400)), "The and of the thing in that."]
    assert model.predict(texts)["rejected"].tolist() == [True, False]


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (2, 4, 5, 7, 8, 9)] + [(1, 1, 0), (3, None, 0), (6, 5, 0), (None, 1, 0), (4, 0, 0)], "doc_id long, toxic int, bucket int")
    network = toxicity.train(odd, labels)
    got = toxicity.score_toxicity(odd, network).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({round(r["score"], 6) for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    one = toxicity.train(odd, labels.filter("toxic = 1"))
    assert {r["score"] for r in toxicity.score_toxicity(odd, one).collect()} == {1.0}
    assert toxicity.score_toxicity(empty, one).count() == 0


def test_toxicity_reads_all_windows():
    given = toxicity.inputs(pa.array([words(200, 1), None, words(64, 2), words(65, 3)]), toxicity.Index(np.zeros(0, np.uint64)))
    assert np.bincount(given.text).tolist() == [6, 1, 1, 2]
    assert len(set(given.windows[given.text == 0].ravel().tolist()) - {-1}) == 200


def test_toxicity_gradients():
    texts = [words(70, i) for i in range(4)]
    network = toxicity._start(toxicity._vocabulary(texts * 3))
    given, toxic = toxicity.inputs(pa.array(texts), network.vocabulary), np.array([True, False, True, False])
    grads = {}
    network._adam = grads.update

    def loss():
        p = 1 / (1 + np.exp(-network.forward(network.vectors(given), given.windows)[0].astype(float)))
        none = np.exp(np.add.reduceat(np.log1p(-p), np.flatnonzero(np.r_[True, given.text[1:] != given.text[:-1]])))
        return -np.mean(np.where(toxic, np.log(1 - none), np.log(none)))

    network.step(given, toxic)
    for name in ("uf", "ub", "wf", "bb", "attend", "out", "trigram", "word"):
        weight = network.weights[name]
        at = np.unravel_index(np.abs(grads[name]).argmax(), weight.shape)
        kept = weight[at]
        weight[at] = kept + 0.01
        up = loss()
        weight[at] = kept - 0.01
        down = loss()
        weight[at] = kept
        assert grads[name][at] == pytest.approx((up - down) / 0.02, rel=0.05, abs=1e-5)


def test_blocks():
    page = "<title>T</title><!-- <p>no --><script>x<p>y</script><p>a &amp; <b>b</b>\n c<br>d<p class='x ad'>e<ul><li><a href=#>f</a> g<li>h</ul>&copy; i < 3"
    assert [b.text for b in blocks(page)] == ["T", "a & b c d", "e", "f g", "h", "© i < 3"]
    assert [".ad" in b.path for b in blocks(page)] == [False, False, True, False, False, False]
    assert blocks("") == [] and blocks("<p></p> \n") == []


PAGES = "page_id long, url string, html string, text string, bucket int"


def test_blocks_after_raw_names():
    for start in ("<svg/>", '<svg width="1" />', "<svg a='x>y'/>", "<svg-icon name=x>", "<svg-icon>i</svg-icon>", "<template-part/>", "<SVG\n/>"):
        assert [b.text for b in blocks(f"<p>one</p>{start}<p>two</p><p>three</p>")][-2:] == ["two", "three"], start
    for start in ("<svg>x<g/>y</svg>", "<svg a='/'>x</svg >", "<script/>x</script>", "<style\n>x</style>", "<script a=b>if (1/2>x)</script>"):
        assert [b.text for b in blocks(f"<p>one</p>{start}<p>two</p>")] == ["one", "two"], start
    assert [b.text for b in blocks("<p>one</p><svg><p>two</p>")] == ["one"]


def test_html_odd_rows(spark):
    menu = "<nav><ul><li><a href='#'>Home</a></li><li><a href='#'>News</a></li></ul></nav>"
    article = "<article><h1>Title of it</h1><p>First paragraph &amp; more text of it.</p><p>Second one, a bit longer than that.</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<script>only()</script>"), (4, "u", f"<html><body>{menu}{article}<footer>&copy; all</footer>"), (4, "u", f"{menu}{article}")]
    rows += [(10 + i, "u", f"<body>{menu}<article><h1>{words(4, i)}</h1><p>{words(30, i + 50)}</p></article><footer>{words(5, i)}</footer></body>") for i in range(20)]
    rows += [(99, "u", f"<body>{menu}<article><p>{LONG}</p></article></body>")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)
    model = html_text.train(pages)
    got = {(r["page_id"], r["text"]) for r in html_text.extract(pages, model).collect()}
    text = "Title of it\nFirst paragraph & more text of it.\nSecond one, a bit longer than that."
    assert {(1, ""), (2, ""), (3, ""), (4, text), (99, LONG)} <= got
    assert html_text.extract(pages.limit(0), model).count() == 0
    assert html_text.extract(pages.filter("page_id = 4"), html_text.fit([])).count() == 2


def test_html_layouts_unseen(spark):
    import duckdb

    sample = [r[0] for r in duckdb.connect().execute("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()]
    model = html_text.fit(sample[:40])
    pick, wrong, total = np.random.default_rng(7), 0, 0
    for page in sample[40:]:
        own = blocks(page)
        weak = html_text._weak_labels(own)
        texts = [b.text.replace("<", " ").replace("&", "+") for b in own]
        found_blocks, labels = html_text.rewritten([t for t, y in zip(texts, weak) if y], [t for t, y in zip(texts, weak) if not y], pick)
        wrong += int((model.label([found_blocks])[0] != np.array(labels, dtype=bool)).sum())
        total += len(labels)
    assert wrong <= 0.08 * total


MALFORMED = [
    ("<p>if x<y it's so</p><p>second</p><p>we don't know</p><p>last</p>", ["if x", "second", "we don't know", "last"]),
    ("<b title=it's>bold</b></p><p>second</p><p>don't</p><p>last</p>", ["bold", "second", "don't", "last"]),
    ('<p class="a>b">x</p>', ["x"]),
    ("a < b <c", ["a < b <c"]),
    ("<p title = 'x>y' id=z>ok</p>", ["ok"]),
    ("<script>a</scripty></script >b", ["b"]),
    ('<p a="unclosed>text</p><p>more', ["text", "more"]),
]


@pytest.mark.parametrize("page,want", MALFORMED)
def test_malformed_pages_keep_their_text(page, want):
    assert [b.text for b in blocks(page)] == want


@pytest.mark.parametrize("part", ["<a ", "<a '", "<!--", "<", "<a x='", "</", "<script>", "<div>x", "<div></p>", "<div a='b'"])
def test_long_malformed_pages(part):
    """Linear: four times the page takes nowhere near sixteen times as long."""
    import time

    spent = []
    for size in (250_000, 1_000_000):
        start = time.process_time()
        blocks(part * (size // len(part)))
        spent.append(time.process_time() - start)
    assert spent[1] < 10 * spent[0] + 0.5
