"""Merkle manifest, alignment and personal data against brute force, with odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from planefold.llm import align, encode, jaccard, merkle, mixing, pii, queries
from planefold.llm.encode import _byte_letters
from tests.llm.test_edges import ODD, TOKENIZER, found, table, words

OTHER = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = "_first _place _copies _key _from _words _row _copy of_place of_copies place row leaf digest tree n path".split()


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """Rows of ``doc_id, text, lang, source, n_chars`` by plain recursion."""

    def leaf(doc_id, text, lang, source, n_chars):
        values = [doc_id, source, lang, n_chars, text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(leaves):
        paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
        while len(level) > 1:
            for i, place in enumerate(at):
                low = place // 16 * 16
                paths[i].append(("".join(level[low:place]), "".join(level[place + 1 : low + 16])))
            level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
            at = [place // 16 for place in at]
        return level[0], paths

    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row, leaf(*row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(groups[s], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in names}
    trees = {s: tree([h for _, h in ordered[s]]) for s in names}
    root, upper = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, upper):
        for (row, own), path in zip(ordered[s], trees[s][1]):
            whole = path + above
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]) if row[1] is not None else None
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            now = leaf(row[0], lower, *row[2:]) if tampered else own
            for before, after in whole:
                now = sha(before + now + after)
            proof = sha("".join(before + after for before, after in whole))
            out.append((row[0], own, trees[s][0], root, proof, now, now == root))
    return sorted(out, key=repr)


MERKLE = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_of(spark, df, path):
    df.write.parquet(f"{path}/documents.parquet")
    return found(queries.op11_merkle_manifest(spark, str(path)), *MERKLE)


def test_manifest_odd_rows(spark, odd, tmp_path):
    want = brute_manifest([(d, t, lang, source, 1) for d, t, lang, source in ODD])
    assert manifest_of(spark, odd, tmp_path / "odd") == want
    assert manifest_of(spark, table(spark, []), tmp_path / "none") == []


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 256, 257, 300], [2] * 17])
def test_manifest_sizes(spark, tmp_path, sizes):
    pick = random.Random(len(sizes))
    ids = pick.sample(range(10**6), sum(sizes))
    sources = [s for s, n in enumerate(sizes) for _ in range(n)]
    rows = [(d, f"Text {d % 7}", "en", [None, "Ä", "b", "~"][s] if s < 4 else f"s{s}") for d, s in zip(ids, sources)]
    got = manifest_of(spark, table(spark, rows), tmp_path / "sized")
    assert got == brute_manifest([(d, t, lang, source, 1) for d, t, lang, source in rows])
    assert {v for *_, v in got} >= ({True, False} if len(ids) > 30 else {True} & {v for *_, v in got})


def test_manifest_windows_are_cut(spark):
    leaves = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    plan = merkle._siblings(merkle.numbered(leaves.withColumnsRenamed({"source": "tree", "leaf": "digest"}), ["tree"], ["doc_id"], "place", total="n"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert f"place#" in text and f"div {merkle.CHUNK}" in text


def brute_alignment(rows):
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=OTHER)
    letters = {letter: byte for byte, letter in _byte_letters().items()}
    spelled_a = {i: bytes(letters[c] for c in x) for x, i in a.get_vocab().items() if x != "<|endoftext|>"}

    def spelled_b(i):
        x = b.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if len(x) == 6 and x.startswith("<0x") else x.replace("▁", " ").encode()

    cut, seen = [], Counter()
    for doc_id, text in rows:
        ids = ((a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], []))
        both = [[spelled_a[i] for i in ids[0]], [spelled_b(i) for i in ids[1]]]
        if not text or any(b"".join(x) != (" " + text).encode() for x in both):
            cut.append((doc_id, []))
            continue
        ends = []
        for side in both:
            at, own = 0, []
            for x in side:
                at += len(x)
                own.append(at)
            ends.append(own)
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            own = ([], [])
            while i < len(ids[0]) and ends[0][i] <= end:
                own[0].append(ids[0][i])
                i += 1
            while j < len(ids[1]) and ends[1][j] <= end:
                own[1].append(ids[1][j])
                j += 1
            groups.append(own)
        cut.append((doc_id, groups))
        seen.update({(x, y) for g, h in groups for x in g for y in h})
    best = {}
    for (x, _), n in seen.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, groups in cut:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append(
            (doc_id, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
             sum(seen[x] == best[x[0]] for x in links), sum(seen[x] for x in links), text)
        )
    return sorted(out, key=repr)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
STRANGE = [
    "a▁b", "  two  spaces ", "\ttab\n\nlines \n x", "日本語 テキスト 漢字", "naïve café — “quotes”", "<|endoftext|> <s> </s> <unk>", "<0x41>",
    "1234567890" * 9, "=" * 700, "x" * 300 + " y", "é́", "  nbsp 　 wide", "😀 emoji👩‍👩‍👧", " ", "\n", "don't we'll",
]


@pytest.mark.parametrize("limit", [align.LIMIT, 0])
def test_alignment(spark, limit):
    pick = random.Random(9)
    mixed = ["".join(pick.choices(["a", " ", "the", "  ", "\n", "é", "漢", "ing ", ".", "12", "'s", "▁" if k % 9 == 0 else "b"], k=40)) for k in range(150)]
    rows = [(d, t) for d, t, _, _ in ODD] + list(enumerate([*STRANGE, *STRANGE[:3], *mixed], start=100))
    docs = spark.createDataFrame([(d, t, 3, "x") for d, t in rows], "doc_id long, text string, row int, pairs string")
    assert found(align.alignment(docs, TOKENIZER, OTHER, limit=limit), *ALIGNED) == brute_alignment(rows)
    assert align.alignment(docs.filter("false"), TOKENIZER, OTHER, limit=limit).count() == 0


def test_pointers_reach_the_last_token():
    pick = random.Random(3)
    import numpy as np

    for _ in range(200):
        total = pick.randint(1, 60)
        ends = [sorted({total, *(pick.randint(1, total) for _ in range(pick.randint(0, 30)))}) for _ in range(2)]
        sizes = [np.diff([0, *e]) for e in ends]
        common = sorted(set(ends[0]) & set(ends[1]))
        for got, own in zip(align.groups_of(*sizes), ends):
            assert got.tolist() == [next(i for i, c in enumerate(common) if e <= c) for e in own]


def test_encoder_pieces_and_generations(monkeypatch):
    pick = random.Random(6)
    parts = [" ", "  ", "\n", "a", "é", "1", ".", "'s", " ", "\t", "<|endoftext|>", "漢", " ab", ",", "Éx", "　", "word", " other"]
    texts = ["", None, words(3000, 4), "z" * 500, *("".join(pick.choices(parts, k=pick.randint(1, 40))) for _ in range(800))]
    monkeypatch.setattr(encode, "CACHE_BYTES", 1 << 12)
    monkeypatch.setattr(encode, "AT_ONCE", 1 << 10)
    for plain in (False, True):
        own = encode.Encoder(TOKENIZER, plain)
        for _ in range(2):
            assert own.batch(pa.array(texts)) == [own.whole(t or "") for t in texts]


def base_brute(text):
    import re

    out = []
    for kind, pattern in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and pii.passes_luhn(digits), 9 <= len(digits) <= 15]
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    pick = random.Random(2)
    parts = list("0123456789") + [" ", "-", ".", "@", "+", "(", ")", "a", "b.c", "x@y.z", "4111111111111111", "192.168.0.1", "\n", "é", "%", "255.", "+1 (212) 555-0100"]
    for _ in range(4000):
        text = "".join(pick.choices(parts, k=pick.randint(0, 30)))
        assert pii.base_spans(text)[0] == base_brute(text), text
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 100_000, "1." * 100_000, "+1(" * 60_000, "+1" + "(" * 200_000):
        pii.base_spans(text)


def luhn_number(pick, length=16):
    while True:
        digits = "".join(pick.choices("0123456789", k=length))
        if pii.passes_luhn(digits):
            return digits


@pytest.fixture(scope="module")
def field(spark):
    pick = random.Random(11)
    rows = []
    for i in range(120):
        filler = words(6, i)
        own = [f"{filler[:5]}.{i}@mail{i % 7}.example.com", f"{pick.randint(1, 255)}.{i}.3.77", luhn_number(pick), f"+1 ({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)}"][i % 4]
        bad = "".join(pick.choices("0123456789", k=16))
        rows.append((i, f"{filler} {own} {filler}. Version 4.0 of 2024, {bad if not pii.passes_luhn(bad) else '12'} more.", None, None))
    return pii.train(table(spark, rows))


def test_field_adds_what_patterns_drop(spark, field):
    pick = random.Random(12)
    cards = [luhn_number(pick) for _ in range(2)]
    together = f"see {cards[0]} {cards[1]} end"
    if pii.base_spans(together)[0]:
        pytest.skip("the pair passes by chance")
    phone = "by +1 (826) 555-4081 190.137.223.204 from"
    texts = [together, phone, "nothing here", "version 4.0, 2024-01-01 and 1 2 3 4 5 6 7 8 9 10 11 12", None, "", words(20_000, 3)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, base int")
    got = {r["doc_id"]: r for r in pii.find_pii(docs, field).collect()}
    assert [(s["kind"], together[s["start"] : s["stop"]]) for s in got[0]["added"]] == [(2, cards[0]), (2, cards[1])]
    assert [(s["kind"], phone[s["start"] : s["stop"]]) for s in got[1]["base"]] == [(1, "190.137.223.204")]
    assert [(s["kind"], phone[s["start"] : s["stop"]]) for s in got[1]["added"]] == [(3, "+1 (826) 555-4081")]
    assert all(not got[i]["base"] and not got[i]["added"] for i in range(2, 7))


def test_field_agrees_with_its_examples(field):
    pick = random.Random(13)
    for text in ("q.7@mail3.example.com", "10.0.0.7", luhn_number(pick), "+1 (555) 555-0123"):
        base = pii.base_spans(text)[0]
        assert field.best(pii.lattice(text)) == base
    for text in ("1234567812345678", "4.0", "2024"):
        assert not pii.added_spans(text, [], field)


def test_field_slope(field):
    """The gradient of the likelihood against differences."""
    text = "+1 (826) 555-4081 190.137.223.204"
    region = pii.lattice(text)
    place = {b: i for i, b in enumerate(region.bounds)}
    gold = {(3, 0, place[17]), (1, place[18], place[33])}
    slope, pairs, _ = field.slope(region, gold)
    for name in sorted(slope, key=lambda n: -abs(slope[n]))[:5]:
        kept, step = field.weights.get(name, 0.0), 1e-5
        field.weights[name] = kept + step
        high = field.slope(region, gold)[2]
        field.weights[name] = kept - step
        low = field.slope(region, gold)[2]
        field.weights[name] = kept
        assert slope[name] == pytest.approx((high - low) / (2 * step), abs=1e-4)


def test_pii_without_examples(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    empty = pii.train(none)
    assert not empty.weights and pii.find_pii(none, empty).count() == 0
    docs = spark.createDataFrame([(None, "a@b.co"), (1, "a@b.co")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in pii.find_pii(docs, empty).collect() if len(r["base"]) == 1) == ["1", "None"]


def test_pii_counts_by_kind(spark, tmp_path):
    """The query's counts and digest against the patterns: several of a kind, one kind alone, parts with thousands of zeros."""
    texts = [
        None, "", "write to a@b.co now", "a@b.co c.d@e.fr x@y.z.org", "at 1.2.3.4", "+12 345 678 901", "4111 1111 1111 1111",
        "a@b.co, 4111 1111 1111 1111, +12 345 678 901, 10.0.0.1, 10.0.0.2", "1." + "0" * 5000 + "1.2.3", "0" * 5000 + "256.1.2.3", "none",
    ]
    rows = [(i // 2 if i > 1 else None, text) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    names = [f"n_{kind}" for kind in pii.KINDS]
    got = queries.op13_pii(spark, str(tmp_path)).select("doc_id", *names, "base_sha256").collect()
    want = []
    for doc_id, text in rows:
        base = base_brute(text or "") if len(text or "") < 4000 else [(1, 0, len(text))] * (not text.startswith("0"))
        digest = sha(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base))
        want.append((doc_id, *[sum(k == kind for k, _, _ in base) for kind in range(4)], digest))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rows_keep_columns_named_like_helpers(spark):
    rows = [(d, t, lang, source) for d, t, lang, source in ODD]
    docs = table(spark, rows)
    for name in CLASHES:
        docs = docs.withColumn(name, F.concat(F.lit(name + " "), F.coalesce(F.col("text").substr(1, 5), F.lit("-"))))
    for operator in (jaccard.one_of_each, mixing.mixed):
        kept = operator(docs)
        assert kept.columns == docs.columns
        got = kept.collect()
        assert got and all(r[name] == f"{name} {'-' if r['text'] is None else r['text'][:5]}" for r in got for name in CLASHES)
        plain = operator(table(spark, rows)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in plain)
