"""Every text query against its SQL, or against brute force over the same tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as driver
from planefold.llm.oracle import ORACLE
from planefold.llm.queries import QUERIES
from tests.check import connect, differences

SF_DIR = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def encoded(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False)]


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect()))


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language(spark, duck, texts):
    true = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = rows(spark, "op2_language_id")
    assert [(r[0], r[1]) for r in got] == [(d, fold(d, 3) == 1) for d, _ in texts]
    assert all(0 <= r[3] <= 1 for r in got)
    held = [r for r in got if r[1]]
    assert np.mean([r[2] == true[r[0]] for r in held]) >= 0.97
    assert not any(r[4] for r in got)


def test_mixing(spark, duck):
    got = rows(spark, "op4_source_mixing")
    source = dict(duck.execute("SELECT doc_id, source FROM documents").fetchall())
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
    totals = {s: sum(size[d] for d in size if source[d] == s) for s in set(source.values())}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(totals))}
    target, full = {}, set()
    while True:
        left = 1.5 * sum(totals.values()) - sum(2 * totals[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        target = {s: 2.0 * totals[s] if s in full else weight[s] * left / open_weight for s in totals}
        more = {s for s in totals if s not in full and target[s] > 2 * totals[s]}
        if not more:
            break
        full |= more
    taken: dict = {}
    for doc_id, own, source_size, wanted, words in got:
        assert (own, source_size) == (size[doc_id], totals[source[doc_id]])
        assert wanted == pytest.approx(target[source[doc_id]])
        assert words in (0, own, 2 * own)
        taken[source[doc_id]] = taken.get(source[doc_id], 0) + words
    assert len(got) == len(size)
    assert all(abs(taken[s] - target[s]) <= 10 for s in totals)
    assert got == rows(spark, "op4_source_mixing")


def test_token_files(spark, texts, encoded):
    want, start = [], 0
    for (doc_id, _), ids in zip(texts, encoded):
        every = np.array([*ids, 2], dtype="<u4")
        want.append((doc_id, start, len(every), zlib.crc32(every.tobytes())))
        start += len(every)
    assert rows(spark, "op5_token_files") == want


def test_token_counts(spark, texts, encoded):
    want = [(d, len(t.encode()), len(ids), len(ids) > 512) for (d, t), ids in zip(texts, encoded)]
    assert rows(spark, "op6_token_counts") == want


def brute_sketch(text, k=128):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = set()
    for i in range(max(len(words) - 4, min(len(words), 1))):
        value = 42
        for word in words[i : i + 5]:
            value = xxhash.xxh64(word.encode(), seed=value).intdigest()
        hashes.add(value - (1 << 64) if value >> 63 else value)
    return sorted(hashes)[:k]


def brute_likeness(a, b, k=128):
    least = sorted(set(a) | set(b))[:k]
    return len(set(least) & set(a) & set(b)) / len(least) if least else 1.0


def test_fingerprints(spark, texts):
    down = texts[::-1]
    want = []
    for i, (doc_id, text) in enumerate(down):
        following, half = down[(i + 1) % len(down)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = brute_sketch(text), brute_sketch(edited), brute_sketch(following)
        names = ["".join(f"{h & (2**64 - 1):016x}" for h in s) for s in (own, other)]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((doc_id, len(text), sha, *names, brute_likeness(own, other), brute_likeness(own, after)))
    assert rows(spark, "op7_document_fingerprints") == sorted(want)


def test_html(spark, duck):
    got = QUERIES["op8_html_extraction"](spark, SF_DIR).collect()
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    from html import unescape

    for row in got:
        article = re.search(r"<article>(.*)</article>", pages[row["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", article)]
        assert row["text"] == "\n".join(p for p in parts if p)
        assert row["n_chars"] == len(row["text"])
    assert len(got) == len(pages)


def test_toxicity(spark, texts, duck):
    got = rows(spark, "op9_toxicity")
    assert [(r[0], r[1]) for r in got] == [(d, fold(d, 4) == 2) for d, _ in texts]
    assert all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.3) for r in got)
    true = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
    seen = [(r[2], true[r[0]]) for r in got if r[0] in true and not r[1]]
    toxic, clean = [s for s, y in seen if y], [s for s, y in seen if not y]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.8  # eight toxic texts to learn from
