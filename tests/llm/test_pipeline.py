"""Every stage of the pipeline against brute force."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from planefold.llm import language, mixing
from tests.llm.test_edges import ODD, brute_groups, near_copies, table, words

PLANTED = words(14, 555)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    noise = "".join(chr(0x4E00 + i * 37 % 9000) for i in range(500))
    rows = [*ODD, *((200 + d, t, "en", f"s{d % 3}") for d, t in near_copies()), (400, "so " + PLANTED, "en", "s1"), (401, noise, None, "s2")]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, PLANTED), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "source mixing", "token files"]
    (_, lang), (_, join), (_, clean), (_, mix), (_, tokens) = pipeline.STAGES

    known = lang(spark, docs, folder)
    assert known.columns == docs.columns
    model = language.train_model(docs)
    every = docs.collect()
    rejected = model.predict([r["text"] or "" for r in every])["rejected"]
    assert sorted(map(str, known.collect())) == sorted(str(r) for r, no in zip(every, rejected) if not no)
    assert known.filter("doc_id = 401").count() == 0

    single = join(spark, known, folder)
    assert single.columns == docs.columns
    groups = brute_groups([(r["doc_id"], r["text"]) for r in known.collect()])
    want = sorted({d for d, _, c in groups if d == c and d is not None})
    assert sorted(r["doc_id"] for r in single.filter("doc_id IS NOT NULL").collect()) == want

    left = clean(spark, single, folder)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r["doc_id"]) for r in single.collect() if PLANTED not in r["text"])
    assert left.filter("doc_id = 400").count() == 0

    mixed = mix(spark, left, folder)
    assert mixed.columns == docs.columns
    size = {r["doc_id"]: len(re.findall(r"\S+", r["text"])) for r in left.collect()}
    total = sum(size[r["doc_id"]] for r in mixed.collect())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(left).filter("doc_id IS NOT NULL").collect()}
    assert total == mixing.mix_sources(left).agg(F.sum("taken")).first()[0]
    assert {r["doc_id"]: r["count"] for r in mixed.filter("doc_id IS NOT NULL").groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(((r["doc_id"], r["text"]) for r in mixed.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = tokens(spark, mixed, folder)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want


def test_run_and_empty_table(spark, folder, tmp_path):
    assert pipeline.run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    none = str(tmp_path)
    table(spark, []).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{none}/benchmark.parquet")
    assert pipeline.run(spark, none).count() == 0
