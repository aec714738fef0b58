"""The corpus pipeline over a small table with planted copies, leaks and toxic texts, stage by stage against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adloom.llm import toxicity
from adloom.llm.bpe import tokenizer_file, vocabulary
from adloom.llm.decontaminate import split_items
from test_dedup import brute_components, lower

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path = random.Random(4), tmp_path_factory.mktemp("sf")
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    say = lambda n: " ".join(word() for _ in range(n))
    texts, labels = [], []
    for i in range(400):
        words, bad = say(rng.randrange(40, 90)).split(), i % 4 == 0
        for _ in range(6 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["dimwit", "wretch", "lowlife"]))
        texts.append(" ".join(words))
        labels.append((i, 1, int(bad)))
    bench = [(k, say(30) + ". " + say(8) + ".") for k in range(6)]
    clean = [i for i in range(400) if i % 4]
    texts += [texts[i].upper() for i in clean[:15]]  # copies
    texts += [" ".join([*texts[i].split()[:-1], "changed"]) for i in clean[20:35]]  # near copies
    texts += [say(50) + " " + t + " " + say(50) for _, t in bench]  # leaks
    texts += [None, "", "", "a few words", "A few words"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, bench


def test_pipeline_equals_its_rules_one_by_one(spark, folder):
    path, rows, bench = folder
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    model = toxicity.train(docs, labels)
    scores = toxicity.score_texts([t for _, t, *_ in rows], model)
    left = [(i, t) for (i, t, *_), s in zip(rows, scores) if s < 0.3]
    assert sum(i < 400 and i % 4 == 0 for i, _ in left) < 10
    last = {lower(t): i for i, t in left}
    left = [(i, t) for i, t in left if last[lower(t)] == i]
    component = brute_components(left)
    left = [(i, t) for i, t in left if component[i][1] == i]

    def leaks(text):
        words = set(lower(text).split())
        return any(len(words & set(lower(t.replace(".", "")).split())) >= 0.8 * len(set(t.split())) for _, t in bench)

    left = [(i, t) for i, t in left if not leaks(t)]
    v = vocabulary(tokenizer_file("byte_bpe_50k.json"))
    want = {i: (v.encode(t or "").tolist(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in left}
    got = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: (list(r.ids), r.decoded_sha256) for r in got} == want and len(got) == len(want)
    assert 200 < len(want) < 330


def test_stages_keep_the_columns_and_survive_an_empty_table(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumns({"score": F.lit("mine"), "_gone": F.lit(1), "ids": F.lit(2.5)})
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        few = stage(spark, docs.where("doc_id % 40 = 3"), path)
        none = stage(spark, docs.limit(0), path)
        assert none.count() == 0
        if name != "bpe":
            assert few.columns == none.columns == docs.columns
            assert {(r.score, r["_gone"], r.ids) for r in few.collect()} == {("mine", 1, 2.5)}


def test_split_items_and_scores_do_not_depend_on_order(spark, folder):
    path, rows, bench = folder
    items = split_items(spark.read.parquet(f"{path}/benchmark.parquet")).collect()
    assert sorted((r.item_id, f"{r.question} {r.answer}") for r in items) == bench
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    one, two = toxicity.train(docs, labels), toxicity.train(docs.repartition(3), labels.repartition(2))
    assert one.toxic == two.toxic and np.allclose(one.weights, two.weights)
