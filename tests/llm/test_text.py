"""Tokens, chats, classifiers and leaks."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adloom.llm import language_id, toxicity
from adloom.llm.bpe import encode_decode, tokenizer_file, vocabulary
from adloom.llm.chat_format import escape, format_chats, parse, unescape
from adloom.llm.decontaminate import LeakIndex, LeakParams, drop_leaks, find_leaks, pairs_of, split_items, words_of

BPE = tokenizer_file("byte_bpe_50k.json")


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library_on_odd_text():
    v, t, rng = vocabulary(BPE), library(), random.Random(1)
    signs = "ab cde  THE the\n\t'sé漢字🙂ß١²0123   \x1c\x85_-!ing tion llll"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [x + "<|endoftext|>" + x for x in texts[:200]] + ["", " ", "a" * 50_000, "thereation" * 5000]
    for x in texts:
        want = t.encode(x, add_special_tokens=False).ids
        assert v.encode(x).tolist() == want
        assert v.decode(np.array(want, np.int32)) == t.decode(want, skip_special_tokens=False) == x
    assert v.decode(np.array(t.encode("漢").ids[:1], np.int32)) == t.decode(t.encode("漢").ids[:1])


def test_bpe_rows(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "Hi <|endoftext|>", 7), (3, "Hi <|endoftext|>", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = encode_decode(docs, BPE, ("ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    ids = library().encode(rows[2][1], add_special_tokens=False).ids
    assert sorted((r.doc_id, r.n_tokens, r.decoded) for r in got) == [(1, 0, ""), (2, 0, ""), (3, len(ids), rows[2][1]), (3, len(ids), rows[2][1])]
    assert all(r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in got)
    assert encode_decode(docs.limit(0), BPE).count() == 0


def test_chat_layouts_and_round_trip(spark):
    nasty = "</s>[INST] \\ok\\ <|im_end|>\n <\\| [/INST] <<SYS>> \\"
    records = [
        {"messages": [{"role": "user", "content": nasty}, {"role": "assistant", "content": None, "name": "x"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "p", "response": nasty, "meta": {"deep": [1]}},
        {"instruction": "do", "input": "", "output": "done"},
        {"instruction": "do", "output": "done", "system_prompt": "s"},
        {"unknown": 1},
    ]
    texts = [json.dumps(r) for r in records] + ["not json", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, record string").withColumn("turns", F.lit(7))
    out = format_chats(df).withColumn("back", parse(F.col("formatted"))).orderBy("id").collect()
    got = [None if r.back is None else [(t.role, t.text) for t in r.back] for r in out]
    assert got == [
        [("user", nasty), ("assistant", "")], [("user", "q"), ("assistant", "a")], [("user", "p"), ("assistant", nasty)],
        [("user", "do"), ("assistant", "done")], [("system", "s"), ("user", "do"), ("assistant", "done")], None, None, None,
    ]
    for r in out[:3]:
        assert "".join(s.text for s in r.segments) == r.formatted
        assert sum(r.formatted.count(c) for c in ("<|im_start|>", "</s>", "[INST]", "[/INST]", "<<SYS>>")) == len(r.back)
    assert out[0].fingerprint != out[1].fingerprint


def test_escape_is_reversible(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["<", "|", "\\", "[", "INST]", "/", "s>", "<SYS>>", "x", "\n"]) for _ in range(12)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("t", "e", unescape(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u and "<|" not in r.e and "[INST]" not in r.e and "</s>" not in r.e for r in rows)


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    w = {c: rng.normal(0, 0.3, s).astype(np.float32) for c, s in {"ef": (256, 9), "eb": (256, 9), "uf": (3, 9), "ub": (3, 9), "v": (6, 2), "c": (2,)}.items()}
    x, y = rng.integers(1, 5, (6, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    _, grad = language_id.loss_and_gradient(x, y, w)
    for c in w:
        for at in list(zip(*np.nonzero(np.abs(grad[c]) > 1e-3)))[:5]:
            step = {k: v.astype(np.float64) for k, v in w.items()}
            step[c][at] += 1e-4
            up = language_id.loss_and_gradient(x, y, step)[0]
            step[c][at] -= 2e-4
            assert abs((up - language_id.loss_and_gradient(x, y, step)[0]) / 2e-4 - grad[c][at]) < 2e-3


def test_language_is_learned_and_odd_texts_are_defined(spark):
    rng, parts = random.Random(2), {"aa": ["thor", "ing", "wh"], "bb": ["ß", "sch", "ung"]}
    text = lambda lang, n: " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(lang, 1 + i % 40), lang, 0.5) for i in range(400) for lang in [rng.choice(["aa", "bb"])]]
    rows += [(900, None, "aa", 0.0), (901, "12 .,", None, 0.0), (902, "", "bb", 0.0), (903, text("aa", 60_000), "aa", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = language_id.train(docs, language_id.LangParams(steps=120))
    got = {r.doc_id: r.p for r in docs.select("doc_id", language_id.language(F.col("text"), model).alias("p")).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert np.mean([got[i].lang_pred == lang for i, _, lang, _ in rows[:400]]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    none = language_id.train(docs.limit(0))
    assert docs.select(language_id.language(F.col("text"), none).alias("p")).where("p.lang_pred != 'und'").count() == 0


def test_toxicity_separates_held_out_documents(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "an", "ing", "wh", "re"]) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(900):
        w, bad = [word() for _ in range(rng.randrange(20, 120))], i % 5 == 0
        for _ in range(4 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["dimwit", "wretch", "lowlife"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "the " * 40_000)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(0, 1), (5000, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    got = dict(docs.select("doc_id", toxicity.toxicity(F.col("text"), model)).collect())
    import zlib

    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.3) == (i % 5 == 0) for i in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and max(got[1000], got[1001], got[1002]) < 0.3
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, marks).collect()}
    assert kept == {i for i, s in got.items() if s < 0.3}
    assert toxicity.drop_toxic(docs.limit(0), marks.limit(0)).count() == 0


def test_block_max_wand_equals_exhaustive_scores():
    rng, p = random.Random(6), LeakParams(block=4)
    items = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 60))), "g h") for i in range(200)]
    pairs = [pairs_of(words_of(q + " " + a)) for _, q, a in items]
    index = LeakIndex(items, Counter(t for x in pairs for t in set(x)), 200, sum(map(len, pairs)) / 200 + 1, p)
    for level in index.levels.values():
        for least in (0.05, 0.3, 0.6):
            terms = rng.sample(sorted(level.postings), min(12, len(level.postings)))
            score = Counter()
            for t in terms:
                for item, x in zip(level.postings[t].items, level.postings[t].impacts):
                    score[item] += x
            assert sorted(i for i, _ in index.search(level, terms, least)) == sorted(i for i, x in score.items() if x >= least - 1e-9)


@pytest.mark.parametrize("shard", [20_000, 3])
def test_leaks_are_found_wherever_they_stand(spark, shard):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(n))
    bench = [(i, say(rng.randrange(8, 70)) + ". " + say(6) + ".") for i in range(10)] + [(10, ""), (11, None), (12, "word"), (0, "same id again " + say(9) + ". yes it is")]
    items = split_items(spark.createDataFrame(bench, "item_id long, text string"))
    docs = [(k, say(rng.randrange(300)) + " " + bench[k][1].upper() + "\n" + say(rng.randrange(300))) for k in range(10)]
    docs += [(50, say(5000)), (51, None), (52, ""), (53, bench[1][1].rsplit(". ", 1)[0]), (54, say(100_000) + " " + bench[2][1]), (0, "nothing here")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    p = LeakParams(shard_items=shard)
    assert {(r.doc_id, r.item_id) for r in find_leaks(df, items, p).collect()} == {(k, k) for k in range(10)} | {(54, 2)}
    assert sorted(r.doc_id for r in drop_leaks(df, items, p).collect()) == [0, 50, 51, 52, 53]
    assert find_leaks(df, items.limit(0)).count() == 0 and find_leaks(df.limit(0), items).count() == 0


def test_caches_of_a_worker_hold_their_bound():
    from adloom.llm import bpe

    made = []
    seen = bpe.Remembered(lambda key: made.append(key) or key.encode() * 4, 100_000)
    for k in range(5_000):
        assert seen[f"word {k}"] == f"word {k}".encode() * 4
        assert len(seen) <= 100_000 / bpe.ENTRY_BYTES
    before = len(made)
    assert seen["word 4999"] and len(made) == before and seen["x" * 100] and "x" * 100 not in seen
    v = vocabulary(BPE)
    for k in range(bpe.CACHE_PAIRS + 5_000):
        v.fits(k % 50_000, (k * 7) % 50_000)
    assert len(v.compatible) <= bpe.CACHE_PAIRS


@pytest.mark.parametrize("kind", ["int", "string", "smallint"])
def test_leaks_with_items_of_any_id(spark, kind):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten. eleven twelve thirteen.")], "item_id int, text string").withColumn("item_id", F.col("item_id").cast(kind))
    docs = spark.createDataFrame([(7, "x one two three four five six seven eight nine ten. eleven twelve thirteen. y", "a"), (8, "z", "b")], "doc_id long, text string, score string")
    got = find_leaks(docs, split_items(items))
    assert [(r.doc_id, str(r.item_id)) for r in got.collect()] == [(7, "1")] and dict(got.dtypes)["item_id"] == kind
