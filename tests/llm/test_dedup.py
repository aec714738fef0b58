"""Exact and near dedup against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from adloom.llm.exact_dedup import drop_copies, exact_groups
from adloom.llm.minhash import NearParams, drop_near_copies, near_duplicates

DOCS = "doc_id long, text string, digest string, norm string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_with_ties_nulls_clashing_names_and_clashing_digests(spark, weak):
    texts = ["", None, "Éa", "éa", "ÉA", "abc", "ABC", "x" * 300_000, "X" * 300_000, "abc ", "zz", "zz"]
    rows = [(i, t, "d", "n") for i, t in enumerate(texts)] + [(None, "abc", "", ""), (None, "only null", "", ""), (10, "zz", "", "")]
    digest = {"digest": lambda c: F.substring(F.sha2(c, 256), 1, 1)} if weak else {}
    got = exact_groups(spark.createDataFrame(rows, DOCS), **digest).collect()
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(lower(t), []).append(i)
    want = sorted((i if i is not None else -1, max((x for x in g if x is not None), default=-1), len(g)) for g in by_text.values() for i in g)
    assert want == sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size) for r in got)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_hot_group_is_salted_and_whole(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot TEXT").otherwise(F.concat(F.lit("t"), (F.col("id") % 1500).cast("string"))).alias("text"))
    got = exact_groups(docs).where("text_sha256 = sha2('hot text', 256)").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(4998, 1667)]


def test_drop_copies_keeps_columns_and_makes_repeated_rows_one(spark):
    rows = [(1, "a", "x", "y"), (2, "A", "x", "y"), (2, "A", "x", "y"), (3, "b", None, None), (None, "c", None, None)]
    got = drop_copies(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "text", "digest", "norm"]
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "c"), (2, "A"), (3, "b")]
    assert drop_copies(spark.createDataFrame([], DOCS)).count() == 0


def brute_components(rows, p=NearParams()):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[k : k + p.words]) for k in range(max(1, len(w) - p.words + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= p.percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force_on_chains_and_families(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for family in range(8):
        base = [word() for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(14):  # drifting copies: chains whose ends are far apart
            if rng.random() < 0.7:
                base = list(base)
                base[rng.randrange(len(base))] = word()
            rows.append((len(rows), (" " if rng.random() < 0.5 else "\n\t").join(base).upper() if rng.random() < 0.3 else " ".join(base)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "one", "One", "one two", "  ", "a b c d e", "A\vb c\td e", "a\xa0b"])]
    df = spark.createDataFrame([(i, t, "k", None) for i, t in rows], "doc_id long, text string, key string, sig string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, NearParams(block=4)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_on_nothing_and_columns_of_the_filter(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(5, "a b c d e f g", "x"), (2, "A b c d e f g", "y"), (None, "a b c d e f g", "z")], "doc_id long, text string, component string")
    got = drop_near_copies(docs)
    assert got.columns == docs.columns and sorted((r.doc_id or 0) for r in got.collect()) == [0, 2]


def test_stages_leave_columns_of_any_name_alone(spark):
    names = ["_key", "_digest", "_id", "_sha", "_gone", "_GONE_", "_gone_id", "keep_id", "component", "hot", "salt"]
    rows = [(1, "a b c d e f g", *names), (2, "A B c d e f g", *names), (3, "other words that are not the same", *names), (None, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for stage in (drop_copies, drop_near_copies):
        got = stage(docs)
        assert got.columns == docs.columns
        kept = got.collect()
        assert sorted(r.doc_id or 0 for r in kept) == ([0, 2, 3] if stage is drop_copies else [0, 1, 3])
        assert all([r[n] for n in names] == names for r in kept)
        assert stage(docs.limit(0)).count() == 0
