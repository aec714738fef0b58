"""Alignment of two tokenizers against a plain reading of the rule."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from adloom.llm.align import NONE, AlignParams, Fragment, align, align_corpus, compose, split_text, token_pair
from adloom.llm.bpe import tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def tokens(text):
    """ids and bytes of both sides, by the libraries and token by token; None if bytes are lost."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute(text):
    got = tokens(text) if text else None
    if got is None:
        return 0, 0, [], Counter()
    ids_a, bytes_a, ids_b, bytes_b = got
    ends = lambda parts: np.cumsum([len(x) for x in parts]).tolist()
    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    groups, at = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, e in zip(ids_a, ends_a) if at < e <= end], [i for i, e in zip(ids_b, ends_b) if at < e <= end]))
        at = end
    return len(ids_a), len(ids_b), groups, Counter((x, y) for g in groups for x in g[0] for y in g[1])


def texts():
    rng = random.Random(11)
    words = ["the", "Größe", "naïve", "x_1", "<|endoftext|>", "</s>", "12345", "漢字", "🙂", "  ", "\n\n", "don't", "aaaaaaaa", "----", "éèê", "\t", "ﬁ"]
    out = [None, "", " ", "a", "▁ lossy", "\x00", "\x1c x", "same text", "same text"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    return out + [" ".join(rng.choice(words) for _ in range(700)), "ab " * 900, "a" * 3000, " " * 2000, "words then ▁ " + "word " * 900]


@pytest.mark.parametrize("p", [AlignParams(), AlignParams(segment=300, leaf=37, fan_in=2, batch=500, hot_pairs=12)])
def test_alignment_equals_brute_force(spark, p):
    rows = [(i, t, "r", 1) for i, t in enumerate(texts())] + [(None, "same text", "r", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, part int").repartition(3)
    want = {i: brute(t) for i, t, *_ in rows}
    held = Counter(pair for n_a, n_b, groups, links in want.values() for pair in links)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    got = align_corpus(docs, FILES, p).collect()
    assert len(got) == len(rows)
    for r in got:
        n_a, n_b, groups, links = want[r.doc_id]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        n_links = sum(links.values())
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups) == (n_a, n_b, len(groups), n_links, said), r.doc_id
        assert r.count_sum == sum(held[x] * n for x, n in links.items())
        assert r.n_best == sum(n for x, n in links.items() if held[x] == best[x[0]])


def test_hashed_and_empty(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "")], "doc_id long, text string")
    plain, hashed = ({r.doc_id: r.groups for r in align(docs, FILES, hashed=h).collect()} for h in (False, True))
    assert hashed == {1: hashlib.sha256(plain[1].encode()).hexdigest(), 2: ""}
    assert align_corpus(docs.limit(0), FILES).count() == 0


def test_composition_is_associative():
    rng = random.Random(3)
    ids = lambda: np.array([rng.randrange(9) for _ in range(rng.randrange(3))], np.int64)

    def some():
        if rng.random() < 0.4:
            p = ids(), ids()
            return Fragment(False, p, "", 0, 0, NONE, NONE, (NONE, NONE), len(p[0]), len(p[1]))
        return Fragment(True, (ids(), ids()), "1|2;" if rng.random() < 0.5 else "", 1, 1, np.array([12]), np.array([2]), (ids(), ids()), 3, 4)

    def told(f):
        return f.cut, [x.tolist() for x in (*f.prefix, *f.suffix, f.pairs, f.times)], f.closed, f.n_groups, f.n_links, f.n_a, f.n_b

    for _ in range(2000):
        x, y, z = some(), some(), some()
        assert told(compose(compose(x, y, 10), z, 10)) == told(compose(x, compose(y, z, 10), 10))


def test_parts_put_together_are_the_text():
    text = "word one two  three\n" * 500
    parts = list(split_text(text, 100))
    assert " ".join(parts) == text and len(parts) > 50
    assert list(split_text("x" * 1000, 100)) == ["x" * 1000]


def test_groups_of_any_length_cost_their_distinct_ids():
    v = token_pair(*FILES)
    assert v.encode("﻿" * 5) is not None and v.encode(" " * 100_000) is not None
