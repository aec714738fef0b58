"""Toxicity by compression distance between two zstandard dictionaries."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import HELD_OUT, fold_of

EDGES = b".,;:!?\"'()[]|*&%$#"


@dataclass(frozen=True)
class ToxParams:
    """At most so many labelled documents of each kind, none longer than `sample_chars`, are fitted. Windows are `window` words.

    A word belongs to toxic text if its distinct left neighbours are `lift` times as frequent there and the G statistic is `least_g`.
    """

    toxic_docs: int = 2000
    ordinary_docs: int = 4000
    sample_chars: int = 40_000
    window: int = 8
    dictionary: int = 16_384
    toxic_bytes: int = 16_384
    lift: float = 8.0
    least_g: float = 16.0
    gains: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8)
    threshold: float = 0.3


@dataclass(frozen=True)
class ToxModel:
    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    params: ToxParams


def _windows(text: str, size: int) -> list[bytes]:
    w = text.lower().encode().split()
    return [b" " + b" ".join(w[i : i + size]) + b" " for i in range(0, len(w), size)]


@lru_cache(maxsize=4)
def _compressor(content: bytes):
    """Every position of the dictionary is indexed, so that two dictionaries with a common end find the same matches there."""
    import zstandard as z

    d = z.ZstdCompressionDict(content or b"\0" * 8, dict_type=z.DICT_TYPE_RAWCONTENT)
    how = z.ZstdCompressionParameters.from_level(
        8, dict_size=max(8, len(content)), source_size=64, min_match=6, strategy=z.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    d.precompute_compress(compression_params=how)
    return z.ZstdCompressor(compression_params=how, dict_data=d)


def _sizes(content: bytes, windows: list[bytes]) -> np.ndarray:
    out = _compressor(content).multi_compress_to_buffer(windows, threads=1)
    return np.fromiter((len(x) for x in out), np.int32, len(windows))


def features(texts: Sequence[str | None], ordinary: bytes, toxic: bytes, p: ToxParams) -> np.ndarray:
    """Per text: the number of windows, and how many of them the toxic dictionary makes shorter by each number of bytes."""
    counts = np.zeros((len(texts), 1 + len(p.gains)))
    at = 0
    while at < len(texts):
        windows, owner, held = [], [], 0
        while at < len(texts) and held < 1 << 20:  # a very long text makes a large turn of its own
            own = _windows(texts[at] or "", p.window)
            windows += own
            owner += [at] * len(own)
            held += sum(map(len, own))
            at += 1
        if windows:
            gain, owner = _sizes(ordinary, windows) - _sizes(toxic, windows), np.array(owner)
            n = len(texts)
            counts[:, 0] += np.bincount(owner, minlength=n)
            for j, k in enumerate(p.gains):
                counts[:, 1 + j] += np.bincount(owner, gain >= k, n)
    return np.concatenate([np.log1p(counts), counts[:, 1:] > 0], axis=1)


def toxic_words(toxic: list[str], ordinary: list[str], p: ToxParams) -> list[bytes]:
    """Words that mark toxic text, the most telling last.

    Left neighbours are counted, not documents: a near copy repeats its words next to the same words, and adds nothing.
    """
    def contexts(texts: list[str]) -> tuple[Counter, int]:
        seen = set()
        for t in texts:
            w = [x.strip(EDGES) for x in t.lower().encode().split()]
            seen.update(zip([b"", *w], w))
        return Counter(w for _, w in seen), max(1, len(seen))

    (ft, nt), (fo, no) = contexts(toxic), contexts(ordinary)
    share, found = nt / (nt + no), []
    for w, a in ft.items():
        b = fo[w]
        if a < 3 or len(w) < 3 or a / nt <= p.lift * (b + 0.5) / no:
            continue
        g = 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0))
        if g >= p.least_g:
            found.append((g, w))
    return [w for _, w in sorted(found)]


def fit(toxic: list[str], ordinary: list[str], p: ToxParams) -> ToxModel:
    """Both dictionaries, and the logistic calibration of counts of window gains.

    The ordinary dictionary is trained by zstandard on windows of ordinary text. The toxic one is trained on what marks toxic text and
    goes on with the ordinary content, so ordinary words compress alike with both and the difference in length is due to toxic text.
    """
    import zstandard as z

    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    samples = [w for t in ordinary for w in _windows(t, p.window)]
    try:
        base = z.train_dictionary(min(p.dictionary, max(256, sum(map(len, samples)) // 8)), samples, k=32, d=6).as_bytes()
    except z.ZstdError:  # too little text to train on: the text itself
        base = b"".join(samples)[-p.dictionary :]
    marks = b" " + b" ".join(toxic_words(toxic, ordinary, p))[-p.toxic_bytes :] + b" "
    x = features(toxic + ordinary, base, marks + base, p)
    y = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    if len(set(y)) < 2:  # nothing to tell apart
        return ToxModel(base, marks + base, (0.0,) * x.shape[1], (1.0,) * x.shape[1], (0.0,) * x.shape[1] + (-5.0,), p)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a, w = np.c_[(x - mean) / scale, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    ridge = np.r_[np.ones(x.shape[1]), 1e-3]
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (q * (1 - q))[:, None]) + np.diag(ridge), a.T @ (q - y) + ridge * w)
    return ToxModel(base, marks + base, tuple(mean), tuple(scale), tuple(w), p)


def score_texts(texts: Sequence[str | None], m: ToxModel) -> np.ndarray:
    x = (features(texts, m.ordinary, m.toxic, m.params) - np.array(m.mean)) / np.array(m.scale)
    return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ np.array(m.weights), -30, 30)))


def train(docs: DataFrame, labels: DataFrame, p: ToxParams = ToxParams()) -> ToxModel:
    """Fits on a bounded sample of labelled documents outside the held-out fold, chosen by hash of the id.

    `labels` has doc_id and toxic (1 or 0); documents with both labels count as toxic, null labels do not count.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold_of(F.col("doc_id")) != HELD_OUT)
    order = F.xxhash64("doc_id", F.lit(7))

    def some(toxic: int, n: int) -> DataFrame:
        return known.where(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(n)

    # at most toxic_docs + ordinary_docs rows of two numbers
    chosen = F.broadcast(some(1, p.toxic_docs).union(some(0, p.ordinary_docs)))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where(F.char_length("text") <= p.sample_chars).select("doc_id", "toxic", "text").dropDuplicates(["doc_id"])
    got = sorted(rows.collect())
    return fit([r.text for r in got if r.toxic == 1], [r.text for r in got if r.toxic != 1], p)


def toxicity(text: Column, model: ToxModel) -> Column:
    """Score from 0 to 1 of every whole text; null and empty texts get the score of a text without windows.

    Texts of any length are compressed whole, about a megabyte or one text at a time. Equal texts get equal scores, an empty table gives no
    rows, and no other column is read.
    """
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(score_texts(s.tolist(), model))

    return score(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, p: ToxParams = ToxParams()) -> DataFrame:
    """`docs` without those whose score reaches the threshold, all columns kept, whatever their names. Labels for unknown documents, null labels and
    repeated labels do no harm; without any label of a kind nothing is rejected for want of a difference."""
    return docs.where(toxicity(F.col("text"), train(docs, labels, p)) < p.threshold)
