"""Language identification by a bidirectional gated recurrent network over bytes, trained here with numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import HELD_OUT, fold_of

LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LangParams:
    """The sample that is fitted: the `langs` most frequent languages, `docs` documents of each and `all_docs` in all, none longer than `sample_bytes`,
    and of each at most `windows` windows of `length` bytes, wherever they stand."""

    docs: int = 400
    all_docs: int = 8_000
    langs: int = 100
    sample_bytes: int = 40_000
    windows: int = 24
    length: int = 32
    hidden: int = 8
    steps: int = 400
    batch: int = 256
    rate: float = 0.03
    seed: int = 5


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    weights: dict[str, np.ndarray]
    length: int


def cut(texts: Sequence[str | None], length: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in windows, time first and padded with 0, and the text that each window is of."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        b = (t or "").encode()
        n = -(-len(b) // length)
        parts.append(b + b"\0" * (n * length - len(b)))
        owner.append(n)
    x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, length)
    return np.ascontiguousarray(x.T), np.repeat(np.arange(len(texts)), owner)


# Gates are update, reset and candidate, side by side. The reset gate acts on the recurrent part of the candidate. Gate and candidate
# functions are piecewise linear: clip(x / 4 + 1 / 2, 0, 1) and clip(x, -1, 1).


def _forward(x: np.ndarray, e: np.ndarray, u: np.ndarray, order, trace: list | None) -> np.ndarray:
    """States after each byte; keeps what the way back needs in `trace`."""
    n, k = x.shape[1], u.shape[0]
    h, states = np.zeros((n, k), np.float32), np.empty((len(x), n, k), np.float32)
    for t in order:
        a, g = e[x[t]], h @ u
        zr = a[:, : 2 * k] + g[:, : 2 * k]
        zr *= 0.25
        zr += 0.5
        np.clip(zr, 0, 1, out=zr)
        z, r = zr[:, :k], zr[:, k:]
        c = g[:, 2 * k :] * r
        c += a[:, 2 * k :]
        np.clip(c, -1, 1, out=c)
        if trace is not None:
            trace.append((t, h, z, r, c, g[:, 2 * k :]))
        h = h + z * (c - h)
        states[t] = h
    return states


def _backward(x: np.ndarray, u: np.ndarray, d_states: np.ndarray, trace: list, de: np.ndarray, du: np.ndarray) -> None:
    """Backpropagation through time of one direction."""
    dh, das = np.zeros_like(d_states[0]), np.empty((*x.shape, u.shape[1]), np.float32)
    for t, h, z, r, c, rec in reversed(trace):
        dh = dh + d_states[t]
        dc = dh * z * (np.abs(c) < 1)
        dz = dh * (c - h) * (0.25 * ((z > 0) & (z < 1)))
        dr = dc * rec * (0.25 * ((r > 0) & (r < 1)))
        da = np.concatenate([dz, dr, dc], axis=1)
        dg = np.concatenate([dz, dr, dc * r], axis=1)
        du += h.T @ dg
        das[t] = da
        dh = dh * (1 - z) + dg @ u.T
    order = np.argsort(x, axis=None, kind="stable")  # what belongs to one byte is summed together
    seen, first = np.unique(x.ravel()[order], return_index=True)
    de[seen] += np.add.reduceat(das.reshape(-1, u.shape[1])[order], first)


def _logits(x: np.ndarray, w: dict[str, np.ndarray], traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    fore = _forward(x, w["ef"], w["uf"], range(len(x)), traces and traces[0])
    back = _forward(x, w["eb"], w["ub"], range(len(x) - 1, -1, -1), traces and traces[1])
    states = np.concatenate([fore, back], axis=2)
    return states, states @ w["v"] + w["c"]


def _softmax(a: np.ndarray) -> np.ndarray:
    p = np.exp(a - a.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def loss_and_gradient(x: np.ndarray, y: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over all positions that hold a byte."""
    k, traces = w["uf"].shape[0], (_Trace(), _Trace())
    states, logits = _logits(x, w, traces)
    p, mask, rows = _softmax(logits), (x > 0)[:, :, None], np.arange(len(y))
    n = max(1, int(mask.sum()))
    loss = -float((np.log(p[:, rows, y] + 1e-9) * mask[:, :, 0]).sum()) / n
    d = p.copy()
    d[:, rows, y] -= 1
    d = (d * mask / n).astype(np.float32)
    grad = {name: np.zeros_like(v) for name, v in w.items()}
    grad["v"] = states.reshape(-1, 2 * k).T @ d.reshape(-1, d.shape[2])
    grad["c"] = d.sum(axis=(0, 1))
    back = d @ w["v"].T
    _backward(x, w["uf"], back[:, :, :k], traces[0], grad["ef"], grad["uf"])
    _backward(x, w["ub"], back[:, :, k:], traces[1], grad["eb"], grad["ub"])
    return loss, grad


class _Trace(list):
    """A list that is true when empty."""

    def __bool__(self) -> bool:
        return True


def fit(texts: Sequence[str], langs: Sequence[str], p: LangParams) -> LangModel:
    """Adam on equally many windows of each language, labelled at every position."""
    names, rng = sorted(set(langs)), np.random.default_rng(p.seed)
    by_lang = []
    for name in names:
        x, owner = cut([t for t, lang in zip(texts, langs) if lang == name], p.length)
        order = rng.permutation(x.shape[1])
        seen = pd.Series(owner[order]).groupby(owner[order]).cumcount().to_numpy() if len(order) else order
        by_lang.append(x[:, order[seen < p.windows]])
    by_lang, names = zip(*[(x, n) for x, n in zip(by_lang, names) if x.shape[1]]) if any(x.shape[1] for x in by_lang) else ((), ())
    k, q = p.hidden, max(1, len(names))
    w = {c: rng.normal(0, 0.4, (256, 3 * k)) for c in ("ef", "eb")} | {c: rng.normal(0, 0.3, (k, 3 * k)) for c in ("uf", "ub")}
    w = {c: v.astype(np.float32) for c, v in (w | {"v": rng.normal(0, 0.3, (2 * k, q)), "c": np.zeros(q)}).items()}
    m, s = ({c: np.zeros_like(v) for c, v in w.items()} for _ in range(2))
    for step in range(1, p.steps + 1 if len(names) > 1 else 1):
        y = rng.integers(0, q, p.batch)
        x = np.stack([by_lang[i][:, rng.integers(by_lang[i].shape[1])] for i in y], axis=1)
        _, grad = loss_and_gradient(x, y, w)
        for c, g in grad.items():
            m[c] = 0.9 * m[c] + 0.1 * g
            s[c] = 0.98 * s[c] + 0.02 * g * g
            rate = p.rate * (1 - step / (p.steps + 1))
            w[c] -= (rate * (m[c] / (1 - 0.9**step)) / (np.sqrt(s[c] / (1 - 0.98**step)) + 1e-8)).astype(np.float32)
    return LangModel(tuple(names), w, p.length)


def _run(x: np.ndarray, e: np.ndarray, u: np.ndarray, v: np.ndarray, order) -> np.ndarray:
    """What one direction adds to the logits of every position; `_forward` with buffers, and the gates' scale in the weights."""
    n, k = x.shape[1], u.shape[0]
    h, a, g = np.zeros((n, k), np.float32), np.empty((n, 3 * k), np.float32), np.empty((n, 3 * k), np.float32)
    z, r, c = (np.empty((n, k), np.float32) for _ in range(3))
    out = np.empty((len(x), n, v.shape[1]), np.float32)
    for t in order:
        np.take(e, x[t], axis=0, out=a, mode="clip")
        np.matmul(h, u, out=g)
        np.add(a[:, :k], g[:, :k], out=z)
        np.add(a[:, k : 2 * k], g[:, k : 2 * k], out=r)
        np.maximum(np.minimum(z, 1, out=z), 0, out=z)
        np.maximum(np.minimum(r, 1, out=r), 0, out=r)
        np.multiply(g[:, 2 * k :], r, out=c)
        c += a[:, 2 * k :]
        np.maximum(np.minimum(c, 1, out=c), -1, out=c)
        c -= h
        c *= z
        h += c
        np.matmul(h, v, out=out[t])
    return out


def probabilities(texts: Sequence[str | None], m: LangModel, block: int = 1024) -> np.ndarray:
    """For each text the mean over all its positions of the language probabilities."""
    w, k = m.weights, m.weights["uf"].shape[0]
    scaled = {c: v.copy() for c, v in w.items()}
    for c in ("ef", "eb", "uf", "ub"):
        scaled[c][:, : 2 * k] *= 0.25
    for c in ("ef", "eb"):
        scaled[c][:, : 2 * k] += 0.5
    x, owner = cut(texts, m.length)
    sums = np.zeros((len(texts), len(m.langs)))
    for at in range(0, x.shape[1], block):
        part = np.ascontiguousarray(x[:, at : at + block])
        p = _run(part, scaled["ef"], scaled["uf"], np.ascontiguousarray(w["v"][:k]), range(m.length))
        p += _run(part, scaled["eb"], scaled["ub"], np.ascontiguousarray(w["v"][k:]), range(m.length - 1, -1, -1))
        p += w["c"]
        np.exp(np.minimum(p, 60, out=p), out=p)
        p /= p.sum(axis=2, keepdims=True)
        p *= (part > 0)[:, :, None]
        windows = p.sum(axis=0)
        for j in range(len(m.langs)):
            sums[:, j] += np.bincount(owner[at : at + block], windows[:, j], len(texts))
    return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)


def train(docs: DataFrame, p: LangParams = LangParams()) -> LangModel:
    """Fits on a bounded sample of documents with a language outside the held-out fold, for each language those with the least hashes of their ids.

    Languages are counted first. The count tells below which hash some four times the wanted documents of a language lie; only those are ranked, so no
    task gets more, however many documents a language has. Ties of hash and id go by text. Null and empty texts, null languages and longer documents take no part, rows that
    repeat are one, and without any row nothing is learned.
    """
    known = docs.where(F.col("lang").isNotNull() & F.octet_length("text").between(1, p.sample_bytes) & (fold_of(F.col("doc_id")) != HELD_OUT)).select("doc_id", "lang")
    frequent = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(p.langs)
    # at most `langs` rows
    rows = {r["lang"]: r["n"] for r in frequent.collect()}
    if not rows:
        return fit([], [], p)
    each = min(p.docs, max(1, p.all_docs // len(rows)))
    below = docs.sparkSession.createDataFrame([(lang, min(1.0, 4.0 * each / n)) for lang, n in rows.items()], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    near = known.join(F.broadcast(below), "lang").where(place < F.col("share") * (1 << 30)).select("doc_id", "lang", place.alias("place"))
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))).where(F.col("nth") <= each)
    # at most `all_docs` rows, or one a language
    chosen = F.broadcast(ranked.select("doc_id", "lang").distinct())
    got = sorted(set(docs.where(F.octet_length("text") <= p.sample_bytes).select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).collect()))
    return fit([r.text for r in got], [r.lang for r in got], p)


def language(text: Column, model: LangModel) -> Column:
    """struct(lang_pred, score) of every whole text; `und` with score 0 if it is null, has no letter, or nothing was learned. Texts of any
    length are read whole, a megabyte or one text at a time; of equally likely languages the first in order of name counts; equal texts get equal results."""
    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts = s.tolist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model.langs else []
            turns, held = [[]], 0
            for i in some:  # about a megabyte at once
                if held > 1 << 20:
                    turns, held = [*turns, []], 0
                turns[-1].append(i)
                held += len(texts[i])
            for turn in turns:
                p = probabilities([texts[i] for i in turn], model)
                for i, row in zip(turn, p):
                    pred[i], score[i] = model.langs[int(row.argmax())], float(min(1.0, row.max()))
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return predict(text)
