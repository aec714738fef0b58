"""Alignment of the tokens of two tokenizers over the same bytes, by fragments that compose associatively.

A fragment describes a byte range: the tokens before its first common token end (open prefix), the groups between common ends
(closed), and the tokens after the last one (open suffix). Two neighbouring fragments make one: what the left leaves open and what the
right opens with become one closed group. So ranges of a document can be read anywhere and joined in a tree.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.bpe import WORDS, byte_symbols
from adloom.llm.common import stored, text_batches, tidy

#: A space between two word characters: neither tokenizer lets a token reach over it from the left.
CUT = re.compile(r"(?<=\w) (?=\w)")
#: Runs of white space on which the fast library gives up; such texts go to the slower one, with the same ids.
LONG_SPACE = re.compile(r"\s{400}")
#: Links of a group are listed one by one up to so many, beyond that as distinct ids with their counts.
LISTED = 4096


@dataclass(frozen=True)
class AlignParams:
    """Documents beyond `segment` bytes are cut up and spread; `leaf` is the byte range of one first fragment; `fan_in` fragments are
    composed per step; `batch` bytes are worked on at once; so many of the most frequent id pairs are sent to all executors."""

    segment: int = 1 << 18
    leaf: int = 1 << 16
    fan_in: int = 16
    batch: int = 1 << 20
    hot_pairs: int = 1 << 20


class Side:
    """The bytes of a tokenizer's tokens."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def ends(self, ids: np.ndarray, data: np.ndarray) -> np.ndarray | None:
        """Where the tokens end, or None if their bytes are not `data`."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        if not len(ids) or ends[-1] != len(data):
            return None
        joined = self.blob[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(len(data))]
        return ends if np.array_equal(joined, data) else None


class TokenPair:
    """Both tokenizers, their token bytes, and the spelling of their ids."""

    def __init__(self, byte_level_file: str, piece_file: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(byte_level_file, encoding="utf-8") as f:
            spec = json.load(f)
        symbol, special = byte_symbols(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(symbol[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.slow = Tokenizer.from_file(byte_level_file)
        self.slow.encode_special_tokens = True
        self.slow.no_truncation()
        self.slow.no_padding()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in pairs]
        # ids in the order of the merges may serve as ranks
        self.fast = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if made == sorted(made) else None
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.pieces = pieces
        n_a = 1 + max(spec["model"]["vocab"].values())
        by_id = {i: t for t, i in ranks.items()}
        self.a = Side([by_id.get(i, b"") for i in range(n_a)])
        texts = [pieces.id_to_piece(i) for i in range(pieces.vocab_size())]
        self.b = Side([bytes([int(t[3:5], 16)]) if pieces.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(texts)])
        self.space = (n_a, len(texts))
        spelled = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], object)
        self.a_inner, self.a_last = spelled(n_a, ","), spelled(n_a, "|")
        self.b_inner, self.b_last = spelled(len(texts), ","), spelled(len(texts), ";")

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """ids and ends of a space and `text` by A and by B; None if either loses bytes."""
        spaced = " " + text
        data = np.frombuffer(spaced.encode(), np.uint8)
        fast = self.fast and not LONG_SPACE.search(spaced)
        a = np.array(self.fast.encode_ordinary(spaced) if fast else self.slow.encode(spaced, add_special_tokens=False).ids, np.int64)
        b = np.array(self.pieces.encode(text), np.int64)
        a_ends = self.a.ends(a, data)
        b_ends = None if a_ends is None else self.b.ends(b, data)
        return None if b_ends is None else (a, a_ends, b, b_ends)


@cache
def token_pair(byte_level_file: str, piece_file: str) -> TokenPair:
    """One per worker process; both files are on every machine."""
    return TokenPair(byte_level_file, piece_file)


NONE = np.array([], np.int64)


@dataclass(frozen=True)
class Fragment:
    """A byte range of one document. Without a cut all its tokens are in the prefix."""

    cut: bool
    prefix: tuple[np.ndarray, np.ndarray]
    closed: str
    n_groups: int
    n_links: int
    pairs: np.ndarray
    times: np.ndarray
    suffix: tuple[np.ndarray, np.ndarray]
    n_a: int
    n_b: int
    lossy: bool = False


def tally(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their times."""
    if not len(keys):
        return NONE, NONE
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first)


def crossed(a: np.ndarray, b: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs of one group and how often each occurs; as many as distinct ids, however long the group is."""
    (a, x), (b, y) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return (a[:, None] * n_b + b).ravel(), (x[:, None] * y).ravel().astype(np.int64)


def compose(x: Fragment, y: Fragment, n_b: int) -> Fragment:
    """The fragment of two neighbouring ranges. Associative."""
    n_a_b = {"n_a": x.n_a + y.n_a, "n_b": x.n_b + y.n_b, "lossy": x.lossy or y.lossy}
    joined = lambda p, q: (np.concatenate([p[0], q[0]]), np.concatenate([p[1], q[1]]))
    if not x.cut:
        return replace(y, prefix=joined(x.prefix, y.prefix), **n_a_b)
    if not y.cut:
        return replace(x, suffix=joined(x.suffix, y.prefix), **n_a_b)
    a, b = joined(x.suffix, y.prefix)
    keys, times = crossed(a, b, n_b)
    pairs, times = tally(np.concatenate([x.pairs, keys, y.pairs]), np.concatenate([x.times, times, y.times]))
    group = ",".join(map(str, a)) + "|" + ",".join(map(str, b)) + ";" if len(a) or len(b) else ""
    return Fragment(
        True, x.prefix, x.closed + group + y.closed, x.n_groups + y.n_groups + bool(group), x.n_links + y.n_links + len(a) * len(b),
        pairs, times, y.suffix, **n_a_b,
    )


def compose_all(parts: list[Fragment], n_b: int) -> Fragment:
    """A tree over neighbours."""
    while len(parts) > 1:
        parts = [compose(parts[i], parts[i + 1], n_b) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


LOSSY = Fragment(True, (NONE, NONE), "", 0, 0, NONE, NONE, (NONE, NONE), 0, 0, True)


def leaves(v: TokenPair, texts: list[str], opens: list[bool], leaf: int) -> list[Fragment]:
    """One fragment per text (a document, or part of one if it does not open it), made of leaves of `leaf` bytes; one pass over all."""
    read = [v.encode(t) for t in texts]
    kept = [k for k, r in enumerate(read) if r is not None]
    out = [LOSSY] * len(texts)
    if not kept:
        return out
    sizes = np.array([read[k][1][-1] for k in kept], np.int64)
    base = np.cumsum(sizes) - sizes
    a, b = (np.concatenate([read[k][c] for k in kept]) for c in (0, 2))
    a_ends, b_ends = (np.concatenate([read[k][c] + at for k, at in zip(kept, base)]) for c in (1, 3))
    edges, owner = [], []
    for k, at, size in zip(kept, base.tolist(), sizes.tolist()):
        edges += [*range(at + leaf, at + size, leaf), at + size]
        owner += [k] * (len(edges) - len(owner))
    edges = np.array(edges, np.int64)
    opening = np.array([opens[k] and (i == 0 or owner[i - 1] != k) for i, k in enumerate(owner)])

    # groups lie between common ends; the last text ends with one, so every token has a group
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    a_stop, b_stop = np.searchsorted(a_ends, common, "right"), np.searchsorted(b_ends, common, "right")
    a_from, b_from = np.concatenate([[0], a_stop[:-1]]), np.concatenate([[0], b_stop[:-1]])
    n_a, n_b = a_stop - a_from, b_stop - b_from
    words = np.empty(len(a) + len(b), object)
    at = np.arange(len(a))
    words[at + b_from[a_group]] = np.where(at == a_stop[a_group] - 1, v.a_last[a], v.a_inner[a])
    at = np.arange(len(b))
    words[at + a_stop[b_group]] = np.where(at == b_stop[b_group] - 1, v.b_last[b], v.b_inner[b])

    group_leaf = np.searchsorted(edges, common)
    a_hi, b_hi, c_hi = (np.searchsorted(x, edges, "right") for x in (a_ends, b_ends, common))
    a_lo, b_lo, c_lo = (np.concatenate([[0], x[:-1]]) for x in (a_hi, b_hi, c_hi))
    closed = opening[group_leaf] | (np.arange(len(common)) != c_lo[group_leaf])
    links = np.where(closed, n_a * n_b, 0)
    total = np.concatenate([[0], np.cumsum(links)])
    span, wide = v.space[1], v.space[0] * v.space[1]
    some = np.flatnonzero(closed & (links <= LISTED))
    rep = np.repeat(some, links[some])
    nth = np.arange(len(rep)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
    keys = [group_leaf[rep] * wide + a[a_from[rep] + nth // n_b[rep]] * span + b[b_from[rep] + nth % n_b[rep]]]
    times = [np.ones(len(rep), np.int64)]
    for g in np.flatnonzero(closed & (links > LISTED)):
        k, t = crossed(a[a_from[g] : a_stop[g]], b[b_from[g] : b_stop[g]], span)
        keys.append(k + group_leaf[g] * wide)
        times.append(t)
    keys, times = tally(np.concatenate(keys), np.concatenate(times))
    key_at = np.searchsorted(keys, np.arange(len(edges) + 1) * wide)

    made: dict[int, list[Fragment]] = {}
    for i, k in enumerate(owner):
        first, last = int(c_lo[i]) + (not opening[i]), int(c_hi[i])
        cut = bool(opening[i]) or last > c_lo[i]
        if not cut:
            head, tail = (int(a_hi[i]), int(b_hi[i])), (int(a_hi[i]), int(b_hi[i]))
        else:
            head = (int(a_lo[i]), int(b_lo[i])) if opening[i] else (int(a_stop[first - 1]), int(b_stop[first - 1]))
            tail = (int(a_stop[last - 1]), int(b_stop[last - 1])) if last > c_lo[i] else head
        n = max(0, last - first)
        mine = slice(key_at[i], key_at[i + 1])
        made.setdefault(k, []).append(Fragment(
            cut, (a[a_lo[i] : head[0]], b[b_lo[i] : head[1]]), "".join(words[head[0] + head[1] : tail[0] + tail[1]].tolist()) if n else "",
            n, int(total[last] - total[first]) if n else 0, keys[mine] - i * wide, times[mine],
            (a[tail[0] : a_hi[i]], b[tail[1] : b_hi[i]]), int(a_hi[i] - a_lo[i]), int(b_hi[i] - b_lo[i]),
        ))
    for k, parts in made.items():
        out[k] = compose_all(parts, span)
    return out


def split_text(text: str, size: int) -> Iterator[str]:
    """Pieces of about `size` characters between single spaces that stand between word characters; those spaces go.

    Each piece with a space before it gives the tokens that it has inside the whole. Text without such a space stays whole.
    """
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


FIELDS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<bigint>"
OPEN = "cut boolean, lossy boolean, prefix_a array<bigint>, prefix_b array<bigint>, suffix_a array<bigint>, suffix_b array<bigint>"


def _finished(f: Fragment, hashed: bool) -> tuple:
    """The row of a whole document. A lossy one has no tokens."""
    if f.lossy or not f.n_a:
        return (0, 0, 0, 0, "", NONE, NONE)
    groups = f.closed[:-1]
    return (f.n_a, f.n_b, f.n_groups, f.n_links, hashlib.sha256(groups.encode()).hexdigest() if hashed else groups, f.pairs, f.times)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
    return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]


def _open_columns(parts: list[Fragment]) -> list[pa.Array]:
    lists = pa.list_(pa.int64())
    closed = _columns([(f.n_a, f.n_b, f.n_groups, f.n_links, f.closed, f.pairs, f.times) for f in parts])
    edge = [pa.array([x(f) for f in parts], lists) for x in (lambda f: f.prefix[0], lambda f: f.prefix[1], lambda f: f.suffix[0], lambda f: f.suffix[1])]
    return [*closed, pa.array([f.cut for f in parts], pa.bool_()), pa.array([f.lossy for f in parts], pa.bool_()), *edge]


def _fragment(r: dict) -> Fragment:
    ids = lambda name: np.array(r[name], np.int64)
    return Fragment(
        r["cut"], (ids("prefix_a"), ids("prefix_b")), r["groups"], r["n_groups"], r["n_links"], ids("pairs"), ids("times"),
        (ids("suffix_a"), ids("suffix_b")), r["n_a"], r["n_b"], r["lossy"],
    )


def align(docs: DataFrame, files: tuple[str, str], p: AlignParams = AlignParams(), hashed: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: row (a key of its own), doc_id, n_a, n_b, n_groups, n_links, groups, pairs and times.

    `files`: the byte-level vocabulary (A) and the piece model (B). `groups` is `a1,a2|b1;a3|b2,b3`, or with `hashed` its SHA-256.
    `pairs` holds the distinct linked ids as A * size of B + B, ascending, `times` how often each occurs.
    Null and empty text, and text that either tokenizer does not give back byte by byte, has no tokens: zeros, '' and empty lists.
    Strings of special tokens are plain text. Repeated rows and ids are rows of their own; other columns do not get in the way; an
    empty table gives an empty result. A document beyond `segment` bytes is cut between words, its parts are read by any task, and
    their fragments are composed `fan_in` at a time; one without a space between word characters is read as one part. Results do not depend on
    the parameters. A group of any length costs its distinct ids, not its links.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > p.segment, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = token_pair(*files)
        for batch, texts in text_batches(batches, 2, p.batch):
            made = leaves(v, [t for t in texts if t], [True] * len(texts), p.leaf)
            found = iter(made)
            done = [_finished(next(found) if t else LOSSY, hashed) for t in texts]
            yield pa.record_batch([batch.column(0), batch.column(1), *_columns(done)], names=["row", "doc_id", *NAMES])

    short = rows.where(~is_long).mapInArrow(tidy(whole), f"row bigint, doc_id {id_type}, {FIELDS}")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for n, part in enumerate(split_text(batch.column(2)[k].as_py(), p.segment)):
                    yield pa.record_batch([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([n], pa.int64()), pa.array([part], pa.string())], names=["row", "doc_id", "part", "text"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = token_pair(*files)
        for batch, texts in text_batches(batches, 3, p.batch):
            parts = leaves(v, texts, [n == 0 for n in batch.column(2).to_pylist()], p.leaf)
            yield pa.record_batch([*batch.columns[:3], *_open_columns(parts)], names=["row", "doc_id", "part", *NAMES, *OPEN_NAMES])

    schema = f"row bigint, doc_id {id_type}, part bigint, {FIELDS}, {OPEN}"
    # the two scans number rows on their own, so the long ones take the negative numbers
    parts = rows.where(is_long).withColumn("row", -1 - F.col("row")).mapInArrow(cut_up, f"row bigint, doc_id {id_type}, part bigint, text string")
    parts = stored(stored(parts, "align-parts").repartition("row", "part").mapInArrow(tidy(read), schema), "align-fragments")
    last = parts.agg(F.max("part")).first()[0] or 0

    def join(table: pa.Table) -> pa.Table:
        got = sorted(table.to_pylist(), key=lambda r: r["part"])
        n_b = token_pair(*files).space[1]
        made = compose_all([_fragment(r) for r in got], n_b)
        head = table.slice(0, 1)
        return pa.table([head.column("row"), head.column("doc_id"), pa.array([got[0]["part"] // p.fan_in], pa.int64()), *_open_columns([made])], names=["row", "doc_id", "part", *NAMES, *OPEN_NAMES])

    while last > 0:
        parts = stored(parts.groupBy("row", F.floor(F.col("part") / p.fan_in).alias("step")).applyInArrow(join, schema), "align-joined")
        last //= p.fan_in

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_finished(_fragment(r), hashed) for r in batch.to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), *_columns(done)], names=["row", "doc_id", *NAMES])

    return short.unionByName(parts.mapInArrow(finish, short.schema))


NAMES = [f.split()[0] for f in FIELDS.split(", ")]
OPEN_NAMES = [f.split()[0] for f in OPEN.split(", ")]


def link_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, docs (rows that hold the pair linked) and best (whether no pair of the same A id has more); every row of `aligned` counts."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = stored(counts.withColumn("a", F.expr(f"pair div {n_b}")), "align-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return stored(counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "align-best")


def score_links(aligned: DataFrame, n_b: int, p: AlignParams = AlignParams()) -> DataFrame:
    """`aligned` without its lists, with n_best and count_sum over the links of a row.

    The most frequent pairs, `hot_pairs` at most, are sent to all executors, which also takes the skew out of the rest; the rest is joined by shuffle.
    Links are weighed by how often they occur; rows without links have zeros.
    """
    told = link_counts(aligned, n_b)
    # powers of two of the counts: the least power beyond which the pairs fit
    sizes = told.groupBy(F.floor(F.log2("docs")).alias("power")).count().orderBy(F.desc("power")).collect()
    fits, power = 0, 64
    for r in sizes:
        fits += r["count"]
        if fits > p.hot_pairs:
            break
        power = r["power"]
    is_hot = F.floor(F.log2("docs")) >= power
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    n_best: Column = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    count_sum = F.sum(F.col("docs") * F.col("times")).alias("count_sum")
    met = links.join(F.broadcast(told.where(is_hot)), "pair", "left")
    sums = met.groupBy("row").agg(n_best, count_sum)
    if fits > p.hot_pairs:
        rare = links.join(F.broadcast(told.where(is_hot).select("pair")), "pair", "left_anti").join(told.where(~is_hot), "pair")
        sums = sums.unionByName(rare.groupBy("row").agg(n_best, count_sum)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return aligned.drop("pairs", "times").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups")


def align_corpus(docs: DataFrame, files: tuple[str, str], p: AlignParams = AlignParams(), hashed: bool = False) -> DataFrame:
    """`align` and `score_links` together, the alignment computed once."""
    n_b = token_pair(*files).space[1]
    return score_links(stored(align(docs, files, p, hashed), "aligned"), n_b, p)
