"""Benchmark decontamination: a BM25 index of test items, searched with every passage by block-max WAND, and a check of both parts."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from adloom.llm.common import tidy

#: ASCII letters and digits and everything beyond ASCII make words.
BLANKED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class LeakParams:
    """A passage retrieves an item from `share` of the score on that the item has with itself. A leak also has `overlap` of the
    `gram`-word sequences of its question and of its answer. An index holds `shard_items` items and `shard_words` words at most."""

    share: float = 0.5
    overlap: float = 0.5
    gram: int = 3
    k1: float = 1.2
    b: float = 0.75
    block: int = 16
    shard_items: int = 20_000
    shard_words: int = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(BLANKED).split()


def pairs_of(words: list[bytes]) -> list[str]:
    """The terms of the index are pairs of neighbouring words: single common words would bring every passage near every item."""
    return [(first + b" " + second).decode() for first, second in zip(words, words[1:])]


def _grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Postings:
    """Items with the term and their impacts, in blocks of known last item and greatest impact."""

    items: list[int] = field(default_factory=list)
    impacts: list[float] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    greatest: list[float] = field(default_factory=list)
    bound: float = 0.0

    def close(self, block: int) -> None:
        for k in range(0, len(self.items), block):
            self.last.append(self.items[min(k + block, len(self.items)) - 1])
            self.greatest.append(max(self.impacts[k : k + block]))
        self.bound = max(self.greatest)


class Level:
    """The index of the items of one length class. Passages are `2 * stride` words, one every `stride` words, and no item is longer
    than a stride, so some passage holds all of an item. Impacts are shares of the item's score with itself."""

    def __init__(self, stride: int):
        self.stride, self.postings, self.bounds = stride, {}, np.zeros(0)


class LeakIndex:
    def __init__(self, items: list[tuple], df: dict[str, int], total: int, mean_words: float, p: LeakParams):
        """`items` has (item_id, question, answer); df (by term), total and mean_words are of all items, in this shard or not."""
        self.p, self.ids, self.grams = p, [i for i, _, _ in items], []
        self.word: dict[bytes, int] = {}
        term: dict[tuple[int, int], int] = {}
        self.levels: dict[int, Level] = {}
        idf = {t: log(1 + (total - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        for at, (_, question, answer) in enumerate(items):
            q, a = words_of(question), words_of(answer)
            words = q + a
            self.grams.append((_grams(q, p.gram), _grams(a, p.gram)))
            if len(words) < 2:
                continue
            norm = p.k1 * (1 - p.b + p.b * len(words) / mean_words)
            impact = {t: idf[t] * n * (p.k1 + 1) / (n + norm) for t, n in Counter(pairs_of(words)).items()}
            own = sum(impact.values())
            level = self.levels.setdefault(max(8, 1 << (len(words) - 1).bit_length()), None) or Level(max(8, 1 << (len(words) - 1).bit_length()))
            self.levels[level.stride] = level
            for t, x in impact.items():
                pair = tuple(self.word.setdefault(w, len(self.word)) for w in t.encode().split())
                entry = level.postings.setdefault(term.setdefault(pair, len(term)), Postings())
                entry.items.append(at)
                entry.impacts.append(x / own)
        codes = np.array([a * len(self.word) + b for a, b in term], np.int64)
        self.terms = np.argsort(codes)
        self.codes = codes[self.terms]
        for level in self.levels.values():
            level.bounds = np.zeros(len(term) + 1)  # the last one is for pairs that no item has
            for t, entry in level.postings.items():
                entry.close(p.block)
                level.bounds[t] = entry.bound

    def search(self, level: Level, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items that the terms score `least` or more for, by block-max WAND.

        Lists stand in order of their current item. The pivot is the first list at which the sum of bounds reaches `least`; no item before
        its current one can. If the block bounds at the pivot item do not reach `least` either, everything up to the nearest block end is
        skipped. Otherwise lists move up to the pivot item, and when all stand on it, it is scored.
        """
        least -= 1e-9
        found, lists = [], [[level.postings[t].items[0], level.postings[t], 0] for t in terms if t in level.postings]
        while lists:
            lists.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for i, (_, post, _) in enumerate(lists):
                bound += post.bound
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            block_bound, edge = 0.0, lists[pivot + 1][0] if pivot + 1 < len(lists) else None
            for _, post, _ in lists[: pivot + 1]:
                b = bisect_left(post.last, item)
                if b < len(post.last):
                    block_bound += post.greatest[b]
                    edge = post.last[b] + 1 if edge is None else min(edge, post.last[b] + 1)
            if block_bound < least:
                to = edge if edge is not None and edge > item else item + 1
                moving = lists[: pivot + 1]
            elif lists[0][0] == item:
                score = sum(post.impacts[k] for _, post, k in lists[: pivot + 1])
                if score >= least:
                    found.append((item, score))
                to, moving = item + 1, lists[: pivot + 1]
            else:
                to, moving = item, lists[:pivot]
            for x in moving:
                x[2] = bisect_left(x[1].items, to, x[2])
                x[0] = x[1].items[x[2]] if x[2] < len(x[1].items) else -1
            lists = [x for x in lists if x[0] >= 0]
        return found

    def leaks(self, text: str | None) -> list[tuple]:
        """(item_id, score, question_overlap, answer_overlap, first_word, n_words) of the best passage for each leaked item."""
        words, p, best = words_of(text), self.p, {}
        if len(words) < 2 or not len(self.codes):
            return []
        w = np.fromiter(map(self.word.get, words, repeat(-1)), np.int64, len(words))
        ids = np.full(len(words), -1)  # the term that starts at each word
        at = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0))
        code = w[at] * len(self.word) + w[at + 1]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[place] == code
        ids[at[known]] = self.terms[place[known]]
        for level in self.levels.values():
            sums = np.concatenate([[0.0], np.cumsum(level.bounds[ids])])
            start = np.arange(0, max(1, len(words) - level.stride), level.stride)
            end = np.minimum(start + 2 * level.stride, len(words))
            for k in np.flatnonzero(sums[end] - sums[start] >= p.share - 1e-9):  # bounds with repeats: no passage below can reach the share
                terms = np.unique(ids[start[k] : end[k] - 1])
                terms = terms[terms >= 0]
                if level.bounds[terms].sum() < p.share - 1e-9:
                    continue
                hits = self.search(level, terms.tolist(), p.share)
                grams = None
                for item, score in hits:
                    if item in best and best[item][1] >= score:
                        continue
                    grams = grams or {n: _exact_grams(words[start[k] : end[k]], n) for n in range(1, p.gram + 1)}
                    shares = [sum(g in grams[len(g)] for g in part) / len(part) if part else 1.0 for part in self.grams[item]]
                    if min(shares) >= p.overlap:
                        best[item] = (self.ids[item], score, *shares, int(start[k]), int(end[k] - start[k]))
        return [best[i] for i in sorted(best)]


def _exact_grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(n))))


def build_indexes(items: DataFrame, p: LeakParams = LeakParams()) -> Iterator[LeakIndex]:
    """One index after the other. Document frequencies and lengths are counted over all of `items` (item_id, question, answer) by Spark."""
    both = F.concat_ws(" ", "question", "answer")

    @F.pandas_udf("array<string>")
    def pairs(s: pd.Series) -> pd.Series:
        return s.map(lambda t: pairs_of(words_of(t)))

    known = items.where("item_id IS NOT NULL").select("item_id", F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"), pairs(both).alias("pairs"))
    stats = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("pairs") + 1), F.lit(0)).alias("words")).first()
    shards = max(1, ceil(stats.n / p.shard_items), ceil(stats.words / p.shard_words))
    df = known.select(F.explode(F.array_distinct("pairs")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for k in range(shards):
        mine = known.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == k)
        terms = mine.select(F.explode("pairs").alias("term")).distinct()
        counts = dict(df.join(terms, "term").select("term", "df").collect())
        rows = sorted((r.item_id, r.question, r.answer) for r in mine.select("item_id", "question", "answer").collect())
        yield LeakIndex(rows, counts, stats.n, max(1.0, stats.words / max(1, stats.n)), p)


def find_leaks(docs: DataFrame, items: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word, n_words: one row per row of `docs` and leaked item.

    Every passage of every whole text is a query. Narrow: the index, whose size is bounded by shards, is broadcast, and `docs` is
    read once per shard. Null and empty texts have no leaks, nor have items of fewer than two words; repeated items each leak; without items there are no rows.
    Other columns are ignored.
    """
    spark, out = docs.sparkSession, None
    kind = {f.name: f.dataType.simpleString() for f in [docs.schema["doc_id"], items.schema["item_id"]]}
    schema = f"doc_id {kind['doc_id']}, item_id {kind['item_id']}, score double, question_overlap double, answer_overlap double, first_word bigint, n_words bigint"
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    for index in build_indexes(items, p):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, *hit) for i, text in enumerate(batch.column(1)) for hit in shared.value.leaks(text.as_py())]
                at, *cols = zip(*rows) if rows else [()] * 7
                types = (item_type, pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types)]], names=[c.split(" ")[0] for c in schema.split(", ")])

        found = docs.select("doc_id", "text").mapInArrow(tidy(run), schema)
        out = found if out is None else out.unionByName(found)
    return out


def leaked(text: Column, index: LeakIndex, spark) -> Column:
    """Whether a whole text leaks any item of the index."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: bool(shared.value.leaks(t))).astype(bool)

    return test(text)


def drop_leaks(docs: DataFrame, items: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """`docs` without those that leak an item, all columns kept."""
    for index in build_indexes(items, p):
        docs = docs.where(~leaked(F.col("text"), index, docs.sparkSession))
    return docs


def split_items(benchmark: DataFrame) -> DataFrame:
    """item_id, question, answer of `benchmark` (item_id, text): the answer is the last sentence, or the last third of the words if there is but one."""
    t = F.trim("text")
    pattern = r"(?s)^(.*[.!?])\s+(\S.*?)$"
    q, a = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, r"(?s)^.*[.!?]\s+(\S.*?)$", 1)
    w = F.split(t, r"\s+")
    cut = F.greatest(F.lit(1), (F.size(w) * 2 / 3).cast("int"))
    whole = F.struct(F.array_join(F.slice(w, F.lit(1), cut), " ").alias("question"), F.array_join(F.slice(w, cut + 1, F.size(w)), " ").alias("answer"))
    parts = F.when(q != "", F.struct(q.alias("question"), a.alias("answer"))).otherwise(whole)
    return benchmark.select("item_id", parts.alias("p")).select("item_id", "p.question", "p.answer")
