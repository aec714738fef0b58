"""Near-duplicate groups: MinHash bands for candidates, signatures and full sets to confirm, star contraction for components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import free_name, stored, text_batches, tidy


@dataclass(frozen=True)
class NearParams:
    """Sets of `words`-word shingles are linked from `percent` % Jaccard similarity on. `hashes` minima make `bands` bands; a linked pair
    shares none with probability (1 - 0.75 ** 4) ** 32 = 5e-6 at most. `block` bounds what one comparison holds."""

    words: int = 5
    percent: int = 75
    hashes: int = 128
    bands: int = 32
    first_bands: int = 4
    block: int = 256
    seed: int = 20_011

    @property
    def band_bytes(self) -> int:
        return 4 * self.hashes // self.bands

    @property
    def least_equal(self) -> int:
        """Equal minima that a linked pair has, but for 4.5 standard errors."""
        p = self.percent / 100
        return int(self.hashes * p - 4.5 * (self.hashes * p * (1 - p)) ** 0.5)


def shingle_set(text: str | None, p: NearParams) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it is shorter than one; none without words."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and exactly the blanks x20 and x09-x0D
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(p.words, len(words))
    odd = np.random.default_rng(p.seed).integers(0, 2**63, p.words, np.uint64) * np.uint64(2) + np.uint64(1)
    s = np.full(len(h) - n + 1, np.uint64(n) << np.uint64(56))
    for j in range(n):
        s += h[j : len(h) - n + 1 + j] * odd[j]
    s ^= s >> np.uint64(29)
    s *= np.uint64(0xBF58476D1CE4E5B9)  # fixed value: multiplier of a published 64-bit mixer
    s ^= s >> np.uint64(32)
    return np.unique(s)


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _hashers(p: NearParams) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed + 1)
    return rng.integers(0, 2**63, (p.hashes, 1), np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, (p.hashes, 1), np.uint64)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """The upper halves of the minima of a * x + b modulo 2 ** 64."""
    low = None
    for k in range(0, len(s), 2048):
        part = (s[None, k : k + 2048] * a + b).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def sketches(docs: DataFrame, p: NearParams) -> DataFrame:
    """doc_id, n, key (of the set), sig."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _hashers(p)
        for batch in batches:
            n, key, sig = [], [], []
            for value in batch.column(1):
                s = shingle_set(value.as_py(), p)
                n.append(len(s))
                key.append(set_key(s) if len(s) else None)
                sig.append(signature(s, a, b) if len(s) else None)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n", "key", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, n bigint, key binary, sig binary")


def shingle_sets(docs: DataFrame, p: NearParams) -> DataFrame:
    """id, key, set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, 1, 1 << 22):
            sets = [shingle_set(t, p) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())], names=["id", "key", "set"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).mapInArrow(tidy(run), "id bigint, key binary, set binary")


def _filtered(pairs: DataFrame, test) -> DataFrame:
    """Those (a, b) of pairs (a, b, x, y) whose binary values x and y pass the test."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [test(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "x", "y").mapInArrow(tidy(run), "a bigint, b bigint")


def _with(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(a, b, x, y): the values of both ends."""
    left = values.select(F.col("id").alias("a"), F.col(value).alias("x"))
    right = values.select(F.col("id").alias("b"), F.col(value).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def linked(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two full sets reach the similarity."""
    s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = np.concatenate([s, t])
    both.sort(kind="stable")
    inter = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * inter >= percent * (len(both) - inter)


def sets_of(ids: DataFrame, docs: DataFrame, keys: DataFrame, p: NearParams) -> DataFrame:
    """id, key, set of the given ids only, made anew from their texts. `keys`: id, key."""
    wanted = stored(keys.join(ids, "id", "left_semi"), "near-wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return stored(shingle_sets(texts, p).join(wanted, ["id", "key"], "left_semi"), "near-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, keys: DataFrame, p: NearParams) -> DataFrame:
    """The links among candidate pairs, by their full sets."""
    sets = sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), docs, keys, p)
    percent = p.percent
    return _filtered(_with(pairs, sets, "set"), lambda x, y: linked(x, y, percent)).distinct()


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in links (a, b), by alternating large-star and small-star.

    Each step is written to the shared folder. Minima are combined before they meet their edges, so that a hub is no more than
    a skewed join, whose two sides are both exchanged and can be split. Ends when a round changes nothing.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        # large: every neighbour above the node goes to the least one; small: every neighbour below the node, and the node itself
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        near = both if large else both.where("v < u")
        least = stored(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "near-least")
        moved = near.join(least, "u")
        if large:
            out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return stored(out.where("a != b").distinct(), "near-edges")

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "near-edges")
    before, now = None, state(edges)
    while now != before:
        edges = star(star(edges, True), False)
        before, now = now, state(edges)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots).distinct()


def _crossing(members: DataFrame, buckets: DataFrame, comp: DataFrame, sigs: DataFrame, docs: DataFrame, p: NearParams) -> DataFrame:
    """Links (a, b) between documents that share a bucket and lie in different components; `sigs`: id, key, sig.

    In a bucket, all but the members of its most frequent component are compared with every member, in units of a block of
    the former and a part of the latter: by signature first, then by the full sets, which come along. Only links leave a unit, and for each
    document one link to each component, as further ones join nothing new.
    """
    placed = members.join(buckets.where("n > 2").select("h"), "h", "left_semi").join(comp, "id", "left").select("h", "id", F.coalesce("component", "id").alias("component"))
    placed = stored(placed, "near-placed")
    per = placed.groupBy("h", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("h").agg(F.max(F.struct("n", "component")).alias("big"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    blocks = lambda n: F.ceil(n / p.block).cast("int")
    mixed = stored(mixed.select("h", F.col("big.component").alias("big"), blocks(F.col("n") - F.col("big.n")).alias("n_i"), blocks(F.col("n")).alias("n_p")), "near-mixed")
    mixed_rows = placed.join(mixed, "h")
    sets = sets_of(mixed_rows.select("id").distinct(), docs, sigs.select("id", "key"), p)
    rows = mixed_rows.join(sigs, "id").join(sets, ["id", "key"])

    def spot(n: Column) -> Column:
        return F.pmod(F.xxhash64("id"), n).cast("int")

    def unit(first: bool) -> DataFrame:
        chosen = rows.where("component != big") if first else rows
        other, own = ("n_p", spot(F.col("n_i"))) if first else ("n_i", spot(F.col("n_p")))
        far = chosen.withColumn("own", own).withColumn("far", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, part = ("own", "far") if first else ("far", "own")
        return far.select("h", F.col(i).alias("i"), F.col(part).alias("p"), F.lit(first).alias("first"), "id", "component", "sig", "set")

    least, hashes, percent = p.least_equal, p.hashes, p.percent

    def near(rows_: list[dict]) -> Iterator[tuple[int, int]]:
        first = [r for r in rows_ if r["first"]]
        rest = [r for r in rows_ if not r["first"]]
        if not first or not rest:
            return
        sig = np.frombuffer(b"".join(r["sig"] for r in rest), "<u4").reshape(-1, hashes)
        comp_ = np.array([r["component"] for r in rest])
        for r in first:
            other = np.flatnonzero(comp_ != r["component"])
            equal = (sig[other] == np.frombuffer(r["sig"], "<u4")).sum(axis=1)
            joined = set()
            for k in other[np.argsort(-equal, kind="stable")][: int((equal >= least).sum())].tolist():
                if comp_[k] not in joined and linked(r["set"], rest[k]["set"], percent):
                    joined.add(comp_[k])
                    yield r["id"], rest[k]["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, out = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["h"], row["i"], row["p"]) != key:
                    out += near(held)
                    held, key = [], (row["h"], row["i"], row["p"])
                held.append(row)
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
            out = []
        out += near(held)
        yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    units = unit(True).unionByName(unit(False)).repartition("h", "i", "p").sortWithinPartitions("h", "i", "p")
    return units.mapInArrow(tidy(run), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id integer, text; other columns are ignored).

    1. Documents with one set are represented by the least of their ids; from here on only these take part.
    2. Bands of the signature deal representatives into buckets. In the first bands everyone is compared with the least of the bucket, first
       by signature, then by the full sets; the links give components. Then the same in all bands, but only where the least is in another
       component: a large group, which has another least in each band, is not compared over and over.
    3. Members of one bucket that ended up in different components are compared too (`_crossing`), so no link that the bands
       show is missed, while members of one component, however many, are never paired with each other.

    Null or empty text has no shingles and is linked with nothing. Rows that repeat a doc_id are one document with several texts.
    A null doc_id is linked with nothing, has no component and is kept. An empty table gives no rows.
    """
    made = stored(sketches(docs, p), "near-sketches")
    usable = made.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = usable.groupBy("key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    shared = stored(classes.where("copies > 1").select("key", "id"), "near-classes")
    member = stored(usable.select("doc_id", "key").join(shared, "key").where("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct(), "near-members")
    reps = usable.join(member.select(F.col("a").alias("doc_id")), "doc_id", "left_anti").select(F.col("doc_id").alias("id"), "key", "sig").dropDuplicates(["id", "key"])

    band = F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * p.band_bytes + 1, F.lit(p.band_bytes))))
    banded = reps.select("id", F.posexplode(band).alias("band", "h"))
    buckets = stored(banded.groupBy("h").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "near-buckets")
    members = stored(banded.join(buckets.select("h", "least"), "h"), "near-bucketed")
    sigs = stored(reps.join(members.select("id").distinct(), "id", "left_semi"), "near-signatures")
    keys = sigs.select("id", "key")

    least = p.least_equal

    def near(x: bytes, y: bytes) -> bool:
        return int(np.count_nonzero(np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4"))) >= least

    def stars(of: DataFrame) -> DataFrame:
        pairs = of.where("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
        close = stored(_filtered(_with(pairs, sigs, "sig"), near), "near-pairs")
        return stored(confirmed(close, docs, keys, p), "near-links")

    known = stars(members.where(F.col("band") < p.first_bands))
    comp = stored(components(known), "near-components")
    placed = members.where("id != least").join(comp, "id", "left").withColumnRenamed("component", "own")
    placed = placed.join(comp.select(F.col("id").alias("least"), F.col("component").alias("other")), "least", "left")
    known = known.union(stars(placed.where(F.coalesce("own", "id") != F.coalesce("other", "least"))))
    comp = stored(components(known), "near-components")
    known = known.union(stored(_crossing(members.select("h", "id"), buckets, comp, sigs, docs, p), "near-links"))
    comp = stored(components(known.union(member)), "near-components")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return made.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")
    )


def drop_near_copies(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """`docs` with one document of each group of near copies, all columns kept, whatever their names. Rows without id or without words stay; an
    empty table stays empty."""
    gone, name = stored(near_duplicates(docs, p).where("NOT kept").select("doc_id").distinct(), "near-dropped"), free_name("_gone", docs)
    return docs.join(gone.withColumnRenamed("doc_id", name), F.col("doc_id") == F.col(name), "left_anti")
