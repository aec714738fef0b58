"""Cheapest repair of conversations by a parallel Viterbi search whose chunks converge in rank.

The roles of a repaired conversation are nothing, or an optional system turn and then user and assistant in turn. The costs of the
cheapest repair of the rest of a conversation, one per state of that grammar, are computed backwards. Chunks of a conversation start from
a guess of what follows them; where the true vector differs from the guess by more than a constant, the chunk runs again. Once all
chunks agree, their backward costs drive the forward trace of the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import stored

# The costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
VISIBLE = r"[^\x20\x09-\x0D]"

# states: nothing yet, after the system turn, after a user turn, after an assistant turn
STATES, ENDS = 4, (0, 3)
S, U, A, OTHER = range(4)
#: state after a turn of role s, u or a, or -1
NEXT = np.array([[1, 2, -1], [-1, 2, -1], [-1, -1, 3], [-1, 2, -1]])
#: what an insertion or a new role makes of a state: the only role that may follow, and so the only choice there is
FORCED = np.array([2, 2, 3, 2])
FAR = 1 << 40
OK, BLANK, DUPLICATE, CUT_OFF = range(4)


@dataclass(frozen=True)
class RepairParams:
    """Turns of a conversation are dealt in chunks of at most 2 ** `chunk_bits` rows."""

    chunk_bits: int = 12


def insertions(v: np.ndarray) -> np.ndarray:
    """Costs before a turn, when up to two turns may be inserted there; more never pay, as two lead back to the same state."""
    once = np.minimum(v, v[..., FORCED] + INSERT)
    return np.minimum(once, once[..., FORCED] + INSERT)


#: Costs after the last turn.
LAST = insertions(np.array([0 if q in ENDS else FAR for q in range(STATES)], np.int64))


def step(v: np.ndarray, role: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """Costs before one turn (of every row of `v`) without insertions, from the costs `v` after it."""
    out = v + DELETE
    stays = (fault == OK) | (fault == CUT_OFF)
    extra = np.where(fault == CUT_OFF, TRUNCATED, 0)[:, None]
    far = np.full((len(v), 1), FAR)
    padded = np.concatenate([v, far], axis=1)
    table = np.concatenate([NEXT, np.full((STATES, 1), -1)], axis=1)
    kept = np.take_along_axis(padded, table.T[role], axis=1) + extra
    new_role = v[:, FORCED] + REROLE + extra
    return np.where(stays[:, None], np.minimum(out, np.minimum(kept, new_role)), out)


def symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Roles and faults of a chunk; one letter from `a` on per turn, four faults a role."""
    code = np.frombuffer(text.encode(), np.uint8) - 97
    return code >> 2, code & 3


def backward(chunks: list[str], after: np.ndarray, before: np.ndarray | None = None, old: np.ndarray | None = None) -> np.ndarray:
    """The vector at the start of each chunk, insertions included, from the vector after it; all chunks advance together.

    With the vectors `old` after the chunks and `before` them of an earlier run, a chunk stops as soon as both runs differ by a constant only.
    """
    size = np.array([len(c) for c in chunks])
    read = [symbols(c) for c in chunks]
    out = np.array(after, np.int64)
    was = None if old is None else np.array(old, np.int64)
    for back in range(1, int(size.max(initial=0)) + 1):
        live = np.flatnonzero(size >= back)
        if not len(live):
            break
        role = np.array([read[k][0][size[k] - back] for k in live])
        fault = np.array([read[k][1][size[k] - back] for k in live])
        out[live] = insertions(step(out[live], role, fault))
        if was is not None:
            was[live] = insertions(step(was[live], role, fault))
            apart = out[live] - was[live]
            same = (apart == apart[:, :1]).all(axis=1)
            done = live[same]
            out[done] = before[done] + apart[same][:, :1]
            size[done] = 0
    return out


def trace(chunk: str, after: np.ndarray, last: bool) -> list[tuple[str, int]]:
    """Per state at the start: the least audit of the cheapest repair, and the state at the end.

    Letters are tried in ASCII order. State and letter determine what follows, so taking the least one is taking the least audit.
    """
    role, fault = symbols(chunk)
    roles, faults, n = role.tolist(), fault.tolist(), len(chunk)
    follow, forced = NEXT.tolist(), FORCED.tolist()
    cost = [list(map(int, after))]
    for r, f in zip(reversed(roles), reversed(faults)):
        v, extra = cost[-1], TRUNCATED if f == CUT_OFF else 0
        best = [x + DELETE for x in v]
        if f == OK or f == CUT_OFF:
            for q in range(STATES):
                kept = follow[q][r] if r != OTHER else -1
                best[q] = min(best[q], v[forced[q]] + REROLE + extra, v[kept] + extra if kept >= 0 else FAR)
        for _ in range(2):
            best = [min(x, best[to] + INSERT) for x, to in zip(best, forced)]
        cost.append(best)
    cost.reverse()
    out = []
    for state in range(STATES):
        i, q, audit = 0, state, []
        while i < n or (last and cost[n][q]):
            here, to = cost[i][q], forced[q]
            if i < n and cost[i + 1][q] + DELETE == here:
                audit.append("D")
                i += 1
            elif cost[i][to] + INSERT == here:
                audit.append("I")
                q = to
            else:
                extra = TRUNCATED if faults[i] == CUT_OFF else 0
                kept = follow[q][roles[i]] if roles[i] != OTHER else -1
                if kept >= 0 and cost[i + 1][kept] + extra == here:
                    audit.append("K")
                    q = kept
                else:
                    audit.append("R")
                    q = to
                i += 1
        out.append(("".join(audit), q))
    return out


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).reshape(-1, STATES)


def _lists(v: np.ndarray) -> pa.Array:
    return pa.array(list(np.asarray(v, np.int64)), pa.list_(pa.int64()))


def _first_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        after = np.tile(LAST, (b.num_rows, 1))
        yield pa.record_batch([*b.columns, _lists(after), _lists(backward(b.column("symbols").to_pylist(), after))], names=[*b.schema.names, "after", "before"])


def _next_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.schema.names
        follow, after, before = (_vectors(b.column(c)) for c in ("follow", "after", "before"))
        follow = follow - follow.min(axis=1, keepdims=True)
        again = ((follow - after) != (follow - after)[:, :1]).any(axis=1)
        if again.any():
            at = np.flatnonzero(again)
            texts = b.column("symbols").take(pa.array(at)).to_pylist()
            before[at] = backward(texts, follow[at], before[at], after[at])
        keep = [c for c in names if c not in ("follow", "after", "before", "again")]
        after = np.where(again[:, None], follow, after)
        yield pa.record_batch([*[b.column(c) for c in keep], _lists(after), _lists(before), pa.array(again)], names=[*keep, "after", "before", "again"])


def _trace_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [trace(s, v, last) for s, v, last in zip(b.column("symbols").to_pylist(), _vectors(b.column("after")), b.column("last").to_pylist())]
        yield pa.record_batch(
            [*[b.column(c) for c in ("conv", "chunk", "nth", "symbols")], pa.array([[a for a, _ in m] for m in made], pa.list_(pa.string())), pa.array([[q for _, q in m] for m in made], pa.list_(pa.int32()))],
            names=["conv", "chunk", "nth", "symbols", "audits", "to"],
        )


def _faults(rows: DataFrame) -> DataFrame:
    """`rows` (conv, turn, role, text) in order as pos, with one letter per row for its role and its first fault.

    A row is a duplicate unless it is the first of its role and text; the firsts come from one aggregate and meet the rows by a key of the row, so a text that
    is said a million times in one conversation is no hot key. Sorting is by ranges, so a conversation of any length spreads over tasks.
    """
    keyed = stored(rows.withColumn("row", F.monotonically_increasing_id()), "repair-rows")
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = keyed.groupBy("conv", said.alias("said")).agg(F.min(F.struct("turn", "row")).alias("f")).select(F.col("f.row").alias("row"), F.lit(True).alias("is_first"))
    visible = F.rlike("text", F.lit(VISIBLE))
    ended = F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    fault = F.when(~visible, BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(~ended, CUT_OFF).otherwise(OK)
    marked = keyed.join(firsts, "row", "left").withColumn("symbol", F.chr(F.lit(97) + 4 * role + fault))
    ordered = marked.repartitionByRange("conv", "turn", "role", "text", "row").sortWithinPartitions("conv", "turn", "role", "text", "row")
    return stored(ordered.select("conv", "turn", "role", "text", "symbol", F.monotonically_increasing_id().alias("pos")), "repair-ordered")


def _maps(chunks: DataFrame, rounds_for: int) -> DataFrame:
    """The state at the start of every chunk: the maps from start to end states of all chunks before, composed by doubling."""
    maps = chunks.select("conv", "chunk", "nth", F.col("to").alias("upto"))
    span = 1
    while span < rounds_for:
        left = maps.select(F.col("conv").alias("c"), (F.col("nth") + span).alias("n"), F.col("upto").alias("left"))
        met = maps.join(left, F.col("conv").eqNullSafe(F.col("c")) & (F.col("nth") == F.col("n")), "left")
        upto = F.coalesce(F.transform("left", lambda q: F.element_at("upto", q + 1)), F.col("upto"))
        maps = stored(met.select("conv", "chunk", "nth", upto.alias("upto")), "repair-maps")
        span *= 2
    return maps.select(F.col("conv").alias("c"), (F.col("nth") + 1).alias("n"), F.element_at("upto", 1).alias("entry"))


@dataclass
class Repaired:
    """`reports`: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. `turns`: conv, pos, nth, role, text of the repaired turns,
    in order of pos, then nth. `passes`: how often chunks had to run."""

    reports: DataFrame
    turns: DataFrame
    passes: int


def repair(rows: DataFrame, p: RepairParams = RepairParams(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """The cheapest repair of every conversation, the one with the ASCII-least audit among equals.

    Edits are Keep (K, 0), Rerole (R, 2), Delete (D, 3; blank and repeated turns must go) and Insert (I, 2); a truncated turn that stays costs 1.
    Turns come in order of turn (nulls first), then role and text, so ties and repeated rows have one order. Null roles and texts count as one space; a null conversation is a
    conversation. A role counts by its first letter; all but s, u and a only stay with a new role. Empty tables give empty results, other columns do not get in the way, and
    conversations and texts may be of any length: a conversation is cut into chunks that any task may take, and no text enters the search.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    ordered = _faults(rows)
    chunk = F.shiftright("pos", p.chunk_bits)
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]), "")
    cut = ordered.groupBy("conv", chunk.alias("chunk")).agg(letters.alias("symbols"))
    by_chunk = Window.partitionBy("conv").orderBy("chunk")
    cut = cut.select("conv", "chunk", "symbols", F.row_number().over(by_chunk).alias("nth"), F.lead("chunk").over(by_chunk).isNull().alias("last"), F.lag(F.right("symbols", F.lit(1))).over(by_chunk).alias("prior"))
    conv_type = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {conv_type}, chunk bigint, symbols string, nth int, last boolean, prior string, after array<bigint>, before array<bigint>"
    chunks = stored(cut.mapInArrow(_first_run, schema), "repair-chunks")
    most = chunks.agg(F.max("nth")).first()[0] or 0

    passes, again = 1, most > 1
    while again:
        follow = chunks.select(F.col("conv").alias("c"), (F.col("nth") - 1).alias("n"), F.col("before").alias("follow"))
        met = chunks.join(follow, F.col("conv").eqNullSafe(F.col("c")) & (F.col("nth") == F.col("n")), "left").drop("c", "n")
        met = met.withColumn("follow", F.coalesce("follow", F.array(*map(F.lit, LAST.tolist()))))
        ran = stored(met.mapInArrow(_next_run, f"{schema}, again boolean"), "repair-pass")
        passes += 1
        again = not ran.where("again").isEmpty()
        chunks = ran.drop("again")

    columns = f"conv {conv_type}, chunk bigint, nth int, symbols string, audits array<string>, to array<int>"
    traced = stored(chunks.select("conv", "chunk", "nth", "symbols", "after", "last").mapInArrow(_trace_run, columns), "repair-traces")
    entries = _maps(traced, most)
    state = F.coalesce("entry", F.lit(0))
    met = traced.join(entries, F.col("conv").eqNullSafe(F.col("c")) & (F.col("nth") == F.col("n")), "left")
    audits = stored(met.select("conv", "chunk", "nth", "symbols", state.alias("entry"), F.element_at("audits", state + 1).alias("audit")), "repair-audits")
    return Repaired(_reports(ordered, chunks, audits), _turns(ordered, audits, p), passes)


def _reports(ordered: DataFrame, chunks: DataFrame, audits: DataFrame) -> DataFrame:
    count = lambda fault: F.sum(F.regexp_count("symbols", F.lit("[" + "".join(chr(97 + 4 * r + fault) for r in range(4)) + "]")))
    roles = F.translate("symbols", "abcdefghijklmnop", "ssssuuuuaaaaxxxx")
    with_prior = F.concat(F.coalesce(F.translate("prior", "abcdefghijklmnop", "ssssuuuuaaaaxxxx"), F.lit("")), roles)
    legal = F.regexp_count(with_prior, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    illegal = F.sum(F.char_length(with_prior) - 1 - legal)
    # the vector before a chunk counts from the least entry of the vector after it, so the constants of the later chunks are added
    cost = F.sum(F.when(F.col("nth") == 1, F.element_at("before", 1)).otherwise(F.array_min("before")))
    told = chunks.groupBy("conv").agg(count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT_OFF).alias("truncated"), illegal.alias("illegal"), cost.alias("cost"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")
    spoken = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "audit"))), lambda x: x["audit"]), "")
    parts = ordered.groupBy("conv").agg(gaps), audits.groupBy("conv").agg(spoken.alias("audit"))
    for part in parts:
        part = part.withColumnRenamed("conv", "c")
        told = told.join(part, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    longs = [F.col(c).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select("conv", *longs, "audit")


def _turns(ordered: DataFrame, audits: DataFrame, p: RepairParams) -> DataFrame:
    """One row per edit that leaves a turn; a chunk's edits find their rows by position."""

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("at", "offset", "nth", "new_role")}
            for k, (symbols_, entry, audit) in enumerate(zip(*(b.column(c).to_pylist() for c in ("symbols", "entry", "audit")))):
                i, q, nth = 0, entry, 0
                roles = symbols(symbols_)[0].tolist()
                for letter in audit:
                    if letter != "D":
                        to = int(NEXT[q][roles[i]]) if letter == "K" else int(FORCED[q])
                        out["at"].append(k)
                        out["offset"].append(i if letter != "I" else -1)
                        out["nth"].append(i * 3 + nth if letter == "I" else i * 3 + 2)
                        out["new_role"].append(None if letter == "K" else "user" if to == 2 else "assistant")
                        q = to
                        nth += 1
                    if letter != "I":
                        i, nth = i + 1, 0
            rows = pa.array(out["at"], pa.int64())
            yield pa.record_batch([b.column("conv").take(rows), b.column("chunk").take(rows), pa.array(out["offset"], pa.int64()), pa.array(out["nth"], pa.int64()), pa.array(out["new_role"], pa.string())], names=["conv", "chunk", "offset", "nth", "new_role"])

    conv_type = audits.schema["conv"].dataType.simpleString()
    made = audits.select("conv", "chunk", "symbols", "entry", "audit").mapInArrow(edits, f"conv {conv_type}, chunk bigint, offset bigint, nth bigint, new_role string")
    # rows of a chunk are neighbours, so position and offset differ by the chunk's first position
    first = ordered.groupBy("conv", F.shiftright("pos", p.chunk_bits).alias("chunk")).agg(F.min("pos").alias("first")).withColumnRenamed("conv", "c").withColumnRenamed("chunk", "k")
    made = made.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    made = made.select("conv", F.col("first").alias("pos"), "nth", "new_role", F.when(F.col("offset") >= 0, F.col("first") + F.col("offset")).alias("of"))
    put_in = made.where(F.col("of").isNull()).select("conv", "pos", "nth", F.col("new_role").alias("role"), F.lit("").alias("text"))
    texts = ordered.select(F.col("pos").alias("of"), "role", "text")
    stay = made.where(F.col("of").isNotNull()).join(texts, "of").select("conv", "pos", "nth", F.coalesce("new_role", "role").alias("role"), "text")
    return stay.unionByName(put_in)


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its repaired turns as `role:text`, joined by newlines. A digest runs over a whole conversation, so one task
    reads it in order; it holds a batch of turns at a time, never a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, done = None, None, []
        for b in batches:
            for k, (role, text) in enumerate(zip(b.column("role").to_pylist(), b.column("text").to_pylist())):
                at = b.column("conv").slice(k, 1)
                if running is None or not at.equals(conv):
                    if running:
                        done.append((conv, running.hexdigest()))
                    conv, running = at, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield pa.record_batch([pa.concat_arrays([c for c, _ in done]), pa.array([d for _, d in done])], names=["conv", "digest"])
                done = []
        if running:
            yield pa.record_batch([conv, pa.array([running.hexdigest()])], names=["conv", "digest"])

    conv_type = turns.schema["conv"].dataType.simpleString()
    return turns.repartition("conv").sortWithinPartitions("conv", "pos", "nth").mapInArrow(run, f"conv {conv_type}, digest string")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with a fault in one of four rows, told by crc32 of conversation and turn modulo 20:
    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    copies: Column = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
