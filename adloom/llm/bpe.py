"""Byte-level BPE by backtracking over longest matches, and decoding through an offset table."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import text_batches

#: Fixed value: the split into words that byte-level BPE vocabularies of this kind are made with.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What a worker remembers: pieces of text of so many bytes in all, none longer than so many characters, and so many pairs.
CACHE_BYTES, CACHE_CHARS, CACHE_PAIRS = 96 << 20, 40, 1 << 17
#: What an entry takes besides the bytes of its value and its key: both objects, and its share of the table.
ENTRY_BYTES = 210


def byte_symbols() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


#: A space right before something visible.
CUT = re.compile(r" (?=\S)")


class Remembered(dict):
    """Values of a function of a string, as many as fit into `limit` bytes; then it starts anew, as most pieces of a text are seen once only."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= CACHE_CHARS:
            self.held += ENTRY_BYTES + len(key) + len(value)
            if self.held > self.limit:
                self.clear()
                self.held = ENTRY_BYTES + len(key) + len(value)
            self[key] = value
        return value


class Vocabulary:
    """Tokens in bytes, how each is merged, and the strings that are tokens whatever surrounds them."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        if not plain or spec.get("normalizer") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-level BPE is supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        symbol, ids = byte_symbols(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for text, i in ids.items():
            if text not in self.special:
                self.token[i] = bytes(symbol[c] for c in text)
        #: (left, right) -> (rank, merged); token -> the pair it is made of
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if left + right in ids:
                a, b, ab = ids[left], ids[right], ids[left + right]
                self.pair.setdefault((a, b), (rank, ab))
                self.made.setdefault(ab, (rank, a, b))
        ordinary = [(t, i) for i, t in enumerate(self.token) if t]
        for text, i in self.special.items():
            self.token[i] = text.encode()
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in self.token])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)
        self.name = [str(i) for i in range(len(self.token))]

        import ahocorasick

        self.matcher = ahocorasick.Automaton()
        by_text = {t: i for t, i in ordinary}
        for t, i in ordinary:
            self.matcher.add_word(t.decode("latin-1"), (len(t), i))
        self.matcher.make_automaton()
        #: the longest token that is a proper prefix of a token, or -1
        self.shorter = {i: next((by_text[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_text), -1) for t, i in ordinary}
        #: left * size + right -> whether the pair is compatible
        self.compatible: dict[int, bool] = {}

        import regex

        self.words = regex.compile(WORDS)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words_seen = Remembered(self._word, CACHE_BYTES // 4)
        self.pieces = Remembered(self._after_space, CACHE_BYTES * 3 // 4)

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens yields just these two; kept in the pair-compatibility table.

        The last parts of `left` and the first parts of `right` exist for a while during merging. A merge across the border
        happens if such parts meet before either has gone into a larger part. Undoing the later merge first, the right one of equals, visits all that meet.
        """
        at = left * len(self.token) + right
        known = self.compatible.get(at)
        if known is None:
            a, b, until = left, right, None
            known = True
            while True:
                over = self.pair.get((a, b))
                # a merge within a side goes first if its rank is smaller; with equal ranks the one on the left does
                if over and (until is None or over[0] < until):
                    known = False
                    break
                ra, rb = self.made.get(a, (-1, 0, 0)), self.made.get(b, (-1, 0, 0))
                if ra[0] < 0 and rb[0] < 0:
                    break
                if ra[0] > rb[0]:
                    until, a = ra[0], ra[2]
                else:
                    until, b = rb[0] + 1, rb[1]
            if len(self.compatible) >= CACHE_PAIRS:
                self.compatible.clear()
            self.compatible[at] = known
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The merges of one word. Tries the longest token first; a token that fits neither in full nor shortened gives up its predecessor."""
        n = len(word)
        longest = [-1] * n
        for end, (size, i) in self.matcher.iter(word.decode("latin-1")):
            longest[end - size + 1] = i  # ends ascend, so the last one is the longest
        out: list[int] = []
        dead = bytearray(n + 1)  # positions from which no valid rest is left
        at, trying = 0, longest[0] if n else -1
        while at < n:
            while trying >= 0:
                end = at + len(self.token[trying])
                if not dead[end] and (not out or self.fits(out[-1], trying)):
                    break
                trying = self.shorter[trying]
            if trying >= 0:
                out.append(trying)
                at = end
                trying = longest[at] if at < n else -1
            elif out:
                dead[at] = 1
                last = out.pop()
                at -= len(self.token[last])
                trying = self.shorter[last]
            else:
                raise ValueError("the vocabulary has no token for a byte")
        return out

    def _word(self, word: str) -> bytes:
        return np.array(self.encode_word(word.encode()), np.int32).tobytes()

    def _after_space(self, piece: str) -> bytes:
        if piece.isalpha():
            return self._word(" " + piece)
        if piece[:-1].isalpha() and piece[-1] in ".,:;!?":  # a word, then a word of this one mark
            return self.pieces[piece[:-1]] + self.words_seen[piece[-1]]
        return self._split(" " + piece)

    def _split(self, piece: str) -> bytes:
        return b"".join(self.words_seen[w] for w in self.words.findall(piece))

    def _ordinary(self, text: str) -> bytes:
        # a word never goes on beyond a space that stands right before something visible, so these are safe places to cut
        head, *rest = CUT.split(text)
        return self._split(head) + b"".join(map(self.pieces.__getitem__, rest))

    def encode(self, text: str) -> np.ndarray:
        if not self.specials or not self.specials.search(text):
            return np.frombuffer(self._ordinary(text), np.int32)
        parts = [np.array([self.special[p]], np.int32) if p in self.special else np.frombuffer(self._ordinary(p), np.int32) for p in self.specials.split(text) if p]
        return np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' bytes, copied from one table by offset; a broken UTF-8 sequence becomes U+FFFD."""
        out = []
        for k in range(0, len(ids), 1 << 20):
            some = ids[k : k + (1 << 20)]
            start, size = self.offset[some], self.offset[some + 1] - self.offset[some]
            end = np.cumsum(size)
            out.append(self.blob[np.repeat(start - (end - size), size) + np.arange(end[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def tokenizer_file(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process; `path` is a tokenizer file that every machine has."""
    with open(path, encoding="utf-8") as f:
        return Vocabulary(json.load(f))


def encode_decode(docs: DataFrame, tokenizer_path: str, columns: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, and the asked-for columns out of ids (array<int>), ids_sha256, decoded, decoded_sha256.

    Null text is empty text, which has no tokens. Strings of special tokens inside a text are those tokens. Texts of any length are encoded
    whole, in time linear in their length. Of tokens that fit equally well the merges decide, so there are no ties; repeated rows give repeated rows, an
    empty table an empty result, and other columns of `docs` do not get in the way. Narrow: no shuffle, and nothing is kept between rows
    but caches of `CACHE_BYTES` a worker.
    """
    kinds = {"ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", "n_tokens bigint", *[f"{c} {kinds[c]}" for c in columns]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer_path)
        for batch, texts in text_batches(batches, 1):
            made = {c: [] for c in ("n_tokens", *columns)}
            for text in texts:
                ids = v.encode(text)
                made["n_tokens"].append(len(ids))
                if "ids" in made:
                    made["ids"].append(ids)
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(",".join(map(v.name.__getitem__, ids.tolist())).encode()).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    back = v.decode(ids)
                    for c, x in (("decoded", back), ("decoded_sha256", hashlib.sha256(back.encode()).hexdigest())):
                        if c in made:
                            made[c].append(x)
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.record_batch([batch.column(0), *[pa.array(x, types.get(c, pa.string())) for c, x in made.items()]], names=["doc_id", *made])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
