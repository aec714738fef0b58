"""Personal data in plain and disguised spelling.

Transducers rewrite a text step by step (homoglyphs, invisible characters, at/dot disguises, spelled digits) and keep, for every character
of the result, the source characters it stands for. Identifiers are detected in the source and in the rewritten text; what the rewriting
brought to light is mapped back to the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The identifiers. Runs are taken possessively where no shorter run could go on, so each pattern is linear.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII ones and have no compatibility mapping.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "З": "3", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "Ѕ": "S", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "ϲ": "c",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ո": "n", "օ": "o", "ս": "u", "հ": "h", "ց": "g",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "⁃": "-", "﹘": "-", "。": ".", "•": ".", "∙": ".", "⋅": ".", "᛫": ".", "܁": ".", "٠": "0",
}
# How digits are said in the languages of the corpus, and what stands for a plus sign.
SPOKEN = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_WORD = "(?:" + "|".join(sorted(SPOKEN, key=len, reverse=True)) + ")"
_LETTER = r"[^\W\d_]"
_ITEM = rf"(?:{_WORD}(?!{_LETTER})|[0-9]++)"
_SAID = re.compile(rf"(?<!{_LETTER}){_WORD}(?!{_LETTER})(?:[ ,.()/-]{{0,3}}+{_ITEM})++", re.I)
_SAID_PART = re.compile(rf"{_WORD}|[^A-Za-zÀ-ÿ]+", re.I)
_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤︀-️﻿]+")
_ENTITY = re.compile(r"&(?:#0*(?:64|x40)|commat);|&(?:#0*(?:46|x2e)|period);|&(?:#0*(?:43|x2b)|plus);", re.I)
# runs of blanks are entered at their start only, so long ones cost their length
_BRACKETED = re.compile(r"(?<![ \t])[ \t]*+[\[({<][ \t]*+(at|ät|@|arroba|dot|\.|punkt|punto|point)[ \t]*+[\])}>][ \t]*+", re.I)
_AT_WORD = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]++@[ \t]*+|@[ \t]++|_at_|-at-)(?=[A-Za-z0-9])", re.I)
_DOT_WORD = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]++(?:dot|punkt|punto|point|\.)[ \t]++|_dot_|-dot-)(?=[A-Za-z0-9])", re.I)
_SPACED_AT = re.compile(r"[ \t]at[ \t]+((?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})(?![A-Za-z0-9@_%+-]|\.[A-Za-z0-9])", re.I)
_PLUS_WORD = re.compile(r"(?:(?<![^\W_])plus|\(plus\))[ \t]*+(?=\(?[0-9])", re.I)
_LETTER_DIGITS = re.compile(r"(?<![0-9A-Za-z|])(?=[0-9]*+[OoIl|])[0-9OoIl|]++(?![^\W_])")
_DIGIT_FOR = str.maketrans("OoIl|", "00111")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48 << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the identifiers as they stand, ordered by start, then kind; linear in the length of the text."""
    found, done = [], 0
    for m in _AT.finditer(text):
        at = m.start()
        while at > done and text[at - 1] in _LOCAL:
            at -= 1
        if at < m.start():
            found.append((at, m.end(), 0))
            done = m.end()
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


@cache
def single_forms() -> dict[int, str]:
    """Characters that stand for one ASCII character: digits of all scripts, compatibility forms (full width, mathematical, circled), look-alikes."""
    forms = {ord(c): to for c, to in LOOK_ALIKES.items()}
    for i in range(0x80, 0x20000):
        if i in forms or 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        plain = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) == "Nd":
            forms[i] = str(unicodedata.digit(c))
        elif unicodedata.category(c) == "Zs":
            forms[i] = " "
        elif len(plain) == 1 and " " < plain <= "~":
            forms[i] = plain
    return forms


class Rewritten:
    """A text on its way through the transducers; character i of it stands for the source characters from lo[i] to hi[i]."""

    def __init__(self, source: str):
        self.text, self.lo, self.hi = source, None, None

    def edit(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces disjoint, ascending ranges. New characters share out the range: as far as it goes one each, the last one takes the rest."""
        if not edits:
            return
        if self.lo is None:
            self.lo = np.arange(len(self.text), dtype=np.int64)
            self.hi = self.lo + 1
        text, lo, hi, at = [], [], [], 0
        for start, end, to in edits:
            text += [self.text[at:start], to]
            lo.append(self.lo[at:start])
            hi.append(self.hi[at:start])
            if to:
                last = end - 1
                lo.append(np.array([self.lo[min(start + k, last)] for k in range(len(to))], np.int64))
                hi.append(np.array([self.hi[min(start + k, last)] for k in range(len(to) - 1)] + [self.hi[last]], np.int64))
            at = end
        text.append(self.text[at:])
        self.text = "".join(text)
        self.lo, self.hi = np.concatenate([*lo, self.lo[at:]]), np.concatenate([*hi, self.hi[at:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.lo is None else (int(self.lo[start]), int(self.hi[end - 1]))


def drop_invisible(r: Rewritten) -> None:
    if not r.text.isascii():
        r.edit([(*m.span(), "") for m in _INVISIBLE.finditer(r.text)])


def plain_letters(r: Rewritten) -> None:
    """One character for one, so no offset changes."""
    if not r.text.isascii() and not single_forms().keys().isdisjoint(map(ord, set(r.text))):
        r.text = r.text.translate(single_forms())


def named_signs(r: Rewritten) -> None:
    if "&" in r.text:
        sign = lambda s: "@" if "64" in s or "x40" in s or "commat" in s else "." if "46" in s or "x2e" in s or "period" in s else "+"
        r.edit([(*m.span(), sign(m.group().lower())) for m in _ENTITY.finditer(r.text)])


def bracketed_signs(r: Rewritten) -> None:
    if any(c in r.text for c in "[({<"):
        r.edit([(*m.span(), "@" if m.group(1).lower() in ("at", "ät", "@", "arroba") else ".") for m in _BRACKETED.finditer(r.text)])


def loose_signs(r: Rewritten) -> None:
    r.edit([(*m.span(), ".") for m in _DOT_WORD.finditer(r.text)])
    r.edit([(*m.span(), "@") for m in _AT_WORD.finditer(r.text)])


def said_at(r: Rewritten) -> None:
    """The word `at` between something like a mailbox and a domain. In running text both could be words, so the domain must have been
    disguised itself, or have two dots, or the mailbox must hold a sign or digit that words don't."""
    edits = []
    for m in _SPACED_AT.finditer(r.text):
        stop = m.start()
        while stop > 0 and r.text[stop - 1] in " \t":
            stop -= 1
        at = stop
        while at > 0 and stop - at <= 64 and r.text[at - 1] in _LOCAL:
            at -= 1
        box, domain = r.text[at:stop], m.group(1)
        lo, hi = r.source(*m.span(1))
        if not 0 < len(box) <= 64 or box[-1] in ".-" or (at > 0 and r.text[at - 1] == "@"):
            continue
        odd = re.search(r"[0-9._%+-]", box.lstrip(".-")) is not None
        if hi - lo != len(domain) or odd or (domain.count(".") > 1 and not domain.lower().startswith("www.")):
            edits.append((stop, m.start(1), "@"))
    r.edit(edits)


def said_digits(r: Rewritten) -> None:
    """Runs of at least three spelled digits; blanks, commas and hyphens between two spelled ones go, other signs stay."""
    edits = []
    for m in _SAID.finditer(r.text):
        parts = [(p.start() + m.start(), p.group()) for p in _SAID_PART.finditer(m.group())]
        if sum(p.lower() in SPOKEN for _, p in parts) < 3:
            continue
        for k, (at, p) in enumerate(parts):
            if p.lower() in SPOKEN:
                edits.append((at, at + len(p), str(SPOKEN[p.lower()])))
            elif 0 < k < len(parts) - 1 and not p.strip(" ,-"):
                edits.append((at, at + len(p), ""))
    r.edit(edits)


def letter_digits(r: Rewritten) -> None:
    """O, I, l and | among digits, one for one."""
    edits = [(*m.span(), m.group().translate(_DIGIT_FOR)) for m in _LETTER_DIGITS.finditer(r.text) if 2 * sum(c.isdigit() for c in m.group()) >= len(m.group())]
    r.edit([(at + k, at + k + 1, c) for at, end, to in edits for k, c in enumerate(to) if r.text[at + k] != c])


def said_plus(r: Rewritten) -> None:
    if "lus" in r.text or "LUS" in r.text:
        r.edit([(*m.span(), "+") for m in _PLUS_WORD.finditer(r.text)])


TRANSDUCERS: tuple[Callable[[Rewritten], None], ...] = (
    drop_invisible, plain_letters, named_signs, bracketed_signs, loose_signs, said_at, said_digits, letter_digits, said_plus,
)


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans as they stand, and all spans: those and what the rewriting adds.

    A span is added if a character in it was rewritten, its kind has no span as it stands that covers it, and, for an e-mail address,
    its last label has letters only.
    """
    base = detect(text)
    r = Rewritten(text)
    for step in TRANSDUCERS:
        step(r)
    if r.text == text:
        return base, base
    plain: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    for s, e, k in base:
        plain[k].append((s, e))
    added = []
    for start, end, kind in detect(r.text):
        lo, hi = r.source(start, end)
        shown = r.text[start:end]
        if text[lo:hi] == shown:
            continue
        at = bisect_right(plain[kind], (lo, len(text) + 1)) - 1
        if at >= 0 and hi <= plain[kind][at][1]:
            continue
        if kind == 0 and not re.fullmatch("[A-Za-z]{2,}", shown.rsplit(".", 1)[1]):
            continue
        added.append((lo, hi, kind))
    return base, sorted({*base, *added}, key=lambda s: (s[0], s[2], s[1]))


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def find_personal(docs: DataFrame, columns: tuple[str, ...] = ("spans", "masked"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and the asked-for columns out of

    spans (array of kind, start, end in code points, plain: whether the span stands there undisguised), masked (the text with every span
    replaced by its kind in brackets, overlapping spans as one), n_email, n_ip, n_card, n_phone (plain spans), n_disguised, base_sha256 and span_list.

    Null and empty texts have no spans. Texts of any length are read whole, in time linear in their length. Repeated rows and ids give repeated rows, an empty table an empty
    result, and other columns do not get in the way. Narrow: no shuffle. Spans with the same start come in the order of kinds, then ends.
    """
    kinds = {
        "spans": "array<struct<kind:string,start:bigint,end:bigint,plain:boolean>>", "masked": "string", "base_sha256": "string", "span_list": "string",
        **{f"n_{k}": "bigint" for k in (*KINDS, "disguised")},
    }
    arrow = {"string": pa.string(), "bigint": pa.int64(), kinds["spans"]: pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))}
    id_type = docs.schema[id_col].dataType.simpleString()
    count = {f"n_{k}": i for i, k in enumerate(KINDS)}

    def value(column: str, text: str, base: list, spans: list):
        if column in count:
            return sum(k == count[column] for _, _, k in base)
        if column == "n_disguised":
            return len(spans) - len(base)
        if column == "base_sha256":
            return hashlib.sha256(spelled(base).encode()).hexdigest()
        if column == "span_list":
            return spelled(spans)
        if column == "masked":
            return mask(text, spans)
        plain = set(base)
        return [{"kind": KINDS[k], "start": s, "end": e, "plain": (s, e, k) in plain} for s, e, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {c: [] for c in columns}
            for cell in batch.column(1):
                text = cell.as_py() or ""
                base, spans = find(text)
                for c in columns:
                    made[c].append(value(c, text, base, spans))
            yield pa.record_batch([batch.column(0), *[pa.array(x, arrow[kinds[c]]) for c, x in made.items()]], names=["doc_id", *made])

    schema = ", ".join([f"doc_id {id_type}", *[f"{c} {kinds[c]}" for c in columns]])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
