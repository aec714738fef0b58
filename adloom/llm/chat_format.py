"""Chat records of many layouts to canonical turns, and turns to training text with a loss mask and back."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"

#: Strings that chat templates use as control marks; none of them survives inside a text.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

BREAKS = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How to read turns from a record: a list of turn objects, or one field per turn.

    `required` and `optional` are nested field paths (`a[].b` for b in the objects of list a).
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def prints(self) -> list[str]:
        """Fingerprint sources of every set of paths that this layout reads."""
        extra = [[]]
        for p in self.optional:
            extra += [e + [p] for e in extra]
        return [",".join(sorted([*self.required, *e])) for e in extra]


def listed(name: str, items: str, role: str, text: str, roles: dict[str, str] | None = None) -> Layout:
    return Layout(name, (items, f"{items}[].{role}", f"{items}[].{text}"), items=items, role=role, text=text, roles=roles or {})


def paired(name: str, question: tuple[str, ...], answer: str, optional: tuple[str, ...] = (), system: str = "system_prompt") -> Layout:
    turns = (("system", (system,)), ("user", question + optional), ("assistant", (answer,)))
    return Layout(name, (*question, answer), (*optional, system), turns=turns)


LAYOUTS = (
    listed("messages", "messages", "role", "content"),
    listed("conversations", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    listed("dialog", "dialog", "speaker", "utterance"),
    paired("prompt_response", ("prompt",), "response"),
    paired("prompt_completion", ("prompt",), "completion"),
    paired("instruction", ("instruction",), "output", optional=("input",)),
    paired("question_answer", ("question",), "answer"),
)


def field_paths(record: Column) -> Column:
    """Nested field paths of a VARIANT object: its keys, and the keys of the objects in its lists."""
    def of(entry: Column) -> Column:
        inner = F.coalesce(F.try_variant_get(entry["value"], "$", "array<map<string,variant>>"), F.array().cast("array<map<string,variant>>"))
        keys = F.array_distinct(F.flatten(F.transform(inner, lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>")))))
        return F.concat(F.array(entry["key"]), F.transform(keys, lambda k: F.concat(entry["key"], F.lit("[]."), k)))

    return F.array_distinct(F.flatten(F.transform(F.map_entries(F.try_variant_get(record, "$", "map<string,variant>")), of)))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of those nested field paths that any layout names; fields nobody names do not count. Null if none."""
    known = sorted({p for x in layouts for p in (*x.required, *x.optional)})
    paths = F.array_sort(F.array_intersect(field_paths(record), F.array(*map(F.lit, known))))
    return F.when(F.size(paths) > 0, F.xxhash64(F.array_join(paths, ",")))


def _turns(record: Column, layout: Layout) -> Column:
    if layout.items:
        # a list item's fields are looked up by name, whatever else the item holds
        items = F.try_variant_get(record, f"$.{layout.items}", "array<map<string,variant>>")

        def turn(m: Column) -> Column:
            role = F.coalesce(F.try_variant_get(m[layout.role], "$", "string"), F.lit(""))
            named = reduce(lambda e, kv: F.when(role == kv[0], kv[1]).otherwise(e), layout.roles.items(), role)
            return F.struct(named.alias("role"), F.coalesce(F.try_variant_get(m[layout.text], "$", "string"), F.lit("")).alias("text"))

        return F.transform(items, turn)
    parts = []
    for role, fields in layout.turns:
        texts = [F.try_variant_get(record, f"$.{f}", "string") for f in fields]
        text = F.concat_ws("\n", *[F.when(t != "", t) for t in texts]) if len(texts) > 1 else F.coalesce(texts[0], F.lit(""))
        there = F.lit(True) if set(fields) & set(layout.required) else texts[0].isNotNull()
        parts.append(F.when(there, F.struct(F.lit(role).alias("role"), text.alias("text"))))
    return F.filter(F.array(*parts), lambda t: t.isNotNull())


def canonical_turns(record: Column, print_: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Turns by the mapping that the fingerprint selects; null where no layout has that fingerprint."""
    out = F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        known = [print_ == F.xxhash64(F.lit(p)) for p in layout.prints()]
        out = F.when(reduce(Column.__or__, known), _turns(record, layout)).otherwise(out)
    return out


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one behind the first character of every control string."""
    broken = F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({BREAKS})", "$1\\\\")
    return F.when(text.rlike(r"[<\[\\]"), broken).otherwise(text)


def unescape(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, r"\\(\\?)", "$1")).otherwise(text)


def segments(turns: Column) -> Column:
    """The formatted text in pieces, each with its loss flag: only the assistant's own words are learned."""
    def of(t: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        head = F.concat(F.lit(START), escape(t["role"]), F.lit(SEP))
        return F.array(piece(head, F.lit(False)), piece(escape(t["text"]), t["role"] == "assistant"), piece(F.lit(END), F.lit(False)))

    return F.flatten(F.transform(turns, of))


def parse(formatted: Column) -> Column:
    """Turns from formatted text."""
    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit(SEP))
        role = F.substring(piece, F.lit(len(START) + 1), at - F.lit(len(START) + 1))
        text = F.substring(piece, at + F.lit(len(SEP)), F.char_length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    pieces = F.filter(F.split(formatted, re.escape(END)), lambda p: p != "")
    return F.transform(pieces, turn)


def format_chats(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, turns, segments (text, loss) and formatted to `records`; `record_col` is VARIANT or JSON text.

    Only columns of these four names are replaced. Null, unparsable or unknown records get null turns and formatted.
    Null texts and roles are empty. One conversation is one value: Spark's 2 GB bound on a value applies to it.
    """
    record = F.col(record_col)
    if dict(records.dtypes)[record_col] == "string":
        record = F.try_parse_json(record)
    out = records.withColumn("fingerprint", fingerprint(record, layouts))
    out = out.withColumn("turns", canonical_turns(record, F.col("fingerprint"), layouts))
    out = out.withColumn("segments", segments(F.col("turns")))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
