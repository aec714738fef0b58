"""Stored HTML as an ordered token array, and the few selectors the extractors need.

A token is `{pos, close, tag, attrs, cls, text, end, next}`: either a tag (with `tag`, raw `attrs` and the
class attribute) or a run of text. Tokens stay in the row of their page, so no page ever crosses a shuffle.
An element reaches from its opening tag to the matching closing tag of the same name; that tolerates
unclosed inline tags. `<p>` also ends at the next `<p>`. Void elements contain nothing.

`end` is where the element of an opening tag ends, `next` the position of the next tag. Both are found in
one pass over the page, in Arrow batches of pages, so a page of any size costs its length, and no reader has
to search for the end of an element. Everything that reads tokens is made of Spark's own expressions.

A pass over all tokens is the dear part of a reader, so the same pass can list where names, classes, attributes and texts stand
(`Outline`). Readers look there first and touch the few tokens that they are about.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.functions.text import first_where, grab, let, null_if_empty, one_of, squeeze_ws, strip_ws, text_map

VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre",
    "section", "table", "td", "th", "tr", "ul",
]
ENTITIES = {
    "&amp;": "&",
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&copy;": "©", "&reg;": "®",
    "&trade;": "™", "&middot;": "·", "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&laquo;": "«", "&raquo;": "»",
    "&euro;": "€", "&pound;": "£", "&cent;": "¢", "&yen;": "¥", "&deg;": "°", "&times;": "×",
}

# the block tags by first letter: a list of so many words would be tried word by word at every tag
_BLOCK = (
    "a(?:ddress|rticle|side)|b(?:lockquote|r)|d(?:[dlt]|iv)|f(?:ieldset|igcaption|igure|ooter|orm)|h(?:[1-6r]|eader)|li|main|nav|ol|p(?:re)?|section|"
    "t(?:able|[dhr])|ul"
)

# array elements per block of a running fold
BLOCK = 128


def over_tokens(reader):
    """A reader of tokens that binds them first, so that an expression for tokens is computed once however often the reader mentions it."""

    @wraps(reader)
    def read(tokens: Column, *args, **kwargs) -> Column:
        return let(tokens, lambda t: reader(t, *args, **kwargs))

    return read


def _numeric_entity(piece: Column) -> Column:
    code = F.coalesce(
        F.conv(grab(piece, r"^&#[xX]([0-9a-fA-F]{1,6});$"), 16, 10), grab(piece, r"^&#(\d{1,7});$")
    ).try_cast("int")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, char).otherwise(piece)


def decode_entities(c: Column) -> Column:
    """Numeric and common named character references, each once and from left to right."""
    names = text_map(ENTITIES)

    def piece(p: Column) -> Column:
        return F.when(p.startswith("&#"), _numeric_entity(p)).otherwise(F.coalesce(F.try_element_at(names, p), p))

    def decoded(x: Column) -> Column:
        pieces = F.regexp_extract_all(x, F.lit(r"&#?[0-9a-zA-Z]+;|&|[^&]+"), F.lit(0))
        return F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(x)

    return let(c, decoded)


def visible_html(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    # what all begin with stands first, so that other characters cost one comparison
    return F.regexp_replace(html, r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)", "")


TOKENS = "array<struct<pos:int,close:boolean,tag:string,attrs:string,cls:string,text:string,end:int,next:int>>"

_PIECE = re.compile(r"<[/a-zA-Z][^>]*>|[^<]+|<")
_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.ASCII | re.IGNORECASE)
_ENTITY = re.compile(r"&#?[0-9a-zA-Z]+;")
# attributes of images and of the links around them, as `attr` finds them
_ATTRS = {
    name: re.compile(rf"""(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.ASCII | re.IGNORECASE)
    for name in (*vocab.IMAGE_SOURCES, "alt", "width", "height", "href")
}
_DIGITS = re.compile("[0-9]+")
_VOID = frozenset(VOID_TAGS)
# what a text is trimmed by, and the line ends after which a pattern still sees the end of the text (`strip_ws`)
_BLANKS, _LINE_ENDS = " \t\n\x0b\f\r\u00a0\ufeff", ("\x85", "\u2028", "\u2029")
_FIELDS = [("pos", pa.int32()), ("close", pa.bool_()), *[(f, pa.string()) for f in ("tag", "attrs", "cls", "text")], ("end", pa.int32()), ("next", pa.int32())]
_IMAGE = [("pos", pa.int32()), *[(f, pa.string()) for f in ("source", "plain", "alt")], ("tiny", pa.bool_()), ("href", pa.string())]


IMAGES = "array<struct<pos:int,source:string,plain:string,alt:string,tiny:boolean,href:string>>"
OUTLINE = "struct<names:array<string>,styled:array<struct<at:int,cls:string>>,marked:array<struct<at:int,attrs:string>>,texts:array<struct<at:int,text:string>>>"


def _tokenizer(outlined: bool = False):
    """The function from pages to tokens, or to tokens, their `Outline` and their `images`. It holds its helpers, so that workers need not have this package."""
    remembered: dict[str, tuple] = {}
    plain_sources, other_sources, least_side = vocab.IMAGE_SOURCES[:2], vocab.IMAGE_SOURCES[2:], vocab.MIN_IMAGE_SIDE

    def entity(found: re.Match) -> str:
        piece = found[0]
        if not piece.startswith("&#"):
            return ENTITIES.get(piece, piece)
        number = re.fullmatch("&#[xX]([0-9a-fA-F]{1,6});", piece)
        digits = re.fullmatch("&#([0-9]{1,7});", piece)
        code = int(number[1], 16) if number else int(digits[1]) if digits else 0
        return chr(code) if 1 <= code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else piece

    def decoded(text: str) -> str:
        return _ENTITY.sub(entity, text) if "&" in text else text

    def trimmed(text: str) -> str:
        if text[-1:] in _LINE_ENDS:
            return text[:-1].strip(_BLANKS) + text[-1]
        return text.strip(_BLANKS)

    def read_tag(piece: str) -> tuple | None:
        """`(close, tag, attrs, cls)`, or None for what is no tag. Tags recur from page to page, so short ones are remembered."""
        if not (named := _TAG.match(piece)):
            return None
        attrs, cls = piece[named.end():-2 if piece[-2] == "/" else -1], None
        if "class" in attrs and (found := _CLASS.search(attrs)):
            cls = decoded(found[1][1:-1] if found[1][0] in "\"'" else found[1])
        read = (piece[1] == "/", named[1].lower(), attrs, cls)
        if len(piece) <= 40:
            if len(remembered) >= 4096:
                remembered.clear()
            remembered[piece] = read
        return read

    def attribute(attrs: str, lowered: str, name: str) -> str | None:
        found = _ATTRS[name].search(attrs) if name in lowered else None
        return None if found is None else decoded(found[1][1:-1] if found[1][0] in "\"'" else found[1])

    def small(side: str | None) -> bool:
        digits = _DIGITS.match(side or "")
        significant = digits[0].lstrip("0") if digits else ""
        return 0 < len(significant) < 10 and int(significant) < least_side

    def image(pos: int, attrs: str, link: str | None) -> tuple:
        """A row of `images`; `link` are the attributes of the link around the image."""
        lowered = attrs.lower()
        first = lambda names: next(filter(None, (attribute(attrs, lowered, n) for n in names)), None)
        plain = first(plain_sources)
        tiny = any(small(attribute(attrs, lowered, side)) for side in ("width", "height"))
        href = None if link is None else attribute(link, link.lower(), "href")
        href = None if href is None else trimmed(href)
        leads = href and not href.startswith(("javascript:", "#"))
        return pos, plain or first(other_sources), plain, attribute(attrs, lowered, "alt"), tiny, href if leads else None

    def read_page(html: str, columns: list[list], lists: list[tuple[list, list, list]]) -> None:
        """Appends the tokens of one page to the columns of `TOKENS`, and what stands where to the lists of `OUTLINE` and of `IMAGES`. An opening tag
        waits in the list of its name until the closing tag of that name; a page is read once, so its cost is that of its length."""
        first, waiting, untagged, seen, link = len(columns[0]), {}, 0, [], None
        close_, tag_, attrs_, cls_, text_, end_, next_ = columns[1:]
        (names_,), (styled_at, styled), (marked_at, marked), (texts_at, texts), images_ = lists
        pieces = _PIECE.findall(html)
        end_.extend(range(len(pieces)))
        for pos, piece in enumerate(pieces):
            read = (remembered.get(piece) or read_tag(piece)) if piece[0] == "<" else None
            if read is None:
                text = decoded(piece)
                close_.append(piece[:2] == "</")
                tag_.append(None)
                attrs_.append(None)
                cls_.append(None)
                text_.append(text)
                if outlined:
                    names_.append(None)
                    if bare := trimmed(text):
                        texts_at.append(pos)
                        texts.append(bare)
                continue
            close, tag, attrs, cls = read
            close_.append(close)
            tag_.append(tag)
            attrs_.append(attrs)
            cls_.append(cls)
            text_.append(None)
            next_.extend([pos] * (pos - untagged))
            untagged = pos
            if outlined:
                names_.append(None if close else tag)
                if not close and cls is not None:
                    styled_at.append(pos)
                    styled.append(cls)
                if not close and "=" in attrs:
                    marked_at.append(pos)
                    marked.append(attrs)
                if not close and tag == "a":
                    link = pos
                elif not close and tag == "img":
                    seen.append((pos, attrs, link))
            if tag in _VOID:
                continue
            opened = waiting.setdefault(tag, [])
            if opened and (close or tag == "p"):
                end_[first + opened.pop()] = pos
            if not close:
                opened.append(pos)
        columns[0].extend(range(len(pieces)))
        next_.extend([None] * (len(pieces) - untagged))
        for opened in waiting.values():
            for pos in opened:
                end_[first + pos] = len(pieces)
        for pos, attrs, link in seen:
            around = link is not None and end_[first + link] > pos
            for values, value in zip(images_, image(pos, attrs, attrs_[first + link] if around else None)):
                values.append(value)

    def listed(pages: list) -> pa.Array:
        offsets, columns = [], [[] for _ in _FIELDS]
        lists = ([],), ([], []), ([], []), ([], []), tuple([] for _ in _IMAGE)
        begins = [[] for _ in lists]
        for html in pages:
            offsets.append(None if html is None else len(columns[0]))
            for begin, values in zip(begins, lists):
                begin.append(None if html is None else len(values[0]))
            if html is not None:
                read_page(html, columns, lists)
        fields = [pa.array(values, kind) for values, (_, kind) in zip(columns, _FIELDS)]
        structs = pa.StructArray.from_arrays(fields, names=[name for name, _ in _FIELDS])
        tokens = pa.ListArray.from_arrays(pa.array([*offsets, len(columns[0])], pa.int32()), structs)
        if not outlined:
            return tokens
        parts = []
        for begin, values, name in zip(begins[:4], lists, (None, "cls", "attrs", "text")):
            entries = pa.array(values[-1], pa.string())
            if name:
                entries = pa.StructArray.from_arrays([pa.array(values[0], pa.int32()), entries], names=["at", name])
            parts.append(pa.ListArray.from_arrays(pa.array([*begin, len(values[0])], pa.int32()), entries))
        outline = pa.StructArray.from_arrays(parts, names=["names", "styled", "marked", "texts"])
        shots = pa.StructArray.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(lists[4], _IMAGE)], names=[name for name, _ in _IMAGE])
        images = pa.ListArray.from_arrays(pa.array([*begins[4], len(lists[4][0])], pa.int32()), shots)
        return pa.StructArray.from_arrays([tokens, outline, images], names=["tokens", "outline", "images"])

    def parts(pages: pa.Array) -> Iterator[pa.Array]:
        # about a megabyte of markup at a time is held as Python objects
        some, size = [], 0
        for html in pages:
            some.append(html.as_py())
            size += len(some[-1] or "")
            if size >= 1 << 20:
                yield listed(some)
                some, size = [], 0
        if some:
            yield listed(some)

    @F.arrow_udf(TOKENS)
    def tokens(pages: pa.Array) -> pa.Array:
        return pa.concat_arrays([listed([]), *parts(pages)])

    # a batch of pages comes back in parts, so that neither side holds what all of it grows into
    @F.arrow_udf(f"struct<tokens:{TOKENS},outline:{OUTLINE},images:{IMAGES}>")
    def page(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield from parts(pages)

    return page if outlined else tokens


def html_tokens(html: Column) -> Column:
    return _tokenizer()(visible_html(html))


def outlined_tokens(html: Column, visible: Column | None = None) -> Column:
    """`{tokens, outline, images}` of a page, all found in one pass. `visible` is its `visible_html`, where that is at hand."""
    return _tokenizer(outlined=True)(visible_html(html) if visible is None else visible)


class Outline:
    """Where things stand among tokens: in a column that `outlined_tokens` has made, or else found among the tokens for this reader.

    `names` has the tag of every opening tag at its position; `styled` `{at, cls}`, `marked` `{at, attrs}` and `texts` `{at, text}` list opening
    tags with a class, opening tags with attributes, and trimmed texts that are not blank.
    """

    def __init__(self, tokens: Column, given: Column | None = None):
        self.tokens, self.given = tokens, given

    def _listed(self, kept, name: str, value) -> Column:
        return F.transform(F.filter(self.tokens, kept), lambda t: F.struct(t["pos"].alias("at"), value(t).alias(name)))

    @property
    def names(self) -> Column:
        return self.given["names"] if self.given is not None else F.transform(self.tokens, lambda t: F.when(~t["close"], t["tag"]))

    @property
    def styled(self) -> Column:
        return self.given["styled"] if self.given is not None else self._listed(lambda t: ~t["close"] & t["cls"].isNotNull(), "cls", lambda t: t["cls"])

    @property
    def marked(self) -> Column:
        return self.given["marked"] if self.given is not None else self._listed(lambda t: ~t["close"] & F.contains(t["attrs"], F.lit("=")), "attrs", lambda t: t["attrs"])

    @property
    def texts(self) -> Column:
        if self.given is not None:
            return self.given["texts"]
        return F.filter(self._listed(lambda t: t["tag"].isNull(), "text", lambda t: strip_ws(t["text"])), lambda x: x["text"] != "")

    def first_named(self, tag: str) -> Column:
        """Position of the first opening tag of a name, or -1."""
        return F.coalesce(F.array_position(self.names, F.lit(tag)).cast("int"), F.lit(0)) - 1

    def named(self, tag: str) -> Column:
        """Positions of the opening tags of a name."""
        return F.filter(F.transform(self.names, lambda n, i: F.when(n == tag, i)), lambda i: i.isNotNull())

    def hits(self, step) -> Column:
        """The opening tags that one step of a selector matches, in page order. Only tags that can match are looked at."""
        kind, value = ("", "") if isinstance(step, list) else step
        if kind == "tag":
            return F.transform(self.named(value), lambda at: F.get(self.tokens, at))
        if kind == "class*":
            found = F.filter(self.styled, lambda x: F.contains(x["cls"], F.lit(value)))
        elif kind == "class":
            found = F.filter(self.styled, lambda x: F.contains(x["cls"], F.lit(value)) & matches(F.get(self.tokens, x["at"]), step))
        elif kind == "id" or kind.startswith("attr:"):
            found = F.filter(self.marked, lambda x: F.contains(x["attrs"], F.lit(value)) & matches(F.get(self.tokens, x["at"]), step))
        else:
            return F.filter(self.tokens, lambda t: matches(t, step))
        return F.transform(found, lambda x: F.get(self.tokens, x["at"]))

    def first(self, step) -> Column:
        """The first of the `hits`, or NULL."""
        if not isinstance(step, list) and step[0] == "tag":
            return F.get(self.tokens, self.first_named(step[1]))
        return F.get(self.hits(step), F.lit(0))

    def classed(self, parts) -> Column:
        """The opening tags whose class has any of some parts, in page order."""
        found = F.filter(self.styled, lambda x: x["cls"].rlike("|".join(parts)))
        return F.transform(found, lambda x: F.get(self.tokens, x["at"]))


def running(values: Column, op, zero: Column) -> Column:
    """Running fold of a number array, each entry included. Blocks are folded on their own, then again from
    what the blocks before them add up to, so the appends stay short and the cost linear."""

    def grown(start: Column, block: Column) -> Column:
        return F.aggregate(block, F.array(start), lambda acc, x: F.array_append(acc, op(F.element_at(acc, -1), x)))

    def over(a: Column) -> Column:
        last = F.greatest(F.ceil(F.size(a) / BLOCK).cast("int") - 1, F.lit(0))
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * BLOCK + 1, BLOCK)), joined)

    def joined(blocks: Column) -> Column:
        carried = grown(zero, F.transform(blocks, lambda b: F.aggregate(b, zero, lambda x, y: op(x, y))))
        return let(carried, lambda c: F.flatten(F.transform(blocks, lambda b, i: F.slice(grown(F.get(c, i), b), 2, BLOCK))))

    return let(values, over)


_NOWHERE = 1 << 30


def next_position(positions: Column) -> Column:
    """Per token the first later one of some ascending positions; tokens after the last of them get no entry, which reads as NULL."""

    def repeated(at: Column) -> Column:
        return F.flatten(F.transform(at, lambda p, i: F.array_repeat(p, p - F.coalesce(F.get(at, i - 1), F.lit(0)))))

    return let(positions, repeated)


def last_value(n: Column, positions: Column, values: Column) -> Column:
    """Per one of `n` tokens the value at the last of some ascending positions up to it; -1 before the first."""

    def repeated(at: Column) -> Column:
        until = lambda i: F.coalesce(F.get(at, i + 1), n)
        reached = F.flatten(F.transform(values, lambda v, i: F.array_repeat(v, until(i) - F.get(at, i))))
        return F.concat(F.array_repeat(F.lit(-1), until(F.lit(-1))), reached)

    return let(positions, repeated)


def next_where(tokens: Column, pred) -> Column:
    """Per token the position of the first later token that matches, or NULL."""
    return next_position(F.transform(F.filter(tokens, pred), lambda t: t["pos"]))


@over_tokens
def parents(tokens: Column) -> Column:
    """Per token the position of the innermost element around it, or -1.

    The depth of a token is a running sum of elements that open and end; its parent is the last opening tag one level up before it,
    which is the neighbour to the left once opening tags and tokens are sorted by depth and position.
    """
    opens = lambda t: t["tag"].isNotNull() & ~t["close"] & (t["end"] > t["pos"])

    def deep(t: Column) -> Column:
        ends = F.sort_array(F.transform(F.filter(t, opens), lambda x: x["end"]))
        moves = F.sort_array(F.concat(
            F.transform(t, lambda x: F.struct(x["pos"].alias("pos"), F.lit(1).alias("kind"), F.when(opens(x), 1).otherwise(0).alias("by"))),
            F.transform(ends, lambda e: F.struct(e.alias("pos"), F.lit(0).alias("kind"), F.lit(-1).alias("by"))),
        ))
        return let(moves, placed)

    def placed(m: Column) -> Column:
        sums = running(F.transform(m, lambda x: x["by"]), lambda x, y: x + y, F.lit(0))

        def rows(l: Column) -> Column:
            here = F.transform(m, lambda x, i: F.struct((F.get(l, i) - x["by"]).alias("depth"), x["pos"].alias("pos"), x["kind"].alias("kind"), (x["by"] == 1).alias("opens")))
            both = F.concat(
                F.transform(F.filter(here, lambda x: (x["kind"] == 1) & x["opens"]), lambda x: F.struct((x["depth"] + 1).alias("depth"), x["pos"].alias("pos"), F.lit(0).alias("asks"))),
                F.transform(F.filter(here, lambda x: x["kind"] == 1), lambda x: F.struct(x["depth"].alias("depth"), x["pos"].alias("pos"), F.lit(1).alias("asks"))),
            )
            return let(F.sort_array(both), answered)

        return let(sums, rows)

    def answered(b: Column) -> Column:
        key = lambda x: x["depth"].cast("bigint") * _NOWHERE + x["pos"]
        last = running(F.transform(b, lambda x: F.when(x["asks"] == 0, key(x)).otherwise(F.lit(-1).cast("bigint"))), F.greatest, F.lit(-1).cast("bigint"))

        def told(l: Column) -> Column:
            def parent(x: Column, seen: Column) -> Column:
                return F.when((seen >= 0) & (F.floor(seen / _NOWHERE) == x["depth"]), F.pmod(seen, F.lit(_NOWHERE)).cast("int")).otherwise(-1)

            every = F.transform(b, lambda x, i: F.when(x["asks"] == 1, F.struct(x["pos"].alias("pos"), parent(x, F.get(l, i)).alias("parent"))))
            return F.transform(F.sort_array(F.filter(every, lambda x: x.isNotNull())), lambda x: x["parent"])

        return let(last, told)

    return let(tokens, deep)


def attr(attrs: Column, name: str) -> Column:
    """Value of one attribute of a raw attribute text, quoted or not."""
    pattern = rf"""(?is)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    # a list of all matches is NULL-safe and mentions the text once, unlike a comparison with the empty string
    raw = F.get(F.regexp_extract_all(attrs, F.lit(pattern), F.lit(1)), F.lit(0))
    return decode_entities(F.regexp_replace(raw, r"""^["']|["']$""", ""))


def _filled(c: Column) -> Column:
    """`null_if_empty` of a costly expression, which is computed once. In lambdas, Spark writes out what `nullif` compares twice."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def page_text(html: Column, visible: Column | None = None) -> Column:
    """Page text as a browser would print it: block elements are line breaks, blanks are squeezed."""
    body = F.regexp_replace(visible_html(html) if visible is None else visible, r"(?is)^.*<body\b[^>]*>", "")
    return _rendered(F.regexp_replace(body, r"(?is)<head\b.*?</head\s*>", ""))


def _rendered(fragment: Column) -> Column:
    blanks = F.regexp_replace(fragment, r"\s+", " ")
    lines = F.regexp_replace(blanks, rf"(?i) ?</?(?:{_BLOCK})(?:\s[^>]*)?/?> ?", "\n")
    bare = decode_entities(F.regexp_replace(lines, "<[^>]*>", ""))
    return strip_ws(F.regexp_replace(bare, r"[ ]*\n\s*", "\n"))


def page_title(html: Column) -> Column:
    found = F.call_function("regexp_extract", html, F.lit(r"(?i)<title[^>]*>([^<]*)</title>"), F.lit(1))
    return F.when(html.rlike(r"(?i)<title[^>]*>[^<]*</title>"), strip_ws(found)).otherwise("unknown")


# ---- selectors ------------------------------------------------------------------------------


#: Steps of a selector: a condition `("tag", "h1")`, `("class", x)`, `("class*", x)`, `("id", x)` or `("attr:<name>", x)`, or a list of
#: conditions that must all hold. A path is a tuple of steps with CHILD or INSIDE between them.
CHILD, INSIDE = ">", " "


def matches(t: Column, step) -> Column:
    """Does an opening tag match a step?"""
    if isinstance(step, list):
        hits = [matches(t, one) for one in step]
        return hits[0] if len(hits) == 1 else hits[0] & matches(t, step[1:])
    kind, value = step
    if kind == "tag":
        hit = t["tag"] == value
    elif kind == "class":
        hit = F.contains(t["cls"], F.lit(value)) & F.concat(F.lit(" "), squeeze_ws(t["cls"]), F.lit(" ")).contains(f" {value} ")
    elif kind == "class*":
        hit = F.contains(t["cls"], F.lit(value))
    elif kind == "id":
        hit = F.contains(t["attrs"], F.lit(value)) & (attr(t["attrs"], "id") == value)
    elif kind.startswith("attr:"):
        hit = F.contains(t["attrs"], F.lit(value)) & (attr(t["attrs"], kind[5:]) == value)
    else:
        raise ValueError(f"unknown selector {step}")
    return F.coalesce(~t["close"] & t["tag"].isNotNull() & hit, F.lit(False))


def _is_path(selector) -> bool:
    return isinstance(selector, tuple) and any(s in (CHILD, INSIDE) for s in selector[1::2] if isinstance(s, str)) and len(selector) > 2


def reaches(tokens: Column, opened: Column) -> Column:
    """Per token how far the elements of some opening tags (in page order) that start up to it reach, -1 before the first; without any, nothing."""
    furthest = lambda o: running(F.transform(o, lambda t: t["end"]), F.greatest, F.lit(-1))
    at = lambda o: F.transform(o, lambda t: t["pos"])
    return let(opened, lambda o: F.when(F.size(o) > 0, last_value(F.size(tokens), at(o), furthest(o))).otherwise(F.array().cast("array<int>")))


def reached(reach: Column, pos: Column, itself: bool = True) -> Column:
    """Whether the token at a position lies in one of the elements of `reaches`; with `itself`, an opening tag lies in its element."""
    return F.coalesce(F.get(reach, pos if itself else pos - 1) > pos, F.lit(False))


def covered(tokens: Column, marked: Column, itself: bool = True) -> Column:
    """Per token whether it lies in an element whose opening tag is marked (a boolean array); with `itself`, that tag counts as inside."""
    reach = reaches(tokens, let(marked, lambda m: F.filter(tokens, lambda t, i: F.get(m, i))))

    def inside_any(r: Column) -> Column:
        return F.transform(tokens, lambda t, i: reached(r, i, itself))

    return let(reach, inside_any)


def marks(tokens: Column, selector) -> Column:
    """Per token whether it is an opening tag that the selector matches."""
    if not _is_path(selector):
        return F.transform(tokens, lambda t: matches(t, selector))
    found = F.transform(tokens, lambda t: matches(t, selector[0]))

    def narrowed(reached: Column, step) -> Column:
        return let(reached, lambda w: F.transform(tokens, lambda t, i: matches(t, step) & F.get(w, i)))

    def child(m: Column) -> Column:
        # nothing below an element that is not there
        of = let(parents(tokens), lambda p: F.transform(p, lambda at: (at >= 0) & F.coalesce(F.get(m, at), F.lit(False))))
        return F.when(F.exists(m, lambda x: x), of).otherwise(m)

    for way, step in zip(selector[1::2], selector[2::2]):
        found = narrowed(let(found, child) if way == CHILD else covered(tokens, found, itself=False), step)
    return found


def select_all(tokens: Column, selector) -> Column:
    """All opening tags that the selector matches, in page order."""
    if not _is_path(selector):
        return F.filter(tokens, lambda t: matches(t, selector))
    return let(marks(tokens, selector), lambda m: F.filter(tokens, lambda t, i: F.get(m, i)))


def element_end(tokens: Column, opened: Column) -> Column:
    """Position of the token that ends element `opened` (an opening tag token)."""
    return opened["end"]


def span(tokens: Column, opened: Column) -> Column:
    """`{from, to}` of an element; NULL for a missing one."""
    return F.when(opened.isNotNull(), F.struct(opened["pos"].alias("from"), opened["end"].alias("to")))


def inside(tokens: Column, rng: Column) -> Column:
    """Tokens strictly inside a span."""
    return F.slice(tokens, rng["from"] + 2, F.greatest(rng["to"] - rng["from"] - 1, F.lit(0)))


def text_of(part: Column) -> Column:
    """Concatenated text of some tokens, trimmed."""
    return strip_ws(F.array_join(F.transform(part, lambda t: F.coalesce(t["text"], F.lit(""))), ""))


def lines_of(part: Column) -> Column:
    """Rendered text of some tokens: block tags break lines, other blanks are squeezed."""
    printed = F.transform(
        part,
        lambda t: F.when(t["tag"].isNull(), F.regexp_replace(t["text"], r"\s+", " ")).when(
            one_of(t["tag"], [_BLOCK]), F.lit("\n")
        ).otherwise(""),
    )
    return strip_ws(F.regexp_replace(F.array_join(printed, ""), r"[ ]*\n\s*", "\n"))


def element_text(tokens: Column, opened: Column, render=text_of) -> Column:
    """Text of an element given its opening token; NULL without one."""
    return F.when(opened.isNotNull(), let(span(tokens, opened), lambda s: render(inside(tokens, s))))


def first_element(tokens: Column, selector, outline: Column | None = None) -> Column:
    if outline is None:
        return F.get(select_all(tokens, selector), F.lit(0))
    there = Outline(tokens, outline)
    if not _is_path(selector):
        return there.first(selector)
    # nothing to follow where the path does not begin
    return F.when(F.size(there.hits(selector[0])) > 0, F.get(select_all(tokens, selector), F.lit(0)))


@over_tokens
def select_text(tokens: Column, selectors, render=text_of, outline: Column | None = None) -> Column:
    """Text of the first element of the first selector that gives any."""
    return F.coalesce(
        *[
            _filled(let(first_element(tokens, s, outline), lambda o: element_text(tokens, o, render)))
            for s in selectors
        ]
    )


@over_tokens
def select_attr(tokens: Column, selectors, name: str, outline: Column | None = None) -> Column:
    """Attribute of the first element of the first selector that has it."""
    return F.coalesce(*[_filled(attr(first_element(tokens, s, outline)["attrs"], name)) for s in selectors])


@over_tokens
def anchors(tokens: Column) -> Column:
    """Every `<a href>` as `{pos, href, rel, text}`, in page order."""
    opened = F.filter(tokens, lambda t: matches(t, ("tag", "a")))
    found = F.transform(
        opened,
        lambda o: F.struct(
            o["pos"].alias("pos"),
            attr(o["attrs"], "href").alias("href"),
            attr(o["attrs"], "rel").alias("rel"),
            element_text(tokens, o).alias("text"),
        ),
    )
    return F.filter(found, lambda a: a["href"].isNotNull())


def hrefs(html: Column) -> Column:
    """Raw href of every anchor, in page order, straight from the markup."""
    opened = F.regexp_extract_all(
        visible_html(html), F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1)
    )
    return F.transform(opened, lambda h: decode_entities(F.regexp_replace(h, r"""^["']|["']$""", "")))


# ---- labelled values and sections -----------------------------------------------------------


def next_tag(tokens: Column, pos: Column) -> Column:
    """First tag token after a position: an opening one is the next sibling, a closing one ends the parent."""
    return F.get(tokens, F.get(tokens, pos)["next"])


# tokens after a label among which its cell mostly ends
_NEAR = 8
_LABEL_TAGS = ["span", "p", "div", "label", "td", "th", "dt", "h5", "h6", "small"]


def _label_name(text: Column) -> Column:
    return strip_ws(F.regexp_replace(F.lower(strip_ws(text)), ":$", ""))


@over_tokens
def label_value_grid(tokens: Column, outline: Column | None = None) -> Column:
    """Array `{field, value, pos}`: each known label cell with the value next to it."""
    fields = text_map(vocab.GRID_LABELS)
    names = list(vocab.GRID_LABELS)

    def acceptable(text: Column) -> Column:
        return let(text, lambda x: F.when((F.length(x) < 200) & ~one_of(F.lower(x), names), null_if_empty(x)))

    def open_text(tag: Column) -> Column:
        return F.when(~tag["close"], element_text(tokens, tag, lines_of))

    def value_after(cell: Column) -> Column:
        # the sibling of the label element; else, one level up, the sibling of its parent
        def from_sibling(sib: Column) -> Column:
            above = F.when(sib["close"], sib)
            beside_parent = let(
                above, lambda up: let(next_tag(tokens, up["pos"]), lambda n: F.when(
                    up["tag"] == "td", open_text(n)).otherwise(acceptable(open_text(n))))
            )
            own = let(open_text(sib), lambda here: F.coalesce(acceptable(here), F.when(cell["tag"] == "td", null_if_empty(here))))
            return F.coalesce(own, beside_parent)

        return let(next_tag(tokens, cell["pos"]), from_sibling)

    def is_label(x: Column) -> Column:
        # most texts fail the first two tests, which trim nothing
        able = (F.length(x["text"]) <= 60) & F.lower(x["text"]).rlike(f"^(?:{'|'.join(names)})[^a-z0-9]*$")
        return able & one_of(_label_name(x["text"]), names) & (F.length(F.get(tokens, x["at"])["text"]) <= 60)

    skipped = lambda t: F.coalesce((t["close"] & ~one_of(t["tag"], _LABEL_TAGS)) | (t["tag"].isNull() & (strip_ws(t["text"]) == "")), F.lit(False))

    def near(x: Column) -> Column:
        stop = first_where(F.slice(tokens, x["at"] + 2, _NEAR), lambda t: ~skipped(t))
        return let(stop, lambda t: F.struct(x["at"].alias("at"), _label_name(x["text"]).alias("name"), t.alias("stop"), (t.isNull() & (F.size(tokens) > x["at"] + 1 + _NEAR)).alias("far")))

    def pairs(found: Column) -> Column:
        # only a label with many closing tags after it asks for the next stop of every token
        stops = F.when(F.exists(found, lambda x: x["far"]), next_where(tokens, lambda t: ~skipped(t)))

        def pair(x: Column, far: Column) -> Column:
            # the closing tag of the label's cell; inline tags such as <b> around the label are skipped
            stop = F.when(x["far"], F.get(tokens, F.get(far, x["at"]))).otherwise(x["stop"])
            closer = let(stop, lambda t: F.when(t["close"] & one_of(t["tag"], _LABEL_TAGS), t))
            return F.struct(
                F.try_element_at(fields, x["name"]).alias("field"),
                let(closer, lambda cell: F.when(cell.isNotNull(), value_after(cell))).alias("value"),
                x["at"].alias("pos"),
            )

        return let(stops, lambda far: F.transform(found, lambda x: pair(x, far)))

    labels = F.transform(F.filter(Outline(tokens, outline).texts, is_label), near)
    return F.filter(let(labels, pairs), lambda p: p["value"].isNotNull())


def grid_fields(grid: Column) -> Column:
    """The grid as a struct; the first value of a field wins."""

    def fields(g: Column) -> Column:
        def pick(field: str) -> Column:
            return first_where(g, lambda p: p["field"] == field)["value"].alias(field)

        return F.struct(*[pick(f) for f in dict.fromkeys(vocab.GRID_LABELS.values())])

    return let(grid, fields)


_HEADINGS = ["h2", "h3", "h4", "h5", "b", "strong"]
_HEADING_CLASSES = ["section-title", "section-heading", "heading"]
_ITEM_CLASSES = ["item", "tag", "badge", "chip", "feature", "amenity"]


@over_tokens
def section_headings(tokens: Column, outline: Column | None = None) -> Column:
    """`{at, text}` of the texts that stand first in a heading or in an element styled as one, in lower case."""

    def heads(x: Column, names: Column) -> Column:
        tag = F.get(names, x["at"] - 1)
        return (F.length(x["text"]) < 60) & tag.isNotNull() & (one_of(tag, _HEADINGS) | _any_class(F.get(tokens, x["at"] - 1), _HEADING_CLASSES))

    there = Outline(tokens, outline)
    found = let(there.names, lambda names: F.filter(there.texts, lambda x: heads(x, names)))
    return F.transform(found, lambda x: F.struct(x["at"].alias("at"), F.lower(x["text"]).alias("text")))


@over_tokens
def section_items(tokens: Column, heading: str, headings: Column | None = None) -> Column:
    """Distinct item texts (2 to 80 characters) of the section under a heading that matches. `headings` are those of the page, where
    several sections are asked for."""
    # `heading` is a lower-case pattern over the trimmed heading text
    titled = first_where(section_headings(tokens) if headings is None else headings, lambda x: x["text"].rlike(heading))
    found = F.get(tokens, titled["at"] - 1)

    def container(head: Column) -> Column:
        end = element_end(tokens, head)

        def choose(beside: Column) -> Column:
            # next element with children, else the element after the parent
            return let(F.when(~beside["close"], span(tokens, beside)), lambda own: pick(beside, own))

        def pick(beside: Column, own: Column) -> Column:
            has_children = F.exists(inside(tokens, own), lambda t: t["tag"].isNotNull() & ~t["close"])
            after_own = let(next_tag(tokens, own["to"]), lambda n: F.when(n["close"], n["pos"]))
            parent_end = F.when(beside["close"], beside["pos"]).otherwise(after_own)
            beside_parent = let(next_tag(tokens, parent_end), lambda n: F.when(~n["close"], span(tokens, n)))
            return F.when(F.coalesce(has_children, F.lit(False)), own).otherwise(beside_parent)

        return let(next_tag(tokens, end), choose)

    def items(box: Column) -> Column:
        return let(inside(tokens, box), item_texts)

    def item_texts(part: Column) -> Column:
        marked = F.filter(part, lambda t: ~t["close"] & ((t["tag"] == "li") | _any_class(t, _ITEM_CLASSES)))
        texts = F.when(F.size(marked) > 0, F.transform(marked, lambda o: element_text(tokens, o, lines_of))).otherwise(
            F.transform(F.filter(part, lambda t: t["tag"].isNull()), lambda t: strip_ws(t["text"]))
        )
        kept = F.filter(texts, lambda x: F.length(x).between(2, 80) & ~F.lower(x).rlike(heading))
        return F.array_distinct(kept)

    none = F.array().cast("array<string>")
    boxed = let(found, lambda head: F.when(head.isNotNull(), container(head)))
    return F.coalesce(let(boxed, lambda box: F.when(box.isNotNull(), items(box))), none)


def _any_class(t: Column, parts) -> Column:
    return F.coalesce(t["cls"].rlike("|".join(parts)), F.lit(False))


# ---- overview, poster, address --------------------------------------------------------------

OVERVIEW_LIVE = [
    ("class*", "description"), ("class*", "overview"), ("class*", "ad-detail"), ("attr:itemprop", "description"),
]
OVERVIEW_DETAILS = [
    ("class*", "overview-content"), (("class*", "overview"), CHILD, ("tag", "p")), ("class*", "description-content"),
    ("class*", "ad-description"), ("class*", "description"), ("attr:itemprop", "description"),
]


@over_tokens
def overview_pick(tokens: Column, selectors=OVERVIEW_DETAILS, longer_than: int = 30, below_heading: bool = True, outline: Column | None = None) -> Column:
    """Rendered text of the first description block that is long enough, else what follows an "Overview" heading."""
    printed = [let(first_element(tokens, s, outline), lambda o: element_text(tokens, o, lines_of)) for s in selectors]
    # a block is only looked for where those before it are too short
    block = F.coalesce(*[let(p, lambda x: F.when(F.length(x) > longer_than, x)) for p in printed])
    if not below_heading:
        return block
    heading = first_where(
        Outline(tokens, outline).texts,
        lambda x: (F.lower(x["text"]) == "overview") & F.coalesce(F.get(tokens, x["at"] - 1)["tag"].isin("h2", "h3", "h4"), F.lit(False)),
    )
    below = let(
        heading,
        lambda h: let(next_tag(tokens, h["at"] + 1), lambda n: F.when(~n["close"], element_text(tokens, n, lines_of))),
    )
    return F.coalesce(block, null_if_empty(below))


POSTER_BLOCKS = [("class*", k) for k in ("info", "meta", "footer", "detail", "overview")] + [("tag", "table"), ("class*", "posted")]
_POSTER_LABELS = ["span", "label", "div", "p", "td", "th", "li"]


@over_tokens
def posted_by_cascade(tokens: Column, text: Column, outline: Column | None = None) -> Column:
    """Poster: from the page text, else from any info block, else from what stands beside any "Posted by" label: the next
    element, or the text that follows."""
    from adloom.functions.pagetext import posted_by_rest_of_line

    def in_blocks(hits: Column) -> Column:
        said = lambda o: null_if_empty(posted_by_rest_of_line(element_text(tokens, o, lines_of)))
        of_kind = lambda k: F.transform(F.filter(hits, lambda x: F.array_contains(x["kinds"], k)), lambda x: said(x["token"]))
        found = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(len(POSTER_BLOCKS) - 1)), of_kind))
        return first_where(found, lambda x: x.isNotNull())

    labels = F.filter(
        tokens,
        lambda t: t["tag"].isNull() & t["text"].rlike(vocab.POSTED_BY_LABEL) & F.coalesce(one_of(F.get(tokens, t["pos"] - 1)["tag"], _POSTER_LABELS), F.lit(False)),
    )

    def beside(label: Column) -> Column:
        def after(closing: Column) -> Column:
            sibling = let(F.get(tokens, closing["next"]), lambda n: F.when(~n["close"], null_if_empty(element_text(tokens, n, lines_of))))
            loose = let(F.get(tokens, closing["pos"] + 1), lambda n: F.when(n["tag"].isNull(), null_if_empty(strip_ws(n["text"]))))
            return F.when(closing["close"], F.coalesce(sibling, loose))

        return let(F.get(tokens, label["pos"] + 1), after)

    return F.coalesce(
        posted_by_rest_of_line(text), let(_hits(tokens, POSTER_BLOCKS, outline), in_blocks), first_where(F.transform(labels, beside), lambda x: x.isNotNull())
    )


@over_tokens
def neighborhood_links(tokens: Column, outline: Column | None = None) -> Column:
    """Distinct texts of the links inside neighbourhood blocks, in page order."""
    there = Outline(tokens, outline)
    inner = lambda r: F.filter(there.hits(("tag", "a")), lambda a: reached(r, a["pos"], itself=False))
    blocks = there.hits(("class*", "neighborhood"))
    links = let(blocks, lambda b: F.when(F.size(b) > 0, let(reaches(tokens, b), inner)).otherwise(F.slice(tokens, 1, 0)))
    return F.array_distinct(F.filter(F.transform(links, lambda a: element_text(tokens, a, lines_of)), lambda x: x != ""))


@over_tokens
def amenity_labels(tokens: Column, outline: Column | None = None) -> Column:
    """Texts of everything that is styled as an amenity, a feature or a facility."""
    styled = Outline(tokens, outline).classed(["amenity", "amenities", "feature", "facility"])
    return F.transform(styled, lambda o: element_text(tokens, o))


def address_text_near_h1(tokens: Column, outline: Column | None = None) -> Column:
    """Text of the first of five elements after the `h1` that looks like an address."""
    start = first_element(tokens, ("tag", "h1"), outline)["end"]
    state = F.struct(start.alias("at"), F.lit(None).cast("string").alias("hit"))

    def step(acc, _):
        def look(n: Column) -> Column:
            text = F.when(~n["close"], element_text(tokens, n, lines_of))
            end = F.when(~n["close"], n["end"])
            return F.struct(end.alias("at"), let(text, lambda x: F.when(x.rlike(vocab.ADDRESS_NEAR_TITLE), x)).alias("hit"))

        return F.when(acc["hit"].isNotNull() | acc["at"].isNull(), acc).otherwise(let(next_tag(tokens, acc["at"]), look))

    return F.aggregate(F.sequence(F.lit(1), F.lit(5)), state, step)["hit"]


@over_tokens
def address_near_h1(tokens: Column, outline: Column | None = None) -> Column:
    """`{full_address, city, state, zipcode, county, nearby_university}`."""

    def parts(t: Column) -> Column:
        fallback = select_text(tokens, [("attr:itemprop", "address"), ("class*", "address")], lines_of, outline)
        cut = t
        for tail in vocab.ADDRESS_TAILS:
            cut = F.regexp_replace(cut, tail, "")
        found = [strip_ws(grab(t, pattern, group)).alias(field) for field, (pattern, group) in vocab.TITLE_ADDRESS.items()]
        return F.struct(F.coalesce(null_if_empty(strip_ws(cut)), fallback).alias("full_address"), *found)

    return let(address_text_near_h1(tokens, outline), parts)


# ---- photos ---------------------------------------------------------------------------------

PHOTO = "array<struct<index:int,url:string,alt:string>>"


def image_reject(url: Column, alt: Column | None = None, side: Column | None = None,
                 pattern: str = vocab.IMAGE_REJECT, alt_pattern: str | None = None) -> Column:
    """True for anything that is no photo of the property: no URL, inline data, site assets, tiny sides."""
    bad = F.coalesce(url, F.lit("")).isin("") | url.startswith("data:") | url.rlike(f"(?i){pattern}")
    if alt is not None:
        bad = bad | F.coalesce(alt.rlike(f"(?i){alt_pattern or pattern}"), F.lit(False))
    if side is not None:
        bad = bad | F.coalesce(side.try_cast("int").between(1, vocab.MIN_IMAGE_SIDE - 1), F.lit(False))
    return F.coalesce(bad, F.lit(True))


def _source(attrs: Column, names) -> Column:
    return F.coalesce(*[_filled(attr(attrs, a)) for a in names])


def images(tokens: Column, outline: Column | None = None) -> Column:
    """Every image as `{pos, source, plain, alt, tiny, href}`; `href` is that of the link around it, unless that is a script or a fragment."""

    def rows(last_link: Column) -> Column:
        def row(t: Column) -> Column:
            side = lambda name: F.regexp_substr(attr(t["attrs"], name), F.lit(r"^\d+")).try_cast("int")
            tiny = F.exists(F.array(side("width"), side("height")), lambda x: F.coalesce(x.between(1, vocab.MIN_IMAGE_SIDE - 1), F.lit(False)))
            link = let(F.get(tokens, F.nullif(F.get(last_link, t["pos"]), F.lit(-1))), lambda a: F.when(a["end"] > t["pos"], strip_ws(attr(a["attrs"], "href"))))
            rest = lambda plain: F.coalesce(plain, _source(t["attrs"], vocab.IMAGE_SOURCES[2:]))
            return let(_source(t["attrs"], vocab.IMAGE_SOURCES[:2]), lambda plain: F.struct(
                t["pos"].alias("pos"), rest(plain).alias("source"), plain.alias("plain"),
                attr(t["attrs"], "alt").alias("alt"), tiny.alias("tiny"), let(link, lambda h: F.when((h != "") & ~h.rlike("^(javascript:|#)"), h)).alias("href"),
            ))

        return F.transform(there.hits(("tag", "img")), row)

    there = Outline(tokens, outline)
    return let(let(there.named("a"), lambda p: last_value(F.size(tokens), p, p)), rows)


def _bound(body, *values: Column) -> Column:
    """`let` for several values at once. The analyzer takes a turn per level of lambdas and has a hundred turns."""
    names = [f"v{i}" for i in range(len(values))]
    return let(F.struct(*[v.alias(n) for n, v in zip(names, values)]), lambda x: body(*[x[n] for n in names]))


def _in_sight(_: Column) -> Column:
    return F.lit(False)


def _within(rows: Column, box: Column, hidden=_in_sight) -> Column:
    return F.filter(rows, lambda x: (x["pos"] > box["from"]) & (x["pos"] < box["to"]) & ~hidden(x["pos"]))


def _boxes(tokens: Column, selectors, hidden=_in_sight, outline: Column | None = None) -> Column:
    """Per selector the span of the first element that it finds outside hidden parts, or NULL. The selectors are data to one expression."""

    def found(hits: Column) -> Column:
        first = lambda k: first_where(hits, lambda x: F.array_contains(x["kinds"], k) & ~hidden(x["token"]["pos"]))["token"]
        return F.transform(F.sequence(F.lit(0), F.lit(len(selectors) - 1)), lambda k: let(first(k), lambda o: span(tokens, o)))

    return let(_hits(tokens, selectors, outline), found)


def _hits(tokens: Column, selectors, outline: Column | None = None) -> Column:
    """`{token, kinds}` of the opening tags that any selector matches, in page order, with the numbers of those that do. Only tags that
    can match, by name or because they have attributes, are compared with every selector."""
    conditions = [s if isinstance(s, list) else [s] for s in selectors]
    tags = [one[0][1] for one in conditions if all(kind == "tag" for kind, _ in one)]
    able = lambda t: ~t["close"] & (F.contains(t["attrs"], F.lit("=")) | t["tag"].isin(*tags) if tags else F.contains(t["attrs"], F.lit("=")))
    kinds = lambda t: F.array_compact(F.array(*[F.when(matches(t, s), F.lit(k)) for k, s in enumerate(selectors)]))
    candidates = F.filter(tokens, able)
    if outline is not None and not tags:
        # attributes that hold none of the values match nothing, unless they spell them with character references
        spelled = "|".join(["&", *dict.fromkeys(re.escape(value) for one in conditions for _, value in one)])
        candidates = F.transform(F.filter(outline["marked"], lambda x: x["attrs"].rlike(spelled)), lambda x: F.get(tokens, x["at"]))
    compared = F.transform(candidates, lambda t: F.struct(t.alias("token"), kinds(t).alias("kinds")))
    return F.filter(compared, lambda x: F.size(x["kinds"]) > 0)


def _foreign(tokens: Column, classes, outline: Column | None = None) -> Column:
    """How far sections of some classes reach, as `reaches`."""
    return reaches(tokens, Outline(tokens, outline).classed(classes))


def _first_gallery(galleries: Column, result: str) -> Column:
    """Of an array of `{urls, n}`, one per gallery: all urls up to and including the first gallery that counts any."""
    start = F.struct(F.array().cast(result).alias("urls"), F.lit(False).alias("done"))

    def step(acc, g):
        return F.when(acc["done"] | g.isNull(), acc).otherwise(F.struct(F.array_union(acc["urls"], g["urls"]).alias("urls"), (g["n"] > 0).alias("done")))

    return F.aggregate(galleries, start, step)["urls"]


@over_tokens
def photos_from_html(tokens: Column, outline: Column | None = None, shots: Column | None = None) -> Column:
    """Photo URLs of the first gallery on the rendered page that yields any; sections about other ads are left out. A link around an
    image leads to the large photo; background images count. `shots` are the `images` of the page, where they are at hand."""

    def of(shots: Column, foreign: Column, styled: Column) -> Column:
        hidden = lambda pos: reached(foreign, pos)

        def photo(x: Column) -> Column:
            good = ~x["tiny"] & ~image_reject(x["source"], x["alt"], pattern=vocab.IMAGE_REJECT_LIVE, alt_pattern=vocab.IMAGE_REJECT_LIVE_ALT)
            return F.when(good, x["source"])

        def large(x: Column) -> Column:
            return F.when(~x["tiny"] & ~image_reject(x["href"], pattern=vocab.IMAGE_REJECT_LIVE), x["href"])

        def in_box(box: Column) -> Column:
            here = _within(shots, box, hidden)
            paired = F.flatten(F.transform(here, lambda x: F.array(photo(x), large(x))))
            back = F.filter(F.transform(_within(styled, box, hidden), lambda x: x["url"]), lambda u: u.isNotNull())
            n = F.size(F.filter(here, lambda x: photo(x).isNotNull())) + F.size(back)
            urls = F.filter(F.concat(paired, back), lambda u: u.isNotNull() & ~u.startswith("data:"))
            return F.when(box.isNotNull(), F.struct(urls.alias("urls"), n.alias("n")))

        return _first_gallery(F.transform(_boxes(tokens, vocab.GALLERIES, hidden, outline), in_box), "array<string>")

    backed = F.transform(
        F.filter(Outline(tokens, outline).marked, lambda x: F.contains(F.lower(x["attrs"]), F.lit("style")) & F.contains(attr(x["attrs"], "style"), F.lit("background-image"))),
        lambda x: F.struct(x["at"].alias("pos"), grab(attr(x["attrs"], "style"), vocab.BACKGROUND_URL).alias("url")),
    )
    foreign = _foreign(tokens, vocab.FOREIGN_SECTIONS, outline)
    return _bound(of, images(tokens, outline) if shots is None else shots, foreign, backed)


@over_tokens
def photos_static(tokens: Column, outline: Column | None = None, shots: Column | None = None) -> Column:
    """Photos `{index, url, alt}` of the first gallery in the page source that yields any: the rule for ads without a photo list."""

    def of(shots: Column, far: Column) -> Column:
        hidden = lambda pos: reached(far, pos, itself=False)
        good = lambda x: ~image_reject(x["source"], x["alt"], pattern=vocab.IMAGE_REJECT_STATIC, alt_pattern=vocab.IMAGE_REJECT_STATIC_ALT)

        def in_box(box: Column) -> Column:
            kept = F.filter(_within(shots, box, hidden), good)
            rows = F.transform(kept, lambda x, i: F.struct(i.cast("int").alias("index"), x["source"].alias("url"), null_if_empty(x["alt"]).alias("alt")))
            return F.when(box.isNotNull(), F.struct(rows.alias("urls"), F.size(rows).alias("n")))

        return _first_gallery(F.transform(_boxes(tokens, vocab.GALLERIES[: vocab.N_STATIC_GALLERIES], outline=outline), in_box), PHOTO)

    there = Outline(tokens, outline)

    def foreign(slides: Column) -> Column:
        # cards of a carousel and sections about other ads
        other = lambda x: (F.contains(x["cls"], F.lit("card")) & reached(slides, x["at"], itself=False)) | x["cls"].rlike("|".join(vocab.FOREIGN_SECTIONS))
        return reaches(tokens, F.transform(F.filter(there.styled, other), lambda x: F.get(tokens, x["at"])))

    hidden = let(reaches(tokens, there.hits(("class*", "carousel-item"))), foreign)
    return _bound(of, images(tokens, outline) if shots is None else shots, hidden)


@over_tokens
def photos_of_details(tokens: Column, photo_path: str = "", outline: Column | None = None, shots: Column | None = None) -> Column:
    """Photo URLs of the site's own photo block: marked images, images in figures with the links around them, and, with the path of the
    site's photo store, links to it and images of an opened viewer. Only without any of these, other galleries."""

    there = Outline(tokens, outline)

    def of(shots: Column, foreign: Column, figures: Column) -> Column:
        hidden = lambda pos: reached(foreign, pos)
        good = lambda urls: F.array_distinct(F.filter(urls, lambda u: ~image_reject(u, pattern=vocab.IMAGE_REJECT_DETAILS)))

        def own(box: Column) -> Column:
            here = _within(shots, box)
            marked = F.transform(
                F.filter(here, lambda x: F.coalesce(attr(F.get(tokens, x["pos"])["attrs"], "itemprop") == "photo", F.lit(False))), lambda x: x["plain"]
            )
            framed = F.flatten(F.transform(F.filter(here, lambda x: reached(figures, x["pos"], itself=False)), lambda x: F.array(x["source"], x["href"])))
            stored = F.array().cast("array<string>")
            if photo_path:
                links = _within(there.hits(("tag", "a")), box)
                stored = F.filter(F.transform(links, lambda a: attr(a["attrs"], "href")), lambda u: F.contains(u, F.lit(photo_path)))
            return F.coalesce(F.concat(marked, framed, stored), F.array().cast("array<string>"))

        def viewed() -> Column:
            if not photo_path:
                return F.array().cast("array<string>")

            def in_order(hits: Column) -> Column:
                of_viewer = lambda k: F.filter(hits, lambda x: F.array_contains(x["kinds"], k))
                opened = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(len(vocab.VIEWERS) - 1)), of_viewer))
                return F.flatten(F.transform(opened, lambda x: shown(x["token"])))

            return F.filter(let(_hits(tokens, vocab.VIEWERS, outline), in_order), lambda u: F.contains(u, F.lit(photo_path)))

        def shown(o: Column) -> Column:
            inner = F.filter(shots, lambda x: ((x["pos"] > o["pos"]) & (x["pos"] < o["end"])) | ((x["pos"] == o["pos"]) & (o["tag"] == "img")))
            return F.transform(inner, lambda x: x["plain"])

        def in_box(box: Column) -> Column:
            urls = good(F.transform(_within(shots, box, hidden), lambda x: x["source"]))
            return F.when(box.isNotNull(), F.struct(urls.alias("urls"), F.size(urls).alias("n")))

        block = first_where(_boxes(tokens, vocab.GALLERIES[:2], outline=outline), lambda b: b.isNotNull())
        first = let(let(block, lambda b: F.when(b.isNotNull(), own(b)).otherwise(F.array().cast("array<string>"))), lambda a: good(F.concat(a, viewed())))
        other = _first_gallery(F.transform(_boxes(tokens, vocab.DETAIL_GALLERIES, hidden, outline), in_box), "array<string>")
        return let(first, lambda f: F.when(F.size(f) > 0, f).otherwise(other))

    figures = reaches(tokens, there.hits(("tag", "figure")))
    foreign = _foreign(tokens, vocab.FOREIGN_TO_DETAILS, outline)
    return _bound(of, images(tokens, outline) if shots is None else shots, foreign, figures)


def photos_merge(json_urls: Column, page_urls: Column) -> Column:
    """JSON photos, then page photos not among them, as `{index, url}` in order."""
    added = F.filter(page_urls, lambda u: ~F.coalesce(F.array_contains(json_urls, u), F.lit(False)))
    return F.transform(F.concat(json_urls, added), lambda u, i: F.struct(i.cast("int").alias("index"), u.alias("url")))
