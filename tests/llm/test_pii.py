"""Personal data: plain spans against the patterns as they are given, disguised ones against planted spellings."""

import hashlib
import random
import re
import time

from adloom.llm.pii import KINDS, detect, find, find_personal, luhn, spelled

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = [True, kind != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15]
            if good[kind]:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_plain_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(30_000):
        text = "".join(rng.choice("ab1.2@-+ ()c9.0@é") for _ in range(rng.randrange(60)))
        assert detect(text) == brute(text), text
        assert set(brute(text)) <= set(find(text)[1])


DISGUISED = [
    ("email", "bosbt.42 (at) mail8.example.com"), ("email", "bosbt [at] mail8 [dot] example [dot] com"), ("email", "bosbt at mail8 dot example dot com"),
    ("email", "bosbt{at}mail8{dot}com"), ("email", "j.doe at mail.com"), ("email", "pаypal@mail.com"), ("email", "ｂｏｂ＠ｍａｉｌ．ｃｏｍ"),
    ("email", "bob&#64;mail&#46;com"), ("email", "bob @ mail.com"), ("email", "bo​b@ma­il.com"), ("email", "BOB AT MAIL DOT EXAMPLE DOT COM"),
    ("ip", "four two dot one four four dot three five dot two five four"), ("ip", "42[.]144[.]35[.]254"), ("ip", "１９２.168.1.1"), ("ip", "42 dot 144 dot 35 dot 254"),
    ("card", "four zero four one eight nine four nine seven four six zero eight seven nine five"), ("card", "4O41 8949 7460 8795"), ("card", "4041​8949​7460​8795"),
    ("card", "4041–8949–7460–8795"), ("card", "vier-null-vier-eins acht neun vier neun sieben vier sechs null acht sieben neun fünf"), ("card", "٤٠٤١٨٩٤٩٧٤٦٠٨٧٩٥"),
    ("phone", "plus one nine eight eight five five five two four eight five"), ("phone", "+1 (nine eight eight) five five five - two four eight five"), ("phone", "＋1 988 555 2485"),
]


def test_disguised_spans_are_mapped_back_whole():
    for kind, said in DISGUISED:
        for before, after in (("", ""), ("write to éè ", " or not"), ("\U0001f642 (", ") а.")):
            text = before + said + after
            base, spans = find(text)
            assert (len(before), len(before) + len(said), KINDS.index(kind)) in spans, (text, spans)
            assert set(base) <= set(spans) and base == brute(text)


def test_ordinary_words_stay():
    for text in [
        "haha at knkbb.87@mail6.example.com foo", "look at the. Then go", "meet me at example.com", "see it at www.example.com", "one two three four", "the dot product at five plus 3",
        "30 m² at € 5", "Hé at éè.ê", "token = 63169548663bbc1ce380e67a23", "v. 1.2.3", "спасибо",
    ]:
        base, spans = find(text)
        assert spans == base, text


def test_time_is_linear_in_the_text():
    for text in ["1" * 300_000, "a" * 300_000, " " * 300_000, "one " * 80_000, "one" + "1" * 300_000 + "x", "|" * 300_000, "a@b" * 100_000, "( " * 100_000, "1.1.1." * 50_000, "l1" * 100_000, " at a." * 50_000]:
        started = time.time()
        find(text)
        assert time.time() - started < 10, text[:10]


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.cc, 1.2.3.4 and a at b dot cc", "x"), (3, "a@b.cc, 1.2.3.4 and a at b dot cc", "x"), (None, "y" * 200_000 + " a@b.cc", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = find_personal(docs, ("spans", "masked", "n_email", "n_ip", "n_card", "n_phone", "n_disguised", "base_sha256", "span_list")).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_disguised) for r in got) == [(0, 1, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 1, 1), (3, 1, 1, 1)]
    r = next(r for r in got if r.doc_id == 3)
    assert r.masked == "[email], [ip] and [email]"
    assert r.span_list == "email:0:6,ip:8:15,email:20:33" == spelled([(s.start, s.end, KINDS.index(s.kind)) for s in r.spans])
    assert r.base_sha256 == hashlib.sha256(b"email:0:6,ip:8:15").hexdigest() and [s.plain for s in r.spans] == [True, True, False]
    assert find_personal(docs.limit(0)).count() == 0
