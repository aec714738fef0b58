"""Archives, urls and licences."""

import base64
import hashlib
import math
import os
import random
import re
import tempfile

from pyspark.sql import functions as F

from adloom.llm.license_scan import license_share, scan_licenses, template_scores
from adloom.llm.url_filter import Rule, TreeParams, judge_urls, templates
from adloom.llm.warc import read_warc, write_warc

FAKE = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def test_archives_round_trip_with_magic_inside_payloads(spark):
    pages = [
        (1, "http://a/\r\nx", b""), (2, None, b"abc"), (3, "u", b"abc"), (4, "u", FAKE), (5, "u", b"x" * 900 + FAKE * 20 + b"\xff\xfeWARC/1.0\r\n"),
        (6, "u", b"WARC/1.0\r\nContent-Length: 5000\r\n\r\n"), (7, "u", None), (8, "u", "é".encode() * 400), (9, "u", b"tail\r\n\r\n"), (10, "u", FAKE),
    ]
    path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "x")
    write_warc(spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, payload binary, same string").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {int(r.record_id[10:-1]): r for r in read_warc(spark, path, payloads=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == list(range(1, 11))
    assert {i: r.refers_to for i, r in got.items() if r.kind == "revisit"} == {3: "<urn:page:2>", 7: "<urn:page:1>", 10: "<urn:page:4>"}
    for i, _, payload in pages:
        payload = payload or b""
        assert got[i].payload_bytes == len(payload) and got[i].digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if got[i].kind == "response":
            assert bytes(got[i].payload) == payload and got[i].real_digest == got[i].digest


def test_rules_and_odd_urls(spark):
    rules = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))
    urls = ["http://A.Example.NET/en/x?q", "http://net", "http://net/", "http://xnet/", "http://example.com/de/1#a", "http://notexample.com/de/1", "x", None, "", "http://É.org/fr/?a://b/c", "a://b?c://net/", "http://h/" + "a/" * 300]
    rows = [(i, u, None, "c") for i, u in enumerate(urls)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, bad int, host string"), rules).collect()}
    assert got == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("net", "", None, "allow"), 2: ("net", "/", "net/", "block"), 3: ("xnet", "/", None, "allow"),
        4: ("example.com", "/de/1", "example.com/de/", "block"), 5: ("notexample.com", "/de/1", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("É.org", "/fr/", "org/fr/", "allow"), 10: ("b", "", None, "allow"), 11: ("h", "/" + "a/" * 300, None, "allow"),
    }


def test_bad_templates_are_rejected_and_similar_branches_merged(spark):
    rows = [(i, f"http://h/good/{i}", 0) for i in range(60)] + [(100 + i, f"http://h/spam/{i}.html", 1) for i in range(60)] + [(300, "http://h/spam/9.html", None), (301, "http://h/good/777", None)]
    rows += [(400 + i, f"http://k/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}x/item", None) for i in range(52)]
    got = {r.page_id: (r.template, r.verdict) for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, bad int"), ()).collect()}
    assert got[300][1] == "block" and got[301][1] == "allow" and got[300][0] != got[301][0]
    assert {got[400 + i] for i in range(52)} == {("/*/item", "allow")}
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, bad int"), ()).count() == 0


def plain_templates(rows, p=TreeParams()):
    """The tree by plain recursion; rows: (shape, n, labelled, bad) of one host."""
    out = {}

    def grow(members, made):
        k = 0
        while all(len(rest) > k for rest, *_ in members) and len({rest[k] for rest, *_ in members}) == 1:
            k += 1
        made = made + members[0][0][:k]
        members = [(rest[k:], *m) for rest, *m in members]
        if len({tuple(m[0]) for m in members}) == 1:
            for rest, shape, *_ in members:
                out[shape] = "/".join(made + rest)
            return
        going, by_value, totals = [m for m in members if m[0]], {}, [0, 0, 0]
        for m in members:
            if not m[0]:
                out[m[1]] = "/".join(made)
        pooled = {}
        for rest, _, *counts in going:
            child = rest[1] if len(rest) > 1 else ""
            by_value.setdefault(rest[0], {}).setdefault(child, []).append(counts)
            pooled[child] = pooled.get(child, 0) + counts[0]
            totals = [x + y for x, y in zip(totals, counts)]
        nodes = {}
        for value, children in by_value.items():
            n, labelled, bad = (sum(c[i] for cs in children.values() for c in cs) for i in range(3))
            overlap = sum(min(sum(c[0] for c in cs) / n, pooled[ch] / totals[0]) for ch, cs in children.items())
            rate = totals[2] / totals[1] if totals[1] else None
            alike = rate is None or abs(bad - labelled * rate) <= p.z * (labelled * rate * (1 - rate)) ** 0.5
            told = any(children) or (labelled > 0 and totals[1] > labelled)
            variable = len(by_value) >= p.fan_out and n < p.heavy * totals[0]
            text = "*" if len(by_value) > 1 and (variable or (told and alike and overlap >= p.overlap)) else value
            nodes.setdefault(text, []).extend((m[0][1:], *m[1:]) for m in going if m[0][0] == value)
        for text, inner in nodes.items():
            grow(inner, [*made, text])

    grow([(shape.split("/"), shape, *counts) for shape, *counts in rows], [])
    return out


def test_templates_equal_a_plain_tree(spark):
    rng = random.Random(3)
    hosts = {}
    for h in range(6):
        paths = {"/" + "/".join(rng.choice(["a", "b", "c", "users", f"u{rng.randrange(60)}", "edit", "view"]) for _ in range(rng.randrange(0, 6))) for _ in range(150)}
        hosts[f"h{h}"] = [(s, rng.randrange(1, 9), *rng.choice([(0, 0), (2, 1), (3, 3), (1, 0)])) for s in sorted(paths | {""})]
    hosts["users"] = [(f"/user{i:03d}x/slug{j}y/{leaf}", 1, 0, 0) for i in range(100) for j in range(3) for leaf in ("comments", "about", "stats")]
    hosts["static"] = [(s, 5, 0, 0) for s in ("/about", "/contact", "/privacy", "/login")]
    hosts["deep"] = [("/" + "a/" * 3000 + "x", 1, 0, 0), ("/" + "a/" * 3000 + "y", 1, 0, 0), ("/" + "b/" * 2000, 1, 0, 0)]
    rows = [(h, *r) for h, shapes in hosts.items() for r in shapes]
    df = spark.createDataFrame(rows, "host string, shape string, n long, labelled long, bad long")
    got = {(r.host, r.shape): r.template for r in templates(df).collect()}
    assert got == {(h, s): t for h, shapes in hosts.items() for s, t in plain_templates(shapes).items()}
    assert {t for (h, _), t in got.items() if h == "users"} == {"/*/*/comments", "/*/*/about", "/*/*/stats"}
    assert {t for (h, _), t in got.items() if h == "static"} == {"/about", "/contact", "/privacy", "/login"}


def test_licences_of_headers_files_and_ancestors(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [
        (1, "a/LICENSE", mit, True), (2, "a/b/c/x.txt", "code", False), (3, "a/b/y.txt", "code\n" + gpl + "\nmore", False), (4, "a/b/LICENSE", gpl, True), (5, "a/b/c/d/z.txt", None, None),
        (6, "ab/x.txt", "none", False), (7, None, "Licensed to nobody by a very long story about licensing that no template tells", False), (8, "a/q.txt", "All rights reserved.\n" + "w " * 50_000, False), (8, "a/q.txt", "All rights reserved.", False),
    ]
    got = scan_licenses(spark.createDataFrame([(*f, "x") for f in files], "file_id long, path string, text string, is_license_file boolean, license string"))
    assert sorted((r.file_id, r.license or "", r.origin, r.license_dir or "") for r in got.select("file_id", "license", "origin", "license_dir").distinct().collect()) == [
        (1, "MIT", "file", ""), (2, "GPL-3.0", "inherited", "a/b"), (3, "GPL-3.0", "header", ""), (4, "GPL-3.0", "file", ""), (5, "GPL-3.0", "inherited", "a/b"),
        (6, "", "none", ""), (7, "", "none", ""), (8, "proprietary", "header", ""),
    ]


def test_notices_of_several_lines_and_identifiers(spark):
    mit = "Permission is hereby granted, free of charge, to any person\n{0}obtaining a copy of this software, to deal in the\n{0}software without restriction."
    files = [
        (1, "a/x.py", "# SPDX-License-Identifier: MIT\ncode", False), (2, "a/y.py", "# SPDX-License-Identifier: Zlib\ncode", False), (3, "a/z.py", "#!/bin/sh\n\n# " + mit.format("# ") + "\nx = 1", False),
        (4, "a/z.c", "/* " + mit.format(" * ") + " */\nint x;", False), (5, "a/w.c", "int y; // nothing", False), (6, "a/v.c", "", None),
    ]
    df = spark.createDataFrame(files, "file_id long, path string, text string, is_license_file boolean")
    got = {r.file_id: r.license for r in scan_licenses(df).collect()}
    assert got == {1: "MIT", 2: None, 3: "MIT", 4: "MIT", 5: None, 6: None}
    assert scan_licenses(df.limit(0)).count() == 0
    shares = [r[0] for r in spark.createDataFrame([("All rights reserved.\nab",), ("text\n" * 9 + "license",), ("",), (None,)], "t string").select(license_share(F.col("t"))).collect()]
    assert shares[0] > 0.5 > shares[1] and shares[2:] == [0.0, 0.0]


def test_cosines_equal_a_plain_computation(spark):
    rng = random.Random(2)
    words = "license mit apache granted rights reserved under the terms of software version free code x y z".split()
    units = [(f"u{i}", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12))), rng.randrange(1, 4)) for i in range(80)]
    shapes = (("A", "licensed under the apache license version"), ("B", "mit license"), ("C", "all rights reserved"), ("D", "mit license"))
    split = lambda t: [x for x in re.split(r"[^\w]+|_", t.lower()) if x]
    total, df = sum(n for *_, n in units) + len(shapes), {}
    for _, text, n in units:
        for w in set(split(text)):
            df[w] = df.get(w, 0) + n
    known = {w for _, t in shapes for w in split(t)}

    def vector(text):
        return {w: split(text).count(w) * (math.log((total + 1) / ((df.get(w, 0) if w in known else 0) + 1)) + 1) for w in set(split(text))}

    want = {}
    for u, text, _ in units:
        v, best = vector(text), []
        for name, t in shapes:
            x = vector(t)
            score = round(sum(v[w] * x.get(w, 0) for w in v) / math.sqrt(sum(y * y for y in v.values()) * sum(y * y for y in x.values())), 9)
            best += [(-score, name)] if score >= 0.5 else []
        if best:
            want[u] = min(best)
    got = {r.unit: (-r.score, r.license) for r in template_scores(spark.createDataFrame(units, "unit string, text string, n long"), shapes, 0.5).collect()}
    assert got.keys() == want.keys() and len(want) > 3
    assert all(got[u][1] == want[u][1] and abs(got[u][0] - want[u][0]) < 1e-8 for u in want)
