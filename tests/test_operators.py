"""Operators against brute force on small inputs, with busy keys."""

import json
import math
import random

from pyspark.sql import functions as F

from adloom.functions import urls as U
from adloom.operators import crawl as C
from adloom.operators import document as D
from adloom.operators import frontier as L
from adloom.operators import geo as G
from adloom.operators import merge as M
from adloom.operators import quality as Q
from adloom.operators import ranking as R
from adloom.operators import state as S
from adloom.operators.frontier import frontier_dedup
from adloom.session import new_table_path
from adloom.sources import tables
from adloom.streaming import streams as X

SITE = U.SiteProfile(domain="ads.example.com")


def brute_merge(docs):
    out = {}
    for doc in docs:
        if not isinstance(doc, dict):
            continue
        for k, v in doc.items():
            if isinstance(v, dict) and isinstance(out.get(k), dict):
                out[k] = brute_merge([out[k], v])
            else:
                out[k] = v
    return out


def leaves(doc, path=()):
    for k, v in doc.items():
        if isinstance(v, dict) and v:
            yield from leaves(v, (*path, k))
        else:
            yield ".".join((*path, k)), json.dumps(v, separators=(",", ":"))


def random_doc(rng, depth=0):
    if depth == 3 or rng.random() < 0.3:
        return rng.choice([1, "s", None, True, [1, 2], [], {}])
    return {k: random_doc(rng, depth + 1) for k in rng.sample("abc", rng.randint(0, 3))}


def test_deep_merge_equals_sequential_merge(spark):
    rng = random.Random(7)
    rows, want = [], set()
    for page in range(150):
        docs = [random_doc(rng) for _ in range(rng.randint(1, 5))]
        rows += [(page, i, json.dumps(x)) for i, x in enumerate(docs)]
        want |= {(page, p, v) for p, v in leaves(brute_merge(docs))}
    df = spark.createDataFrame(rows, "page_id int, rank int, body string").repartition(5).withColumn("body", F.try_parse_json("body"))
    out = M.json_deep_merge(df, ["page_id"], "rank", "body")
    assert {(r.page_id, ".".join(r.path), r.value) for r in out.collect()} == want


def test_first_n_small_and_large_agree(spark, monkeypatch):
    df = spark.range(5000).withColumn("k", F.hash("id") % 97).repartition(7)
    small = [r.id for r in R.first_n(df, ["k", "id"], 700).collect()]
    monkeypatch.setattr(R, "TOP_K_MAX", 10)
    large = [r.id for r in R.first_n(df, ["k", "id"], 700).collect()]
    assert sorted(small) == sorted(large) and len(large) == 700
    assert R.first_n(df, ["k"], 0).count() == 5000


def history(spark, n=3000):
    # one ad holds a third of all rows
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("bigint").alias("ad_id"),
        F.expr("timestamp_ntz '2026-01-01' + make_interval(0,0,0,cast(id % 11 as int))").alias("scraped_at"),
        F.col("id").alias("run_seq"), F.lit(1).alias("pos"), F.concat(F.lit("https://ads.example.com/a_rentals_b_"), F.col("id").cast("string")).alias("url"),
        F.when(F.col("id") % 4 > 0, F.lit(1.5)).alias("lat"), F.lit("L").alias("locality"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("metro"),
        F.col("id").cast("string").alias("payload"))
    return df


SCHEMA = "ad_id BIGINT, scraped_at TIMESTAMP_NTZ, run_seq BIGINT, pos INT, url STRING, lat DOUBLE, locality STRING, metro STRING, payload STRING"


def rows(df):
    return sorted(map(str, df.collect()))


def test_results_do_not_depend_on_partitioning(spark):
    hist = history(spark)
    for op in (S.dedup_by_ad, S.latest_by_ad, lambda x: S.save_cap(x, 40)):
        assert rows(op(hist.repartition(1))) == rows(op(hist.repartition(7)))


def test_upsert_keeps_complete_metro_and_replays(spark):
    hist = history(spark)
    old, new = hist.where("run_seq < 1500"), hist.where("run_seq >= 1500")
    path = new_table_path(spark, "t")
    S.upsert_ads(spark, path, old, SCHEMA, version=1)
    before = {r.ad_id: r for r in S.read_ads(spark, path, SCHEMA).collect()}
    after = {r.ad_id: r for r in S.upsert_ads(spark, path, new, SCHEMA, version=2).collect()}
    fresh = {r.ad_id: r for r in S.latest_by_ad(new).collect()}
    for ad, r in after.items():
        kept = before.get(ad)
        assert r.payload == (fresh.get(ad) or kept).payload
        complete = kept and kept.lat is not None
        assert r.metro == (kept.metro if complete or ad not in fresh else fresh[ad].metro)
    again = {r.ad_id: r for r in S.upsert_ads(spark, path, new, SCHEMA, version=2).collect()}
    assert again == after


def test_upsert_geo_only(spark):
    cols = "ad_id BIGINT, lat DOUBLE, locality STRING, metro STRING, payload STRING"
    stored = spark.createDataFrame([(1, 1.0, "a", "m", "old"), (2, None, "a", "m", "old")], cols)
    fresh = spark.createDataFrame([(1, 9.0, "z", "z", "new"), (2, 9.0, "z", "z", "new"), (3, 9.0, "z", "z", "new")], cols)
    assert sorted(map(tuple, S.upsert_geo_only(stored, fresh).collect())) == [(1, 1.0, "a", "m", "old"), (2, 9.0, "z", "z", "old"), (3, 9.0, "z", "z", "new")]


def test_frontier_dedup(spark):
    cand = spark.createDataFrame([("https://ads.example.com/a_1?x", "1", 0), ("https://ads.example.com/a_1#y", "1", 1), ("https://ads.example.com/a_2", "2", 2), ("https://ads.example.com/rentals?page=2", None, 3), ("https://ads.example.com/a_4", "4", 4)], "url string, ad_id string, pos int")
    seen_urls = spark.createDataFrame([("https://ads.example.com/a_2/",), ("https://ads.example.com/rentals?page=1",)], "url string")
    seen_ids = spark.createDataFrame([("4",)], "ad_id string")
    out = frontier_dedup(cand, seen_urls, seen_ids, SITE, ["pos"])
    assert sorted(r.pos for r in out.collect()) == [0, 3]


def test_nearest_place_against_all_pairs(spark):
    rng = random.Random(3)
    places = [(f"p{i}", rng.uniform(-60, 70), rng.uniform(-180, 180)) for i in range(300)]
    ads = [(i, rng.uniform(-60, 70), rng.uniform(-180, 180)) for i in range(200)] + [(1000 + i, 10.0, 179.9) for i in range(100)]
    ads += [(2000, 89.5, 3.0), (2001, -90.0, 0.0), (2002, -75.0, -179.9), (2003, None, 1.0), (2004, None, None)]
    got = G.nearest_place(spark.createDataFrame(ads, "ad_id int, lat double, lng double"), spark.createDataFrame(places, "place string, lat double, lng double"), crowd=4).collect()

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * G.EARTH_KM * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    assert sorted(r.ad_id for r in got) == sorted(a[0] for a in ads)
    for r in got:
        known = r.lat is not None and r.lng is not None
        assert r.place == (min((km(r.lat, r.lng, la, lo), p) for p, la, lo in places)[1] if known else None)


def test_nearest_place_in_one_crowded_city(spark):
    rng = random.Random(8)
    places = [(f"p{i}", 40.7 + rng.gauss(0, 0.01), -74.0 + rng.gauss(0, 0.01)) for i in range(1500)]
    ads = [(i, 40.7 + rng.gauss(0, 0.02), -74.0 + rng.gauss(0, 0.02)) for i in range(150)] + [(900, -33.0, 151.0), (901, 41.2, -74.0)]
    got = G.nearest_place(spark.createDataFrame(ads, "ad_id int, lat double, lng double"), spark.createDataFrame(places, "place string, lat double, lng double")).collect()

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * G.EARTH_KM * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    assert len(got) == len(ads) and all(r.place == min((km(r.lat, r.lng, la, lo), p) for p, la, lo in places)[1] for r in got)


def test_metro_from_point_equals_a_test_of_every_ring(spark):
    rng = random.Random(5)

    def star(x, y, n):
        return [(x + (2 + rng.random() * 3) * math.cos(6.283 * k / n), y + (2 + rng.random() * 3) * math.sin(6.283 * k / n)) for k in range(n)]

    rings = [[(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0)], [(1, 1), (1, 1)], *[star(rng.uniform(-8, 8), rng.uniform(-8, 8), n) for n in (3, 5, 40, 400)]]
    shapes = [(i, f"m{i}", i % 2, ",".join(f"{x} {y}" for x, y in ring)) for i, ring in enumerate(rings)]
    points = [(i, rng.uniform(-12, 12), rng.uniform(-12, 12)) for i in range(400)] + [(1000 + i, float(i % 5), float(i // 5)) for i in range(25)] + [(2000, None, 1.0)]

    def inside(lat, lng, ring):
        hit = False
        for k, (px, py) in enumerate(ring):
            qx, qy = ring[k - 1]
            if (py > lat) != (qy > lat) and lng < (qx - px) * (lat - py) / (qy - py) + px:
                hit = not hit
        return hit

    for cell in (1.0, 0.3):
        got = G.metro_from_point(spark.createDataFrame(points, "ad_id int, lat double, lng double"), spark.createDataFrame(shapes, "metro_id int, metro string, layer int, ring string"), cell).collect()
        assert len(got) == len(points)
        for r in got:
            around = [] if r.lat is None else [(layer, i, name) for (i, name, layer, _), ring in zip(shapes, rings) if inside(r.lat, r.lng, ring)]
            assert r.point_metro == (min(around)[2] if around else None), (r, around)


def test_metro_edges_move_once(spark):
    n = 4000
    ring = ",".join(f"{30 * math.cos(6.283185 * k / n)} {30 * math.sin(6.283185 * k / n)}" for k in range(n))
    bands = G.ring_bands(spark.createDataFrame([(1, "m", 0, ring)], "metro_id int, metro string, layer int, ring string"), 1.0)
    assert n <= bands.agg(F.sum(F.size("edges"))).first()[0] < 1.1 * n


def test_listing_progress_and_running_sums_of_a_long_listing(spark):
    rng = random.Random(2)
    pages = [(("long" if rng.random() < 0.6 else f"l{rng.randrange(4)}"), i, rng.randrange(500), [f"https://ads.example.com/a_rentals_b_{rng.randrange(60)}" for _ in range(rng.randrange(4))], rng.choice([None, rng.randrange(90)])) for i in range(600)]
    rows = [(name, f"https://ads.example.com/rentals/{name}?page={i}", no, ads, total) for name, i, no, ads, total in pages]
    df = spark.createDataFrame(rows, "listing string, url string, page_no int, detail_urls array<string>, total bigint").repartition(7)
    got = {r.url: r for r in L.listing_progress(df, SITE).collect()}
    for name in {r[0] for r in rows}:
        seen, most = set(), None
        for _, url, _, ads, total in sorted((r for r in rows if r[0] == name), key=lambda r: (r[2], r[1])):
            ids = {a.rsplit("_", 1)[1] for a in ads}
            most = total if most is None else most if total is None else max(most, total)
            r = got[url]
            assert (r.n_new, r.n_found, r.listing_total) == (len(ids - seen), len(seen | ids), most)
            seen |= ids


def test_running_sums_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BITS", 2)
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("v"))
    got = {r.id: r for r in R.running_sums(df, "g", ["id"], {"s": F.col("v")}, {"m": F.col("v")}).collect()}
    for g in range(3):
        total, most = 0, None
        for i in range(g, 500, 3):
            v = i % 7 or None
            total, most = total + (v or 0), most if v is None else max(most or 0, v)
            assert (got[i].s, got[i].m) == (total, most)


def test_crawl_reaches_what_a_plain_crawl_reaches(spark):
    rng = random.Random(6)
    site, pages = "https://ads.example.com", []
    for i in range(60):
        links = [f"/x_rentals_y_{rng.randrange(90)}" + rng.choice(["", "?a=1", "/"]) for _ in range(rng.randrange(4))]
        after = rng.choice([None, None, f"/rentals/l{rng.randrange(75)}", f"/rentals/l{i}"])
        others = [f"/rentals/l{rng.randrange(75)}" for _ in range(rng.randrange(3))]
        html = "".join(f'<a href="{u}">x</a>' for u in links + others) + (f'<a rel="next" href="{after}">n</a>' if after else "")
        pages.append((i, f"{site}/rentals/l{i}", html, links, after, others))
    starts = [f"{site}/rentals/l{i}" for i in (0, 1, 2)] + [f"{site}/x_rentals_y_500", f"{site}/rentals/l0/", None, "no url"]
    by_url = {url: (links, after, others) for _, url, _, links, after, others in pages}
    clean = lambda u: site + u.split("?")[0].rstrip("/")
    seen, ads, level, want, number = set(), set(), [], set(), 0
    for u in starts:
        key = u.rstrip("/") if u and u.startswith("http") else None
        if key and key not in seen:
            seen.add(key)
            label = "DETAIL" if "_rentals_" in key else "LISTING"
            ads |= {key.rsplit("_", 1)[1]} if label == "DETAIL" else set()
            want.add((0, label, key))
            level.append(key)
    while level:
        number, found = number + 1, []
        for key in sorted(k for k in level if k in by_url):
            links, after, others = by_url[key]
            follow = [clean(after)] if after and clean(after) != key else [clean(o) for o in others] + ([clean(after)] if after else [])
            found += [("DETAIL", clean(u)) for u in links] + [("LISTING", u) for u in follow]
        level = []
        for label, key in found:
            ad = key.rsplit("_", 1)[1] if label == "DETAIL" else None
            if key not in seen and ad not in ads:
                seen.add(key)
                ads |= {ad} - {None}
                want.add((number, label, key))
                level.append(key)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    out = C.crawl_rounds(df, spark.createDataFrame([(u,) for u in starts], "url string"), SITE)
    got = out.collect()
    assert {(r.round, r.label, r.page_key) for r in got} == want and len(got) == len(want)
    assert all(r.captured == (r.page_key in by_url) for r in got)
    few = C.crawl_rounds(df, spark.createDataFrame([(starts[0],)], "url string"), SITE, max_pages=2, max_items=3).collect()
    assert max(r.page for r in few) <= 2 and sum(r.label == "DETAIL" for r in few) <= 3
    assert C.crawl_rounds(df.limit(0), spark.createDataFrame([(starts[0],)], "url string"), SITE).count() == 1


def test_upsert_touches_only_the_buckets_of_a_batch(spark):
    from pathlib import Path

    path = new_table_path(spark, "buckets")
    S.upsert_ads(spark, path, history(spark), SCHEMA, version=0, buckets=16)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in Path(path, "data").rglob("*.parquet")}
    before, old = files(), rows(S.read_ads(spark, path, SCHEMA).where("ad_id <> 7"))
    one = history(spark).where("ad_id = 7").withColumn("payload", F.lit("new"))
    S.upsert_ads(spark, path, one, SCHEMA, version=1, buckets=16)
    after = files()
    assert len(set(before) - set(after)) <= 2 and len({f.split("bucket=")[1].split("/")[0] for f in set(after) - set(before)}) == 1
    assert rows(S.read_ads(spark, path, SCHEMA).where("ad_id <> 7")) == old
    kept = rows(S.read_ads(spark, path, SCHEMA))
    S.upsert_ads(spark, path, one.withColumn("payload", F.lit("a replay is not computed again")), SCHEMA, version=1, buckets=16)
    assert rows(S.read_ads(spark, path, SCHEMA)) == kept


def test_live_run_statistics_over_batches_and_a_restart(spark):
    src, out = new_table_path(spark, "log"), new_table_path(spark, "live")
    kinds = [*Q.COUNTERS, "error", "api", "api"]
    log = spark.range(900).select((F.col("id") % 4).alias("run_id"), F.element_at(F.array(*map(F.lit, kinds)), (F.col("id") % len(kinds) + 1).cast("int")).alias("kind"), F.concat(F.lit("https://api/x"), (F.col("id") % 13).cast("string"), F.lit("?q="), F.col("id").cast("string")).alias("url"))
    schema = "run_id long, kind string, url string"
    for part in range(2):  # the second round starts from the checkpoint of the first
        spark.createDataFrame([tuple(r) for r in log.collect()][450 * part : 450 * (part + 1)], schema).repartition(3).write.mode("append").parquet(src)
        X.stream_run_stats(X.file_stream(spark, src, schema, files_per_batch=1), out, out + "-c")
        assert rows(X.read_run_stats(spark, out).select(*Q.run_stats(log).columns)) == rows(Q.run_stats(spark.read.schema(schema).parquet(src)))


def test_nearest_place_far_away(spark):
    ads = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "ad_id int, lat double, lng double")
    one = spark.createDataFrame([("only", 0.0, 6.0), ("nowhere", None, 1.0)], "place string, lat double, lng double")
    assert sorted((r.ad_id, r.place) for r in G.nearest_place(ads, one).collect()) == [(1, "only"), (2, None)]
    assert [r.place for r in G.nearest_place(ads, one.limit(0)).collect()] == [None, None]


def test_document_variants_are_valid(spark):
    df = spark.sql("""SELECT id AS ad_id, named_struct('title', 'Flat', 'rent_amount', '$850 /Week') AS property,
      named_struct('ad_type', if(id % 2 = 0, 'Property Wanted', 'Property Offered'), 'posted_on', 'Jul 04, 2026', 'amenities', array('Elevator', 'Moon')) AS details,
      named_struct('languages', '["hindi","xx"]') AS preferences FROM range(4)""")
    docs = D.build_document(df, D.Owner(uid="u"))
    d = F.col("doc")
    got = docs.select("ad_id", "doc", Q.validate_required(d).alias("m"), Q.validate_enums(d).alias("e"), Q.validate_variant(d).alias("v")).orderBy("ad_id").collect()
    assert all(r.m == [] and r.e == [] and r.v for r in got)
    wanted, offered = got[0].doc, got[1].doc
    assert wanted.property_details is None and wanted.seeker.languages == ["Hindi"] and offered.room_details is None
    assert offered.details.amenities == ["elevator"] and float(offered.details.rent.amount) == 850 and offered.details.rent.mode == "per_week"
    assert str(offered.metadata.adexpirydate) == "2027-07-04" and wanted.search.property_type == "shared_room"


def test_stream_equals_batch(spark):
    src, out = new_table_path(spark, "src"), new_table_path(spark, "out")
    history(spark).repartition(4).write.parquet(src)
    stream = X.file_stream(spark, src, SCHEMA, files_per_batch=1)
    ids = X.run_to_files(X.stream_dedup(stream, "ad_id", spread_by="payload"), "ids")
    assert sorted(r.ad_id for r in ids.collect()) == sorted(r.ad_id for r in history(spark).select("ad_id").distinct().collect())
    X.stream_stats(stream, out, out + "-c", ["ad_id"])
    live = X.read_snapshot(spark, out, "ad_id BIGINT, n BIGINT")
    assert rows(live) == rows(history(spark).groupBy("ad_id").agg(F.count(F.lit(1)).alias("n")))
