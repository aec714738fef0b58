"""What detail pages cost: short rows are dealt out before they grow, and markup is read once for all who ask the same."""

from pyspark.sql import functions as F

from adloom.functions import html as H
from adloom.functions import jsonx as J
from adloom.functions.urls import SiteProfile
from adloom.operators import detail as D
from adloom.plans import details as PD
from adloom.sources.fixtures import fixture

SITE = SiteProfile(domain="ads.example.com")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_and_stored_geocodes_grow_behind_the_dealing_of_rows(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("id AS c_custkey", "'n' AS c_name").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    part = "id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, CAST(id AS INT) AS p_size"
    spark.range(50).selectExpr(*part.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    seen = []
    monkeypatch.setattr(D, "extract_detail_pages", lambda pages, bodies, site, geo, when: seen.extend([pages, bodies, geo.providers[0]]))
    monkeypatch.setattr(PD, "shown", lambda df: df)
    PD.extract_detail_pages(spark, str(tmp_path))
    for df, grown, name in zip(seen, ("</body>", "api title", "address_components"), ("f_detail", "f_bodies", "f_geo")):
        plan = optimized(df)
        assert "Repartition" in plan and grown not in plan[plan.rindex("Repartition"):]
        if name != "f_geo":
            assert sorted(map(tuple, df.collect())) == sorted(map(tuple, fixture(spark, str(tmp_path), name).collect()))


def test_markup_is_stripped_once_and_images_are_not_searched_for(spark, monkeypatch):
    calls = []
    for of, name in ((H, "visible_html"), (J, "json_ld"), (H, "images")):
        monkeypatch.setattr(of, name, lambda *args, f=getattr(of, name), n=name: calls.append(n) or f(*args))
    rows = spark.createDataFrame([(1, "https://ads.example.com/x_rentals_y_1", "<h1>a</h1>")], "page_id long, url string, html string")
    rows = rows.withColumns({"scraped_at": F.current_timestamp(), "bodies": F.lit(None).cast(D.BODIES)})
    D.detail_records(rows, SITE)
    assert sorted(calls) == ["json_ld", "visible_html"]


def test_stripped_markup_and_page_text_as_before(spark):
    pages = [
        "<head>x</head><body class=b>a<!-- <script> --><p>b<body>c<head >d</head\n>e<SCRIPT x>1</script >f", "<header>a</header><HEAD>b</head>c<style>p{}</style>d<scripts>e</scripts>",
        "a<!-- open <script>b</script>c", "<!---->a<styles>b", "", "no markup", "<body", "x<body>y</body>z",
    ]
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    stripped = F.regexp_replace("h", r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    text = H._rendered(F.regexp_replace(stripped, r"(?is)^.*<body\b[^>]*>|<head\b.*?</head\s*>", ""))
    for r in df.select(H.visible_html(F.col("h")).alias("a"), stripped.alias("b"), H.page_text(F.col("h")).alias("c"), text.alias("d")).collect():
        assert r.a == r.b and r.c == r.d


def test_state_variables_are_found_as_before_and_only_where_they_are_named(spark):
    pages = ['<script>window.__S__ = {"a":1};</script>', "<script>__S__ = {'a':1} ;window.__S__={\"a\":2}; </script>", "<script>window.__T__ = {};</script>", None, "__S__ = {\"a\":[3]}  ;"]
    got = spark.createDataFrame([(h,) for h in pages], "h string").select(F.to_json(J.json_window_var(F.col("h"), "__S__")).alias("v")).collect()
    assert [r.v for r in got] == ['{"a":1}', '{"a":2}', None, None, '{"a":[3]}']
