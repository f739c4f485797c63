"""Generator and page-extraction jobs, checked against brute force."""

import html as html_lib
import json
import os
import re

from pyspark.sql import functions as F

from flexframe.plans import datagen, pages

SPEC = os.path.join(os.path.dirname(__file__), "fixtures", "example.yaml")


def test_example_spec(spark, tmp_path):
    spec = datagen.load_spec(SPEC)
    # the spec partitions the fact table by a microsecond date string (one folder per row);
    # partitioning is exercised on the low-cardinality suppressions table instead
    spec["tables"][1].pop("partitions")
    spec["tables"][2]["partitions"] = ["identifier_type"]
    written = datagen.generate_and_write(spark, spec, str(tmp_path))
    card = spark.read.parquet(written["card_dim_c"])
    assert card.count() == 1000
    r = card.where("card_id = 7").collect()[0]
    assert r.card_code == "00000000007" and r.hshd_isba_market_code == "isba00000000007"
    fct = spark.read.parquet(written["transaction_item_fct_data"])
    assert fct.count() == 10000
    stats = fct.agg(F.min("item_cost"), F.max("item_cost"), F.min("card_id"), F.max("card_id"),
                    F.min("date_id"), F.max("date_id")).collect()[0]
    assert 1 <= stats[0] and stats[1] <= 5 and 0 <= stats[2] and stats[3] <= 10
    assert "2017-01-01 21:16:30" <= stats[4] and stats[5] < "2018-01-01 20:10:11"
    assert all(round(r.item_cost, 2) == r.item_cost for r in fct.limit(100).collect())
    sup = spark.read.parquet(written["card_dim_c_suppressions"])
    assert {r.item_cd for r in sup.select("item_cd").distinct().collect()} <= {0, 1, 2, None}
    assert dict(sup.dtypes)["item_cd"] == "int"
    assert os.path.isdir(os.path.join(written["card_dim_c_suppressions"], "identifier_type=card_id"))


def test_generator_repeats_with_seed(spark):
    t = {"name": "t", "rows": 50, "seed": 5, "columns": [{"name": "r", "column_type": "Random", "min": 0, "max": 100}]}
    a = [r.r for r in datagen.generate_table(spark, t, num_partitions=3).collect()]
    b = [r.r for r in datagen.generate_table(spark, t, num_partitions=3).collect()]
    assert a == b


def _brute_top_links(html, limit, offset, ok):
    items = [x for x in re.findall(r'href="([^"]*)"', html) if x != ""]
    skipped = items[max(offset, 1) - 1:]
    good = [x for x in skipped if ok(x)]
    return good[: max(limit - max(offset, 1) + 1, 0)]


def test_top_links_brute_force(spark):
    docs = ['<a href="a"></a><a href="b,"></a><a href=""></a><a href="c"></a><a href="d"></a>', "", '<a href="x">']
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, html string")
    for limit, offset in [(2, 0), (3, 2), (1, 1), (5, 4)]:
        got = {}
        for r in pages.top_links(df, limit, offset, ok=lambda x: ~x.contains(",")).collect():
            got.setdefault(r.page_id, []).append((r.rank, r.link))
        for pid, h in enumerate(docs):
            want = _brute_top_links(h, limit, offset, lambda x: "," not in x)
            assert [l for _, l in sorted(got.get(pid, []))] == want


def test_imgpt_metadata(spark):
    m = {"murl": "http://h/p q.jpg?x=1", "desc": "d", "purl": "http://h/"}
    good = '<a class="imgpt" m="' + html_lib.escape(json.dumps(m)) + '" href="#">'
    bad = '<a class="imgpt" m="{&quot;murl&quot;:oops}" href="#">'
    df = spark.createDataFrame([(1, bad + good)], "page_id long, html string")
    rows = pages.page_metadata(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.image_link, r.image_format, r.image_description, r.image_host) == ("http://h/p+q.jpg", "jpg", "d", "http://h/")


def test_tabs_stop_at_long_name(spark):
    def tab(name):
        return f'<a class="dtviD" href="/s?q=x,g_1:{name}&amp;usg=1">'

    doc = tab("red+car") + tab("blue") + tab("n" * 101) + tab("after")
    df = spark.createDataFrame([(1, doc)], "page_id long, html string")
    rows = sorted(pages.page_tabs(df, base_url="https://h").collect(), key=lambda r: r.pos)
    assert [(r.name, r.link) for r in rows] == [("red car", "https://h/s?q=x,g_1:red+car&usg=1"), ("blue", "https://h/s?q=x,g_1:blue&usg=1")]


def test_url_helpers(spark):
    from flexframe.functions import referer, search_url, url_extension

    df = spark.createDataFrame([("https://a.b.com/x/y.PNG?q=1",), ("nonsense",)], "u string")
    rows = df.select(referer("u").alias("r"), url_extension("u").alias("e"), search_url("u", "s?q=").alias("s")).collect()
    assert rows[0].r == "https://a.b.com" and rows[0].e == "png"
    assert rows[1].r is None and rows[1].e == ""


def test_search_terms_no_join(spark):
    kw = spark.createDataFrame([("blue car",)], "keyword string")
    out = pages.search_terms(kw, ["best", "cheap"], ["", "price"], "https://s/?q=")
    assert sorted(r.term for r in out.collect()) == ["best blue car", "best blue car price", "cheap blue car", "cheap blue car price"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("term = 'best blue car'").collect()[0].search_url == "https://s/?q=best%20blue%20car"
