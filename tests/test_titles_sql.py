"""Titles of pages as their SQL has them."""

import duckdb

from tidegraph.plans.registry import QUERIES, SQL


def test_references_without_semicolon(spark, tmp_path):
    rows = [(1, "<h1>a&amp;&amp</h1>"), (2, "<p>x</p><h1>b &lt;i&gt; &amp;lt; &quot;c&quot; &#39;d&#39;</h1>"), (3, "<h1>e & f &lt</h1>")]
    spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["title"] for r in QUERIES["f8_page_titles"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"create view pages as from '{tmp_path}/pages.parquet/*.parquet'")
    own = SQL["f8_page_titles"].split("select page_id, trim(")[1]
    assert got == dict(c.execute("select page_id, trim(" + own).fetchall()) == {1: "a&&amp", 2: "b <i> &lt; \"c\" 'd'", 3: "e & f &lt"}
