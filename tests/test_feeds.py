"""Feed files of both kinds in one folder."""

from litwire.plans import queries
from litwire.sources.news import read_rss
from pyspark.sql import functions as F

RSS = """<?xml version="1.0"?><rss><channel><title>c</title>
<item><title>One &amp; all</title><link>https://n.example/1</link><description>&lt;b&gt;told&lt;/b&gt;</description><pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate><source url="u">Paper</source></item>
<item><title>Bare</title></item></channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>c</title>
<entry><title type="html">Two</title><link rel="self" href="https://s.example"/><link rel="alternate" href="https://n.example/2"/><summary>short</summary><content type="html">long</content>
<published>2024-01-06T23:00:00Z</published><updated>2024-02-01T00:00:00Z</updated><author><name>Ann</name></author><source><title>Gazette</title></source></entry>
<entry><title>Three</title><link rel="self" href="https://s.example/3"/><content>&lt;p&gt;only content&lt;/p&gt;</content><updated>2024-01-07T00:00:00Z</updated><author><name>Bo</name></author></entry>
<entry><title></title></entry></feed>"""


def test_items_and_entries_of_a_folder(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    (tmp_path / "b.xml").write_text(ATOM)
    rows = read_rss(spark, str(tmp_path), "feed", "en").collect()
    got = {r["title"]: (r["url"], str(r["published_date"]), r["excerpt"], r["publisher"]) for r in rows}
    assert got.pop("One & all") == ("https://n.example/1", "2024-01-05", "told", "Paper")
    assert got.pop("Two") == ("https://n.example/2", "2024-01-06", "short", "Gazette")
    assert got.pop("Three") == ("https://s.example/3", "2024-01-07", "only content", "Bo")
    assert got.pop("Bare")[:2] == (None, "None")
    assert len(rows) == 5 and len(got) == 1


def test_folder_of_one_kind(spark, tmp_path):
    (tmp_path / "b.xml").write_text(ATOM)
    assert read_rss(spark, str(tmp_path), "feed", "en").count() == 3


def test_word_index_is_built_without_a_shuffle(spark):
    rows = spark.createDataFrame([(1, "b a b c a b"), (2, ""), (3, None), (4, "x"), (4, "y y")], "doc_id long, body string")
    out = queries._word_index(rows, F.split("body", " "))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = [(r["doc_id"], r["idx"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(1, {"a": [1, 4], "b": [0, 2, 5], "c": [3]}), (2, {"": [0]}), (3, None), (4, {"x": [0]}), (4, {"y": [0, 1]})], key=repr)
