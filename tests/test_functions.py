import base64
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.functions import jsons, text as tx
from loomgraph.functions.chunking import chunk_text, chunks
from loomgraph.functions.vectors import clamp, cosine, decode_vector


def one(spark, *columns, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return tuple(row.select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_cleaning_order_and_switches(spark):
    t = "a\0b�c&nbsp;d&amp;lt; <b>x</b>\n\t y"
    assert one(spark, tx.clean("t"), t=t) == ("a b c d&lt; x y",)
    assert one(spark, tx.clean("t", ("tags",)), t="<p>x</p>") == (" x ",)
    assert one(spark, tx.ws_ascii("t"), tx.ws_unicode("t"), t="a \xa0 b") == ("a \xa0 b", "a b")


def test_previews(spark):
    assert one(spark, tx.preview("t", 10), t="hello brave new world") == ("hello...",)
    assert one(spark, tx.preview("t", 10), t="hello you") == ("hello you",)
    assert one(spark, tx.compact("t", 8), t="hello brave") == ("hello...",)
    assert one(spark, tx.excerpt("t", 5), t="  a  bcdefg") == ("a bcd",)


def test_urls(spark):
    assert one(spark, tx.normalize_url("t"), t="HTTPS://Ex.COM/a/?b=2&a=1#f") == ("https://ex.com/a?a=1&b=2",)
    assert one(spark, tx.normalize_url("t"), t="http://ex.com") == ("http://ex.com/",)
    for link, want in (("/x", "http://h.org/x"), ("y", "http://h.org/d/y"), ("//o.org/z", "http://o.org/z"), ("https://q.org", "https://q.org")):
        assert one(spark, tx.absolute_url("l", "b"), l=link, b="http://h.org/d/e?q#f") == (want,)
    for url, want in (("http://a.edu.vn/x", "html"), ("http://b.org/x", "dropped"), ("http://a.edu.vn/x.PDF", "pdf"), ("http://a.edu.vn/x.css?v=1", "dropped"), ("ftp://a.edu.vn/", "dropped"), ("http://s.a.edu.vn/login", "dropped")):
        assert one(spark, tx.url_class("u", ["a.edu.vn"], ["login"]), u=url) == (want,)


def test_templates_keys_and_lists(spark):
    assert one(spark, tx.fill("{{a}}-{{b}}", a="x", b="y"), x="{{b}}", y="1") == ("1-1",)
    assert one(spark, tx.safe_part("t"), t=" Ä b__C! ") == ("b__c",)
    assert one(spark, tx.split_list("t"), t="a<SEP> <SEP>b ") == (["a", "b"],)
    assert one(spark, tx.fuzzy_query("t"), tx.fuzzy_query("e"), t="Big 12345 cat", e="!") == ("big OR 12345 OR cat", "*")
    assert one(spark, tx.ascii_fold("t"), t="Đường Straße") == ("duong strasse",)
    assert one(spark, tx.answer_form("t", True), t="Ａ, b!") == ("a b",)


def test_html(spark):
    page = '<html><head><title> T &amp; u</title></head><body><script>x</script><h1>H</h1><a href="/a#x">l</a><a class=c href="/a">m</a></body></html>'
    assert one(spark, tx.html_title("t", "u"), tx.html_text("t"), tx.html_links("t"), t=page, u="url") == ("T & u", "H l m", ["/a"])
    assert one(spark, tx.html_title("t", "u"), t="<h1>only</h1>", u="url") == ("only",)
    assert one(spark, tx.html_title("t", "u"), t="", u="url") == ("url",)


@pytest.mark.parametrize(("text", "stage", "error"), [
    ('```json\n[{"Head":" a  b ","Relation":"r","Tail":"t"},]\n```', "entity_relation", None),
    ('Here: [{"Event":"e","Entity":["x","x","y"]}] done', "event_entity", None),
    ('{"entity_relation":[{"Head":"a","Relation":"r","Tail":"t"}]}', "entity_relation", None),
    ('{"Head":"a"}', "entity_relation", "not_an_array"),
    ('[{"Head":"a","Relation":" ","Tail":"t"},{"Head":"b","Relation":"r","Tail":"t"}]', "entity_relation", "missing_field"),
    ('[{"Event":"e","Entity":[]}]', "event_entity", "invalid_entities"),
    ("no json", "event_relation", "invalid_json"),
])
def test_stage_payloads(spark, text, stage, error):
    j = jsons.payload("t")
    items = jsons.stage_items(j, stage)
    got = one(spark, jsons.stage_error(j, items, stage), items, t=text)
    assert got[0] == error
    if stage == "event_entity" and error is None:
        assert got[1][0]["Entity"] == ["x", "y"]
    if stage == "entity_relation" and "a  b" in text:
        assert got[1][0]["Head"] == "a b"


def test_concepts(spark):
    for text, want in (('["a"," b  c ","","a"]', ["a", "b c"]), ('```\n{"concepts": ["x"]}\n```', ["x"]), ("a, b ,a", ["a", "b"]), ('["a", 3]', None), ("two\nlines", None), ("[broken", None)):
        assert one(spark, jsons.concepts("t"), t=text) == (want,), text
    assert one(spark, jsons.concepts("t", strict=True), t="a, b") == (None,)


def test_vectors(spark):
    row = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0], [1.0])], "a array<float>, b array<float>, z array<float>, s array<float>")
    got = row.select(cosine("a", "b"), cosine("a", "z"), cosine("a", "s")).first()
    assert abs(got[0] - 0.5**0.5) < 1e-6 and got[1] is None and got[2] is None
    assert one(spark, clamp("t", 0.0, 5.0), clamp("u", 0.0, 5.0), clamp("v", 0.0, 5.0), t="7", u="x", v="-1") == (5.0, None, 0.0)
    blob = base64.b64encode(zlib.compress(np.array([1.5, -2], "<f2").tobytes())).decode()
    assert one(spark, decode_vector("t"), decode_vector("u"), t=blob, u="??") == ([1.5, -2.0], None)


def test_chunks():
    assert chunk_text(None) == [] and chunk_text("  ") == []
    words = " ".join(f"word{i:03d}" for i in range(100))
    parts = chunk_text(words, 80, 20, 10)
    assert parts[0].split() == [f"word{i:03d}" for i in range(10)]
    assert parts[1].startswith("word008 word009 word010") and all(len(p) <= 80 + 20 for p in parts)
    seen = [w for p in parts for w in p.split()]
    assert set(seen) == set(words.split())
    assert chunk_text("a" * 25 + " b", 10, 5, 5) == ["a" * 10, "a" * 10, "a" * 5]
    assert chunk_text("tiny", 100, 10, 50) == ["tiny"]
    assert chunk_text("aa bb cc dd", 5, 0, 1, most=1) == ["aa bb"]


def test_chunk_column(spark):
    assert one(spark, chunks(F.col("t"), 5, 0, 1), t="aa bb cc") == (["aa bb", "cc"],)
