"""Rules of links that the query's addresses do not reach."""

from pyspark.sql import functions as F

from castellan.functions import links


def got(spark, rule, rows):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, u string, t string")
    return [r[0] for r in d.orderBy("i").select(rule(F.col("u"), F.col("t"))).collect()]


def test_parts_of_addresses(spark):
    urls = [("http://A.org/x/Y.tar.GZ", ""), ("http://a.org/.html", ""), ("http://a.org/x.", ""), ("http://a.org", ""), ("HTTP://a.org/dir.v1/;p?q#f", ""), (None, None)]
    assert got(spark, lambda u, t: links.suffix(u), urls) == ["gz", "", "", "", "v1", None]
    assert got(spark, lambda u, t: links.folder(u), urls)[0] == "/x" and got(spark, lambda u, t: links.has_year(u), [("http://a/1899/x", ""), ("http://a/1899", ""), ("http://a/21999/x", ""), ("http://a/x-2050b.htm", "")]) == [True, True, False, True]


def test_texts(spark):
    texts = ["", None, "ABCDE1", "ABCDEF", "1", "3½2", "D", "==", "Wijk", "10th", "111th", " 3RD "]
    assert got(spark, lambda u, t: links.is_code_or_score(t), [("u", t) for t in texts]) == [True, True, True, False, True, True, True, True, False, False, False, False]
    assert got(spark, lambda u, t: links.is_round_text(t), [("u", t) for t in texts])[-3:] == [True, False, True]


def test_details_stand_beside_their_parent(spark):
    parent, start = F.lit("http://a.org/x/p.html"), F.lit("http://www.a.org/")
    rows = [("http://a.org/x/q.html", "Standings"), ("http://a.org/x/p.html", "Standings"), ("http://a.org/y/q.html", "Standings"), ("http://b.org/x/q.html", "Final"), ("http://a.org/x/q.html", "3rd"), ("http://a.org/x/q.pdf", "Final"), ("http://a.org/x/q", None), (None, "Final")]
    assert got(spark, lambda u, t: links.is_detail(u, t, parent, start), rows) == [True] + [False] * 7
    assert got(spark, lambda u, t: links.is_detail(u, t, parent, start, True), rows)[4]
    assert got(spark, lambda u, t: links.is_summary_seed(u, t, start), [("http://a.org/", "x y"), ("http://a.org/e.php", "x y"), ("mailto:x@a.org", "x y"), ("http://a.org/e", "Back")]) == [False, True, False, False]
