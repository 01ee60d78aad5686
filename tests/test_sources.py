"""Line parsers: postings and article dump lines (FIXTURES.md section 4)."""

import pytest

from termcluster.sources import articles as art
from termcluster.sources import postings as post


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def parse_one(spark, line):
    return tuple(post.parse_postings(lines(spark, [line])).collect()[0])


def test_posting_lines(spark):
    assert parse_one(spark, "1,10,,,5,C#") == (1, 10, None, None, 5, "C#")
    assert parse_one(spark, "2,11,,10,3,") == (2, 11, None, 10, 3, None)
    assert parse_one(spark, "2,12,,10,-7") == (2, 12, None, 10, -7, None)
    assert parse_one(spark, '1,13,,,1,"C++"') == (1, 13, None, None, 1, '"C++"')
    assert parse_one(spark, "1,14,,,1,Java,extra") == (1, 14, None, None, 1, "Java")
    assert parse_one(spark, "1,15,16,,+2,Scala") == (1, 15, 16, None, 2, "Scala")


@pytest.mark.parametrize("bad", ["x,1,,,1", "", "1,10,,,", "1, 10,,,1", "1,10,,,99999999999"])
def test_posting_lines_fail(spark, bad):
    with pytest.raises(Exception):
        post.parse_postings(lines(spark, [bad])).collect()


def test_posting_schema(spark):
    df = post.parse_postings(lines(spark, ["1,10,,,5,C#"]))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        (f.name, f.dataType.simpleString()) for f in post.POSTING_SCHEMA.fields]


def test_posting_round_trip(spark):
    data = [(1, 100, 200, None, 0, "Scala"), (2, 200, None, 100, 20, None)]
    df = spark.createDataFrame(data, post.POSTING_SCHEMA)
    back = post.parse_postings(post.posting_lines(df))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(data, key=repr)


def test_article_line(spark):
    line = "x" * 14 + "T" + "</title><text>" + "B" + "y" * 16
    assert tuple(art.parse_articles(lines(spark, [line])).collect()[0]) == ("T", "B")


def test_article_line_cut_at_first_marker(spark):
    line = "x" * 14 + "T</title><text>a</title><text>b" + "y" * 16
    assert tuple(art.parse_articles(lines(spark, [line])).collect()[0]) == (
        "T", "a</title><text>b")


@pytest.mark.parametrize("bad", ["no marker at all here, none", "short</title><text>" + "y" * 16,
                                 "x" * 14 + "T</title><text>" + "y" * 10])
def test_article_line_fail(spark, bad):
    with pytest.raises(Exception):
        art.parse_articles(lines(spark, [bad])).collect()


def test_article_round_trip(spark):
    df = spark.createDataFrame([("1", "two words"), ("2", "")], "title string, text string")
    back = art.parse_articles(art.article_lines(df))
    assert sorted(map(tuple, back.collect())) == [("1", "two words"), ("2", "")]


def test_text_scan(spark, tmp_path):
    p = tmp_path / "postings.csv"
    p.write_text("1,10,,,5,C#\n2,11,,10,3,\n")
    df = post.parse_postings(post.read_posting_lines(spark, str(p)))
    assert sorted(map(tuple, df.collect())) == [(1, 10, None, None, 5, "C#"),
                                                (2, 11, None, 10, 3, None)]


def test_sample_lines_is_distributed_and_seeded(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as value")
    a = sorted(post.sample_lines(df, 0.1, 0).collect())
    b = sorted(post.sample_lines(df.repartition(7), 0.1, 0).collect())
    assert a == b and 50 < len(a) < 170


def test_sample_copies_follow_the_poisson_law(spark):
    from collections import Counter
    df = spark.range(20000).selectExpr("cast(id as string) as value")
    copies = Counter(r["value"] for r in post.sample_lines(df, 1.5, 3).collect())
    shares = Counter(copies.values())
    for k, p in ((1, 0.3347), (2, 0.2510), (3, 0.1255), (4, 0.0471)):
        assert abs(shares[k] / 20000 - p) < 0.02
    once = [r["value"] for r in post.sample_lines(df, 0.25, 3, with_replacement=False).collect()]
    assert len(once) == len(set(once)) and abs(len(once) / 20000 - 0.25) < 0.02


def test_article_dump_scan(spark, tmp_path):
    p = tmp_path / "articles.dat"
    head, tail = "<page> <title>", "</text> </page> "
    p.write_text(f"{head}A</title><text>Scala is fun{tail}\n{head}B</title><text>Java, not Java{tail}\n")
    df = art.parse_articles(art.read_article_lines(spark, str(p)))
    assert sorted(map(tuple, df.collect())) == [("A", "Scala is fun"), ("B", "Java, not Java")]


def test_posting_scan_with_sample(spark, tmp_path):
    p = tmp_path / "many.csv"
    p.write_text("".join(f"2,{i},,1,{i % 7}\n" for i in range(2000)))
    full = post.read_posting_lines(spark, str(p)).count()
    a = post.read_posting_lines(spark, str(p), sample_fraction=0.1).collect()
    b = post.read_posting_lines(spark, str(p), sample_fraction=0.1).collect()
    assert full == 2000 and a == b and 100 < len(a) < 320
