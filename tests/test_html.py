"""Link extraction against hand-written pages and Python's own HTML parser."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from lakeloom.functions.html import page_files, page_links, unescape_attribute


def links(spark, pages, suffix=None):
    rows = [(i, p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "i int, h string")
    got = df.select("i", page_links(F.col("h"), suffix).alias("l")).collect()
    return [[x.href for x in row.l] for row in sorted(got, key=lambda r: r.i)]


CASES = {
    '<a href="x.csv">1</a><A HREF=\'y.csv\' class=k>2<a href=z.csv>': ["x.csv", "y.csv", "z.csv"],
    '<a class="a>b" href="q.csv">': ["q.csv"],
    '<!-- <a href="no"> --><a href="yes">': ["yes"],
    '<!--><a href="yes">--><!-- -- --><a href=2>': ["yes", "2"],
    "<script>var s='<a href=no>'</script ><a href=yes>": ["yes"],
    "<SCRIPT src=x>a<b</SCRIPT><style><a href=no></style><a href=yes>": ["yes"],
    "<script><a href=no>": [],
    "<scripts><a href=yes>": ["yes"],
    "<a>none</a><a name=x><abbr href=no><a href><area href=no>": [],
    '<a href="">': [""],
    '<a href = "sp" ><a\nhref="nl"\n><a/href=slash>': ["sp", "nl", "slash"],
    '<a data-href="no" hrefx=no href=yes/>': ["yes/"],
    '<a href="one" href="two">': ["two"],
    "<img alt=\"<a href='no'>\"><a href=yes>": ["yes"],
    "<a title=it's href=ap>it's": ["ap"],
    '<a href="x"class="y"id="z">': ["x"],
    "<![CDATA[ <a href=no> ]]><a href=yes>": ["yes"],
    "<!DOCTYPE html><?php <a href=no> ?><a href=yes>": ["yes"],
    "a < b <a href=yes> 1 <2> <a href=unclosed": ["yes"],
    "<a href=yes><a href=unclosed <!-- x -- ": ["yes"],
    "<a href=yes><b title='": ["yes"],
    "<a href='a\"b'><a href=\"a'b\"><a href=a'b>": ['a"b', "a'b", "a'b"],
    "plain text": [],
    "": [],
}


def test_cases(spark):
    assert links(spark, list(CASES)) == list(CASES.values())


def test_suffix_is_exact(spark):
    page = "<a href=a.csv><a href=b.CSV><a href=c.csv?v=1><a href='d.csv '><a href=''><a href=.csv>"
    assert links(spark, [page], ".csv") == [["a.csv", ".csv"]]
    df = spark.createDataFrame([(page,)], "h string")
    kept = df.select(F.inline(page_links(F.col("h"), ".csv"))).collect()
    assert [(r.link_pos, r.href) for r in kept] == [(0, "a.csv"), (5, ".csv")]


def test_references(spark):
    cases = {
        "a&amp;b": "a&b",
        "?a=1&copy=2": "?a=1&copy=2",
        "?a=1&copy;2": "?a=1©2",
        "&copy": "©",
        "&copyx": "&copyx",
        "&eacute;&#233;&#xE9;&#xe9": "é" * 4,
        "&#150;&#x80;": "–€",
        "&#0;&#xD800;&#1114112;&#99999999999;": "�" * 4,
        "&#128512;&bogus;&&#;& x": "\U0001f600&bogus;&&#;& x",
        "&lt;&gt;&quot;&apos;&nbsp;&NotEqualTilde;": "<>\"' ≂̸",
        "none": "none",
        "": "",
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, v string")
    got = df.select("i", unescape_attribute(F.col("v")).alias("u")).collect()
    assert [r.u for r in sorted(got, key=lambda r: r.i)] == list(cases.values())


class Collect(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "a" and values.get("href") is not None:
            self.found.append(values["href"])


def test_random_pages_match_parser(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcxyz.-_/") for _ in range(draw.randint(1, 8)))
    space = lambda: draw.choice([" ", "\n", "\t ", "  "])

    def attribute(name):
        quote = draw.choice(['"', "'", ""])
        value = word() + draw.choice(["", "&amp;x", "&#65;", "&eacute;"])
        if quote:
            value += draw.choice(["", " x", ">", "<a href=no>"])
        else:
            value = value.rstrip("/") + "z"
        equals = draw.choice(["=", " = ", "= "])
        return name + equals + quote + value + quote

    def piece():
        kind = draw.randint(0, 7)
        if kind <= 2:
            names = ["href"] + draw.sample(["id", "class", "data-href", "title", "hreflang"], 2)
            draw.shuffle(names)
            return draw.choice(["<a", "<A"]) + "".join(space() + attribute(n) for n in names) + ">"
        return [
            "<!-- <a href=no> " + word() + " -->",
            "<script>'<a href=no>' < " + word() + "</script>",
            "<style>" + word() + "<a href=no></style>",
            "<p" + space() + attribute("title") + ">" + word() + "</p>",
            word() + "</a> & text ",
        ][kind - 3]

    pages = ["".join(piece() for _ in range(draw.randint(0, 25))) for _ in range(300)]
    want = []
    for page in pages:
        parser = Collect()
        parser.feed(page)
        parser.close()
        want.append(parser.found)
    assert links(spark, pages) == want


def test_hostile_pages_finish(spark):
    n = 200_000
    pages = [
        "<a " + "x=1 " * n + "href=end>",
        "<a " * n,
        "<a href='" + "y" * n,
        "<!--" * n,
        "<script" * n,
        "<a " + '"' * n + ">",
        "<" * n,
        "</" * n,
        "<a href=x <!-- " * n,
    ]
    got = links(spark, pages)
    assert got[0] == ["end"]
    assert [len(found) for found in got[1:]] == [0, 0, 0, 0, 0, 0, 0, 0]


def test_files_resolve_on_their_page(spark):
    df = spark.createDataFrame(
        [("http://h/a/b.html", "<a href=c.csv><a href='/d.csv'><a href=../e.csv><a href=no>")],
        "url string, html string",
    )
    rows = df.select(F.inline(page_files(F.col("html"), F.col("url"), ".csv"))).collect()
    assert [(r.link_pos, r.file_url) for r in rows] == [
        (0, "http://h/a/c.csv"),
        (1, "http://h/d.csv"),
        (2, "http://h/e.csv"),
    ]
