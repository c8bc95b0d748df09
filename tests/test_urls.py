"""URL functions against hand-worked cases and against Python's own rules."""

import itertools
import mimetypes
import posixpath
import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from lakeloom.functions import media, urls

c = F.col


def one(spark, rows, schema, expression):
    """The expression's value for each row, in order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}").select("i", expression.alias("v"))
    return [row.v for row in sorted(df.collect(), key=lambda row: row.i)]


def test_parse_url_list(spark):
    cases = {
        "": [],
        "a": ["a"],
        " a ,b,, \t,a ": ["a", "b", "a"],
        ",,": [],
        "x y, z": ["x y", "z"],
    }
    got = one(spark, [(k,) for k in cases], "s string", urls.parse_url_list(c("s")))
    assert got == list(cases.values())
    assert one(spark, [(None,)], "s string", urls.parse_url_list(c("s"))) == [None]


def test_list_round_trip(spark):
    lists = [["a", "b"], ["a"], []]
    text = one(spark, [(x,) for x in lists], "l array<string>", urls.join_url_list(c("l")))
    assert text == ["a,b", "a", ""]
    picked = one(spark, [(x,) for x in [*lists, ["a", "b", "c"]]], "l array<string>",
                 urls.second_or_first(c("l")))
    assert picked == ["b", "a", None, "b"]


def test_dataset_names(spark):
    site = "https://www.kaggle.com/datasets/"
    cases = {
        site + "owner/oil-well/data": "owner/oil-well",
        site + "owner/name": "owner/name",
        site + "owner/name?v=1#top": "owner/name?v=1#top",
        site + "owner": None,
        site + "owner/": None,
        site + "/name/x": None,
        "https://example.org/datasets/a/b": None,
        "see kaggle.com/datasets/a/b here": "a/b here",
        "": None,
    }
    rows = [(k,) for k in cases]
    assert one(spark, rows, "u string", urls.dataset_slug(c("u"))) == list(cases.values())
    slugs = [("a_b/c",), ("a/b_c",), ("o/n",), (None,)]
    assert one(spark, slugs, "s string", urls.archive_name(c("s"))) == [
        "a_b_c.zip", "a_b_c.zip", "o_n.zip", None]
    assert one(spark, slugs, "s string", urls.download_name(c("s"))) == [
        "c.zip", "b_c.zip", "n.zip", None]


def test_keys_follow_path_join(spark):
    parts = ["", "raw", "raw/", "/", "a/b", "/c.csv", "x.csv"]
    rows = list(itertools.product(parts, parts))
    got = one(spark, rows, "d string, n string", urls.target_key(c("d"), c("n")))
    assert got == [posixpath.join(d, n) for d, n in rows]
    names = [("p?f=x/y.csv",), ("a/b/",), ("plain",), ("",)]
    got = one(spark, names, "p string", urls.basename(c("p")))
    assert got == [posixpath.basename(p) for (p,) in names]


def test_content_type_follows_registry(spark):
    keys = ["a.csv", "a.CSV", "x/y.tar.gz", "x.tgz", "x.svgz", "x.csv.gz", "x.gz", "x.unknown",
            ".csv", "a.", "a", "x.Z", "x.z", "d.e/f", "x.json", "q.csv?x=1", "a.zip", "x.TGZ",
            "..a.csv", "x.csv.bz2", "x.GZ", "", "a.tar.tgz", "é.html"]
    got = one(spark, [(k,) for k in keys], "k string", media.content_type(c("k")))
    registry = mimetypes.MimeTypes()
    assert got == [registry.guess_type(k)[0] or "application/octet-stream" for k in keys]
    own = one(spark, [("a.las",)], "k string", media.content_type(c("k"), {".las": "x/las"}))
    assert own == ["x/las"]


BASES = ["http://h", "https://h/", "http://h/a", "http://h/a/b/", "http://h/a/b/c;p?q=1#f",
         "http://h/a//b/../c", "http://h/x;y/z", "HTTP://U@H:80/a/b?x", " http://h/p\tq/r",
         "http://h/a/b;", "http://h/./x/", "http://h//"]
LINKS = ["", "x.csv", "./x.csv", "../x.csv", "../../../x.csv", "/x.csv", "//o/x.csv", "//o",
         "///x", "http://z/y.csv", "https://z/y.csv", "https:y.csv", "http:y.csv", "mailto:a.csv",
         "?q=2", "#f2", "?", "#", "x;p", "x;", "a//b", "a/./b/", "..", ".", "./", "../", ";p",
         "/a/../b", "/../x", "/a//b", "x?y#z", " x.csv", "x.csv ", "a\nb.csv", "javascript:x.csv",
         "x:y.csv", "1:y", "//[::1/x", "//[::1]/x", "#a#b", "?a?b", "a/b;c/d;e;f", "/;x",
         "HTTPS://Q/w.csv", "..//x", "x/../../y//..//z", "/.", "/..", "/a/.", "ü/é.csv", "a.b",
         ".hidden", "/.x", "x ", ".. ", "a b/c"]


def expected(base, link):
    try:
        return urljoin(base, link)
    except ValueError:
        return None


def test_resolution_cases(spark):
    rows = list(itertools.product(BASES, LINKS))
    got = one(spark, rows, "b string, h string", urls.resolve_url(c("b"), c("h")))
    wrong = [(b, h, g) for (b, h), g in zip(rows, got) if g != expected(b, h)]
    assert wrong == []


def test_resolution_random(spark):
    draw = random.Random(7)
    atoms = ["a", "b.csv", "..", ".", "/", "//", "?", "#", ";", ":", "x=1", "é", " ", "%2e"]
    text = lambda n: "".join(draw.choice(atoms) for _ in range(draw.randint(0, n)))
    rows = [("http://h" + draw.choice(["", "/"]) + text(6).replace(":", ""), text(8))
            for _ in range(4000)]
    got = one(spark, rows, "b string, h string", urls.resolve_url(c("b"), c("h")))
    wrong = [(b, h, g, expected(b, h)) for (b, h), g in zip(rows, got) if g != expected(b, h)]
    assert wrong[:5] == []


def test_http_urls(spark):
    cases = {
        "http://Example.COM": "http://example.com/",
        "https://h:443/a/../b c?x y#f g": "https://h/b%20c?x%20y#f%20g",
        "  https://h/é?ü=1 ": "https://h/%C3%A9?%C3%BC=1",
        "http://u@H:080/x": "http://u@h/x",
        "http://h:8080": "http://h:8080/",
        "https://[::1]:8/": "https://[::1]:8/",
        "http://h/100%/a'b?c'd": "http://h/100%/a'b?c%27d",
        "ftp://h/x": None,
        "http://": None,
        "http:// /x": None,
        "http://a b/": None,
        "http://h:99999/": None,
        "http://h:12345678901234567890/": None,
        "http://h:x/": None,
        "nothing": None,
        "": None,
        "http://h/" + "x" * 2083: None,
    }
    rows = [(k,) for k in cases]
    assert one(spark, rows, "u string", urls.normalize_http_url(c("u"))) == list(cases.values())
    valid = one(spark, [*rows, (None,)], "u string", urls.is_http_url(c("u")))
    assert valid == [v is not None for v in cases.values()] + [False]


def test_resolution_of_a_page_at_once(spark):
    got = one(spark, [("http://h/a/b", LINKS)], "b string, l array<string>",
              urls.resolve_all(c("b"), c("l")))
    assert got == [[expected("http://h/a/b", link) for link in LINKS]]
