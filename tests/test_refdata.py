from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skytally.functions.country import override_continents
from skytally.plans import refdata
from skytally.sources import feeds, pages

CSS = pages.DETAILS_CLASS


def html(cells: str, css: str = CSS) -> str:
    return f"<html><body><table class='other'><tr><td>no</td></tr></table><table class='{css}'>{cells}</table></body></html>"


@pytest.mark.parametrize(
    "text, expected",
    [
        (html("<tr><th>h</th></tr><tr><td> a </td><td>b<br>c</td></tr>"), [[], ["a", "bc"]]),
        (html("<tr><td>x</td></tr>", "table"), None),
        (html("<tr><td>x</td></tr>", "  table   table-striped table-bordered\n border-dark "), [["x"]]),
        (html("<tr><td>x</td></tr>", CSS + " more"), None),
        (html(""), []),
        (html("<tr><td>&eacute;&amp;&#65;</td></tr>"), [["é&A"]]),
        (html("<tr><td>a<!-- c --><script>var x</script><style>s</style></td></tr>"), [["a"]]),
        # A nested table's rows and cells count for the outer ones too.
        (
            html("<tr><td>o<table><tr><td>i</td></tr></table></td></tr>"),
            [["oi", "i"], ["i"]],
        ),
        # Nothing closes a cell but its end tag or that of an element around it.
        (html("<tr><td>a<td>b</tr><tr><td>c</td></tr>"), [["ab", "b"], ["c"]]),
        (html("<tr><td>a</b></td></tr></p>"), [["a"]]),
        ("<TABLE CLASS='" + CSS + "'><TR><TD>x</TD></TR>", [["x"]]),
        (html("<tr><td>1</td></tr>") + html("<tr><td>2</td></tr>"), [["1"]]),
        ("", None),
    ],
)
def test_page_rows(text, expected):
    assert pages.page_rows(text, CSS) == expected


def test_extract_page_tables(spark):
    df = spark.createDataFrame(
        [(1, html("<tr><td>a</td></tr>")), (2, "<p>none</p>"), (3, html("", "x")), (4, None), (5, html(""))],
        "page_id int, html string",
    )
    assert rows(refdata.extract_page_tables(df)) == [(1, [["a"]]), (5, [])]


def cells(name, icao, country):
    return [[name, ""], [], ["i", "c"], ["", icao, "x"], ["y", "z", country]]


def test_clean_airline_countries(spark):
    df = spark.createDataFrame(
        [
            (9, cells("Nine", "ICAO:AAA", "Country:France")),
            (10, cells("Ten", "ICAO:AAA", "Country: Peru :x")),
            (11, cells("No code", "ICAO:", "no colon")),
            (12, cells("No colon", "ICAO", "Country:Chad")),
            (13, cells("No country", "ICAO:BBB", "Chad")),
            (14, [["short", "a"]]),
            (15, None),
            (16, cells("Empty", "ICAO:CCC", "Country:")),
        ],
        "page_id int, rows array<array<string>>",
    )
    clean, rejects = refdata.clean_airline_countries(df)
    assert rows(clean) == [("AAA", "Ten", " Peru "), ("CCC", "Empty", "")]
    assert [r[0] for r in rows(rejects)] == [12, 13, 14, 15]


def test_scraped_file_to_dimension(spark, tmp_path):
    scraped = {"1": cells("Alpha", "ICAO:AAA", "Country:France"), "2": "Failed", "3": cells("B", "ICAO:BBB", "Country:")}
    (tmp_path / "scraped.json").write_text(json.dumps(scraped, indent=4))
    raw = feeds.read_reference_object(spark, str(tmp_path / "scraped.json"), feeds.CELL_ROWS)
    numbered = raw.select(F.col("key").cast("long").alias("page_id"), F.col("value").alias("rows"))
    clean, rejects = refdata.clean_airline_countries(numbered)
    assert [r["page_id"] for r in rejects.collect()] == [2]
    feeds.write_reference(refdata.reference_entries(clean), str(tmp_path / "lines"), "icao", "value")
    stored = feeds.read_reference(spark, str(tmp_path / "lines"), "map<string,string>")
    assert rows(refdata.reference_countries(stored)) == [("AAA", "France"), ("BBB", "")]


def test_load_airlines(spark, tmp_path):
    feed = [
        {"Name": "Alpha", "Code": "AA", "ICAO": "AAA"},
        {"Name": "Beta", "Code": "BB", "ICAO": "BBB"},
        {"Name": "Gamma", "Code": "", "ICAO": "CCC"},
        {"Name": "Delta", "Code": "DD", "ICAO": "DDD"},
        {"Name": "Eps", "Code": "EE", "ICAO": "EEE"},
    ]
    (tmp_path / "feed.json").write_text("\n".join(json.dumps(r) for r in feed))
    reference = {"AAA": {"name": "A", "country": "France"}, "BBB": {"name": "B", "country": ""},
                 "CCC": {"name": "C"}, "DDD": {"name": "D", "country": None}}
    (tmp_path / "reference.json").write_text(json.dumps(reference))
    known = feeds.read_reference_object(spark, str(tmp_path / "reference.json"), "map<string,string>")
    landed = feeds.read_feed(spark, str(tmp_path / "feed.json"), "Name string, Code string, ICAO string")
    loaded = refdata.load_airlines(landed, refdata.reference_countries(known))
    assert loaded.columns == ["icao", "code", "name", "country", "_arrival"]
    assert rows(loaded.drop("_arrival")) == [
        ("AAA", "AA", "Alpha", "France"),
        ("BBB", "BB", "Beta", ""),
        ("CCC", "", "Gamma", "Unknown"),
        ("DDD", "DD", "Delta", None),
        ("EEE", "EE", "Eps", "Unknown"),
    ]


def test_load_airports(spark):
    schema = "icao string, altitude int, country string, iata string, latitude float, longitude float, name string, _p int"
    feed = spark.createDataFrame(
        [("A", 1, "Hong Kong", "a", 1.0, 2.0, "x", 0), ("B", 1, "France", "b", 1.0, 2.0, "y", 0)], schema
    )
    standard = spark.createDataFrame(
        [("France", "Europe"), ("Hong Kong", "Europe")], "country string, continent string"
    )
    loaded = refdata.load_airports(feed, override_continents(spark), standard)
    assert loaded.columns == ["icao", "altitude", "country", "iata", "latitude", "longitude", "name", "continent"]
    assert [r["continent"] for r in rows_by_icao(loaded)] == ["Asia", "Europe"]
    odd = feed.withColumn("country", F.lit("Atlantis"))
    with pytest.raises(Exception, match="no continent for country Atlantis"):
        refdata.load_airports(odd, override_continents(spark), standard).collect()
    assert refdata.load_airports(odd, override_continents(spark), standard, "null").first()["continent"] is None


def rows_by_icao(df):
    return df.orderBy("icao").collect()


def test_topic_table():
    assert feeds.topic_table("raw_flight_data") == "flight"


def test_large_object_is_read_by_many_tasks(spark, tmp_path):
    import random

    from skytally.sources import objects
    from skytally.sources.feeds import read_reference_object

    draw, parts = random.Random(3), ['"', ",", "{", "}", "[", "]", "\\", "a", "é", ":", " ", "\n"]
    word = lambda: "".join(draw.choices(parts, k=draw.randrange(12)))
    data = {f"{k}{word()}": {"name": word(), "x": word()} for k in range(3000)}
    data |= {"list": ["a,b", {"c": [1, 2]}], "empty": {}, "no": None, "long": {"name": ",".join(map(str, range(9000)))}}
    for folder, files in (("one", [data]), ("more", [{}, {"a": {"name": "b"}}, data])):
        (tmp_path / folder).mkdir()
        for n, content in enumerate(files):
            text = json.dumps(content, ensure_ascii=False, indent=n or None)
            (tmp_path / folder / f"{n}.json").write_text(f" {text} \n" if n else text)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        try:
            path = str(tmp_path / folder)
            assert spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions() > 10
            found = objects.read_large_object(spark, path, "map<string, string>").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        want = read_reference_object(spark, path, "map<string, string>").collect()
        key = lambda r: (r["key"], str(r["value"]))
        assert sorted(map(key, found)) == sorted(map(key, want)) and len(want) >= 3003
