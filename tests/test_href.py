"""Golden rows of the path parser and url rules."""

import pytest
from pyspark.sql import functions as F

from terraloom.functions import href
from terraloom.operators import catalog

GOLDEN = [
    ("./auckland/auckland-central_2023_0.06m/rgb/2193/collection.json", "auckland/auckland-central_2023_0.06m",
     "auckland", "auckland central", "rgb", "2193", "2023", "2023", "0.06m", "6.0"),
    ("./bay-of-plenty/bay-of-plenty_2015-2016_0.125m/rgb/2193/collection.json", "bay-of-plenty/bay-of-plenty_2015-2016_0.125m",
     "bay of plenty", "bay of plenty", "rgb", "2193", "2015", "2015-2016", "0.125m", "12.5"),
    ("./southland/southland-central-otago_2013-2014_0.4m/rgb/2193/collection.json", "southland/southland-central-otago_2013-2014_0.4m",
     "southland", "southland central otago", "rgb", "2193", "2013", "2013-2014", "0.4m", "40.0"),
    ("./a/q_2019_0.07m/rgb/2193/collection.json", "a/q_2019_0.07m", "a", "q", "rgb", "2193", "2019", "2019", "0.07m", "7.000000000000001"),
    ("./a/b/collection.json", "a/b", "a", "b", "", "", "", "", "", ""),
    ("./a/collection.json", "a", "a", "", "", "", "", "", "", ""),
    ("./a/b_2019_200000m/dem/2193/collection.json", "a/b_2019_200000m", "a", "b", "dem", "2193", "2019", "2019", "200000m", "20000000.0"),
    ("./a/b_2019_0.000005m/dem/2193/collection.json", "a/b_2019_0.000005m", "a", "b", "dem", "2193", "2019", "2019", "0.000005m", "0.0005"),
    ("./a/b-c/x/y/collection.json", "a/b-c", "a", "b c", "x", "y", "", "", "", ""),
]
FIELDS = ["path", "region", "sub_region", "type", "crs", "base_year", "year_range", "gsd", "cellsize_cm"]


def test_golden_paths(spark):
    df = catalog.parse_href(spark.createDataFrame([(g[0],) for g in GOLDEN], "href string"), "bucket", "here")
    got = {r["href"]: r for r in df.collect()}
    for row in GOLDEN:
        assert [got[row[0]][f] for f in FIELDS] == list(row[1:])
    first = got[GOLDEN[0][0]]
    assert first["s3"] == "s3://bucket/auckland/auckland-central_2023_0.06m/rgb/2193/"
    assert first["https"] == "https://bucket.s3.here.amazonaws.com/auckland/auckland-central_2023_0.06m/rgb/2193/"


@pytest.mark.parametrize("url, key", [
    ("https://host/a/b.json", "a/b.json"), ("https://host//a", "a"), ("https://host", ""), ("a/b", "a/b"),
    ("http://host/a b.json?x=1#y", "a b.json"), ("https://host/a/b;v=1", "a/b"), ("https://host/a;v/b", "a;v/b"),
])
def test_url_key(spark, url, key):
    assert spark.range(1).select(href.url_key(F.lit(url))).first()[0] == key


@pytest.mark.parametrize("link, key", [
    ("./x.json", "a/b/x.json"), ("x.json", "a/b/x.json"), ("https://host/q/x.json", "q/x.json"),
    ("./s/./x.json", "a/b/s/a/b/x.json"), ("../x.json", "a/b/../x.json"),
])
def test_item_key(spark, link, key):
    assert spark.range(1).select(href.item_key(F.lit(link), F.lit("a/b/collection.json"))).first()[0] == key


def test_every_dot_slash_goes(spark):
    assert spark.range(1).select(href.clean_path(F.lit("../a/./b/collection.json"))).first()[0] == ".a/b"


def test_list_text(spark):
    row = spark.sql("select array(1, 2) a, cast(null as array<int>) b").select(href.list_text(F.col("a")), href.list_text(F.col("b"))).first()
    assert tuple(row) == ("[1, 2]", "[]")
