"""Merges by predicate: what is taken as key, as band, or refused; against plain pairs."""

import datetime
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan, rows
from feedlake.operators.merge import merge
from feedlake.operators.predicates import analyse
from feedlake.plans.table import LakeTable
from feedlake.sources.layout import Layout

T = "k int, v string, x double, tag string"
S = "id bigint, v string, lo double, hi double, tag string"


@pytest.fixture
def sides(spark):
    r = random.Random(4)
    none = lambda value: None if r.random() < 0.1 else value
    t = [(none(i % 40), f"t{i}", none(round(r.uniform(-50, 50), 1)), r.choice("ab")) for i in range(60)]
    s = [(none(i), f"s{i}", none(float(3 * i - 60)), none(3 * i - 60 + r.choice([0.0, 1.5, 2.9])), r.choice("ab")) for i in range(50)]
    s.append((99, "wide", 44.0, 1e9, "c"))
    return spark.createDataFrame(t, T), spark.createDataFrame(s, S).alias("s")


def expected(target, source, matches):
    """update v from the source; insert unmatched sources as (id, v, lo, tag)"""
    t, s = [tuple(r) for r in target.collect()], [tuple(r) for r in source.collect()]
    out, hit = [], set()
    for row in t:
        found = [i for i, other in enumerate(s) if matches(row, other)]
        hit |= set(found)
        assert len(found) < 2
        out.append((row[0], s[found[0]][1], row[2], row[3]) if found else row)
    out += [(o[0], o[1], o[2], o[4]) for i, o in enumerate(s) if i not in hit]
    return sorted(out, key=lambda r: [(v is not None, str(type(v)), v) for v in r]), len(hit)


def merged(target, source, on, **kw):
    builder = merge(target, source, on, **kw).when_matched_update(set={"v": "s.v"})
    return builder.when_not_matched_insert(values={"k": "s.id", "v": "s.v", "x": "s.lo", "tag": "s.tag"}).to_df()


def known(*values):
    return None not in values


CASES = {
    "t.k = s.id": lambda t, s: known(t[0], s[0]) and t[0] == s[0],
    "s.id + 1 = t.k": lambda t, s: known(t[0], s[0]) and t[0] == s[0] + 1,
    "t.k = s.id and t.tag = 'a' and s.tag <> 'b'": lambda t, s: known(t[0], s[0]) and t[0] == s[0] and t[3] == "a" and s[4] != "b",
    "t.k <=> s.id and t.tag = s.tag and s.id is not null": lambda t, s: known(s[0]) and t[0] == s[0] and t[3] == s[4],
    "t.k = s.id and t.x > s.lo": lambda t, s: known(t[0], s[0], t[2], s[2]) and t[0] == s[0] and t[2] > s[2],
    "t.k = s.id and (t.tag = s.tag or t.x is null)": lambda t, s: known(t[0], s[0]) and t[0] == s[0] and (t[3] == s[4] or t[2] is None),
    "t.x between s.lo and s.hi": lambda t, s: known(t[2], s[2], s[3]) and s[2] <= t[2] <= s[3],
    "s.lo < t.x and s.hi >= t.x and t.tag <> s.tag": lambda t, s: known(t[2], s[2], s[3]) and s[2] < t[2] <= s[3] and t[3] != s[4],
    "t.x >= s.lo - 0.05 and t.x < s.lo + 0.05": lambda t, s: known(t[2], s[2]) and s[2] - 0.05 <= t[2] < s[2] + 0.05,
}


@pytest.mark.parametrize("on", CASES)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_against_plain_pairs(spark, sides, on, threshold):
    target, source = sides
    target = target.dropDuplicates(["k"]) if "k" in on else target
    want, hits = expected(target, source, CASES[on])
    assert hits > 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = merged(target, source, on)
        assert rows(out) == want
        assert not re.search("NestedLoop|Cartesian", plan(out))
        assert rows(merge(target, source, on).when_matched_delete().to_df(), "v") == sorted(
            (r[1],) for r in map(tuple, target.collect()) if not any(CASES[on](r, tuple(o)) for o in source.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_refused_unless_asked_for(sides):
    target, source = sides
    for on in ("t.x > s.lo", "t.x > 3 and s.lo > 2", "true", "t.x * s.lo = 4", F.col("t.k") != F.col("s.id")):
        with pytest.raises(ValueError, match="nested_loop"):
            merge(target, source, on)
    few = source.filter("id = 49")
    out = merge(target, few, "t.x > s.lo", nested_loop=True).when_matched_update(set={"v": "s.v"}).to_df()
    assert out.filter("v = 's49'").count() == 0
    assert merge(target, few, "t.x < s.lo", nested_loop=True).when_matched_delete().to_df().count() == target.filter("x is null").count()


def test_several_rows_in_a_band_raise(sides):
    target, source = sides
    overlapping = source.select("id", "v", (F.col("lo") - 10).alias("lo"), "hi", "tag").alias("s")
    with pytest.raises(PySparkException, match="MERGE_CARDINALITY_VIOLATION"):
        merged(target, overlapping, "t.x between s.lo and s.hi").collect()


def test_bands_of_time(spark):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    t = spark.createDataFrame([(i, day(i), "old") for i in range(100)] + [(500, None, "old")], "k int, at timestamp, v string")
    s = [(10 * i, day(10 * i), day(10 * i + 3), f"p{i}") for i in range(9)] + [(-1, day(95), datetime.datetime(9999, 12, 31), "open"), (-2, day(300), day(400), "none")]
    source = spark.createDataFrame(s, "k int, begin timestamp, end timestamp, v string").alias("s")
    out = merge(t, source, "t.at >= s.begin and t.at < s.end").when_matched_update(set={"v": "s.v"}).when_not_matched_insert(values={"k": "s.k", "v": "s.v"}).to_df()
    assert rows(out.groupBy("v").count()) == sorted([("old", 100 - 27 - 5 + 1), ("open", 5), ("none", 1)] + [(f"p{i}", 3) for i in range(9)])
    dates = t.select("k", F.to_date("at").alias("at"), "v")
    assert merge(dates, source, "t.at >= to_date(s.begin) and t.at < to_date(s.end)").when_matched_delete().to_df().count() == 101 - 32


def test_what_a_predicate_says(spark, sides):
    target, source = sides
    told = lambda on: analyse(target.alias("t"), source, F.expr(on))
    assert told("t.v = s.v").named == {"v"} and told("t.v = s.v").exact
    assert told("t.k = s.id").named == frozenset() and told("t.k = s.id and t.x < s.lo").exact is False
    assert told("t.x between s.lo and s.hi").band is not None and set(told("t.x between s.lo and s.hi").reads) == {"lo", "hi"}
    assert not told("t.x > s.lo").joins


def test_rows_stand_in_few_bins(spark):
    from feedlake.operators.predicates import with_bins

    target = spark.range(1000).select(F.col("id").cast("double").alias("x")).alias("t")
    s = spark.range(300).select((F.col("id") * 3.0).alias("lo"), F.when(F.col("id") % 50 == 0, 1e12).otherwise(F.col("id") * 3.0 + 1).alias("hi")).alias("s")
    match = analyse(target, s, F.expr("t.x between s.lo and s.hi"))
    _, spread = with_bins(target, s, match.band)
    assert spread.count() <= 3 * 300


def test_text_merge_on_one_slice(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    table.create(spark.range(150).selectExpr("cast(id as int) as k", "'a' as v"))
    source = spark.createDataFrame([(3, "x"), (5, "y")], "k int, v string").alias("s")
    table.merge(source, "t.k = s.k").when_matched_update_all().when_not_matched_insert_all().execute()
    counts = table.history(1).first()
    assert (counts["rows_updated"], counts["rows_kept"]) == (2, 8)  # the rows of one slice
    assert rows(table.to_df().filter("v <> 'a'")) == [(3, "x"), (5, "y")]
