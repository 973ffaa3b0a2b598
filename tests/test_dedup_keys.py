"""Key-based dedupe: same reports where rows are functions of the key, and a
narrower shuffle."""

from citypulse.catalog import _geo, _income, _parts, _rounded, _stations
from citypulse.operators.joins import scoped_conf
from citypulse.plans import day_parts as W2
from citypulse.plans import income_extremes as W3
from citypulse.plans import station_distance as W4
from citypulse.plans import top_months as W1
from citypulse.sources import tables as T

from conftest import SF_SMALL

KEY = ["DR_NO"]


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reports_equal_with_record_key(spark):
    parts = _parts(spark, SF_SMALL)
    _same(W1.top_months_df(parts), W1.top_months_df(parts, dedup_keys=KEY))
    _same(W2.day_parts_df(parts), W2.day_parts_df(parts, dedup_keys=KEY))
    _same(W2.day_parts_rows(parts), W2.day_parts_rows(parts, dedup_keys=KEY))
    geo, inc = _geo(spark, SF_SMALL), _income(spark, SF_SMALL)
    _same(W3.income_extremes(parts, geo, inc, community_like=T.COMMUNITY_PATTERN),
          W3.income_extremes(parts, geo, inc, community_like=T.COMMUNITY_PATTERN, dedup_keys=KEY))
    st = _stations(spark, SF_SMALL)
    _same(_rounded(W4.by_year(W4.own_station_rows(parts, st))),
          _rounded(W4.by_year(W4.own_station_rows(parts, st, dedup_keys=KEY))))


def test_record_key_narrows_the_shuffle(spark):
    parts = _parts(spark, SF_SMALL)
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        full = W1.top_months_df(parts)._jdf.queryExecution().executedPlan().toString()
        keyed = W1.top_months_df(parts, dedup_keys=KEY)._jdf.queryExecution().executedPlan().toString()
    wide = [l for l in full.splitlines() if "Exchange hashpartitioning" in l and "DR_NO" in l][0]
    narrow = [l for l in keyed.splitlines() if "Exchange hashpartitioning" in l and "DR_NO" in l][0]
    assert "Premis Desc" in wide and "Premis Desc" not in narrow


def test_filter_comes_before_the_keyed_dedupe(spark):
    parts = _parts(spark, SF_SMALL)
    geo, inc, st = _geo(spark, SF_SMALL), _income(spark, SF_SMALL), _stations(spark, SF_SMALL)
    plans = {
        "W1": W1.top_months_df(parts, dedup_keys=KEY),
        "W2": W2.day_parts_df(parts, dedup_keys=KEY),
        "W3": W3.descent_counts(parts, geo, dedup_keys=KEY),
        "W4": W4.firearm_incidents(parts, dedup_keys=KEY)}
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        texts = {k: df._jdf.queryExecution().executedPlan().toString() for k, df in plans.items()}
    assert not any("SortAggregate" in t for t in texts.values())
    lines = texts["W2"].splitlines()
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(DR_NO" in x)
    assert not any("STREET" in x for x in lines[:dealt]) and any("STREET" in x for x in lines[dealt:])


def test_sql_forms_take_the_same_options(spark):
    parts = _parts(spark, SF_SMALL)
    geo, inc, st = _geo(spark, SF_SMALL), _income(spark, SF_SMALL), _stations(spark, SF_SMALL)
    for key in (None, KEY):
        _same(W1.top_months_df(parts), W1.top_months_sql(spark, parts, dedup_keys=key).toDF("Year", "Month", "Total Crimes", "#"))
        _same(W2.day_parts_rows(parts), W2.day_parts_sql(spark, parts, dedup_keys=key).toDF("time_period", "count"))
        for numbers in (False, True):
            _same(W3.income_extremes(parts, geo, inc, community_like=T.COMMUNITY_PATTERN, normalize_keys=numbers),
                  W3.income_extremes_sql(spark, parts, geo, inc, community_like=T.COMMUNITY_PATTERN, dedup_keys=key, normalize_keys=numbers))
            _same(_rounded(W4.by_division(W4.own_station_rows(parts, st, normalize_keys=numbers))),
                  _rounded(W4.by_division(W4.own_station_rows_sql(spark, parts, st, dedup_keys=key, normalize_keys=numbers))))


def test_sql_record_key_narrows_the_shuffle(spark):
    parts = _parts(spark, SF_SMALL)
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = W2.day_parts_sql(spark, parts, dedup_keys=KEY)._jdf.queryExecution().executedPlan().toString()
    narrow = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "DR_NO" in x][0]
    assert "TIME OCC" in narrow and "Vict Age" not in narrow


def test_sql_forms_match_numbers_by_value(spark):
    """34.10 is 34.1 and 01 is 1 only where asked, in both forms."""
    cols = ["DR_NO", "DATE OCC", "TIME OCC", "AREA", "Premis Desc", "Vict Descent", "Weapon Used Cd", "LAT", "LON"]
    rows = [(str(i), "01/02/2020 12:00:00 AM", "1200", area, "STREET", "W", "100", lat, "-118.3")
            for i, (area, lat) in enumerate([("1", "34.1"), ("01", "34.10"), ("x", "here"), (None, None)])]
    part = [spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))]
    geo = spark.createDataFrame([("34.1", "-118.3", "90001-1"), ("here", "-118.3", "90001")], "LAT string, LON string, ZIPcode string")
    income = spark.createDataFrame([("90001", "Los Angeles (A)", "$1,000")], "`Zip Code` string, Community string, `Estimated Median Income` string")
    st = spark.createDataFrame([("1", "-118.0", "34.0", "CENTRAL"), ("x", "-118.0", "34.0", "ODD")], "FID string, X string, Y string, DIVISION string")
    for numbers, matched in ((False, 2), (True, 3)):
        a = W3.income_extremes(part, geo, income, normalize_keys=numbers)
        b = W3.income_extremes_sql(spark, part, geo, income, normalize_keys=numbers)
        _same(a, b)
        assert {r["#"] for r in b.collect()} == {matched}  # the one area is both richest and poorest
        a, b = W4.own_station_rows(part, st, normalize_keys=numbers), W4.own_station_rows_sql(spark, part, st, normalize_keys=numbers)
        assert sum(r["n"] for r in a.collect()) == sum(r["n"] for r in b.collect()) == matched
