"""Each data-quality check with a passing and a failing input; NULLs never fail range/values."""

from aerolake.operators import profile as PR
from aerolake.operators import quality as DQ


def _df(spark, rows, schema="k string, v double, s string"):
    return spark.createDataFrame(rows, schema)


def _summary(spark, checks, models):
    return {(r.test, r.model, r.column_name): r.failing_rows for r in DQ.run_checks(checks, models).collect()}


def test_row_level_checks(spark):
    good = _df(spark, [("a", 1.0, "AIRBORNE"), ("b", None, None)])
    bad = _df(spark, [("a", -1.0, "FLYING"), (None, 0.0, "UNKNOWN")])
    checks = lambda m: [DQ.Check("not_null", m, "k"),
                        DQ.Check("accepted_range", m, "v", min_value=0, inclusive=True),
                        DQ.Check("accepted_values", m, "s", values=("AIRBORNE", "ON GROUND", "UNKNOWN"))]
    s = _summary(spark, checks("good") + checks("bad"), {"good": good, "bad": bad})
    assert s[("not_null", "good", "k")] == 0 and s[("not_null", "bad", "k")] == 1
    assert s[("accepted_range", "good", "v")] == 0 and s[("accepted_range", "bad", "v")] == 1
    assert s[("accepted_values", "good", "s")] == 0 and s[("accepted_values", "bad", "s")] == 1
    excl = DQ.Check("accepted_range", "bad", "v", min_value=0, inclusive=False)
    assert DQ.failing_rows(excl, {"bad": bad}).count() == 2


def test_unique_ignores_nulls(spark):
    good = _df(spark, [("a", 1.0, None), (None, 1.0, None), (None, 2.0, None)])
    bad = _df(spark, [("a", 1.0, None), ("a", 2.0, None), ("b", 1.0, None)])
    s = _summary(spark, [DQ.Check("unique", "good", "k"), DQ.Check("unique", "bad", "k")], {"good": good, "bad": bad})
    assert s[("unique", "good", "k")] == 0 and s[("unique", "bad", "k")] == 1


def test_relationships(spark):
    parent = _df(spark, [("a", 1.0, None), ("b", 1.0, None)])
    child_ok = _df(spark, [("a", 1.0, None), (None, 1.0, None)])
    child_bad = _df(spark, [("a", 1.0, None), ("z", 1.0, None), ("z", 2.0, None)])
    models = {"p": parent, "ok": child_ok, "bad": child_bad}
    checks = [DQ.Check("relationships", "ok", "k", to_model="p", to_column="k"),
              DQ.Check("relationships", "bad", "k", to_model="p", to_column="k")]
    s = _summary(spark, checks, models)
    assert s[("relationships", "ok", "k")] == 0 and s[("relationships", "bad", "k")] == 2
    assert DQ.failing_rows(checks[1], models).count() == 2


def test_long_flights(spark):
    f = spark.createDataFrame([("a", "F1", 1440), ("b", "F2", 1441)],
                              "aircraft_id string, flight_callsign string, flight_duration_minutes long")
    assert [r.aircraft_id for r in DQ.long_flights(f).collect()] == ["b"]


def test_profiles(spark):
    before = _df(spark, [("a", None, "x"), (None, 1.0, "y")])
    after = before.filter("k IS NOT NULL").withColumn("extra", before.v)
    p = {r.column_name: (r.ordinal, r.total_rows, r.null_count) for r in PR.profile(before).collect()}
    assert p == {"k": (1, 2, 1), "v": (2, 2, 1), "s": (3, 2, 0)}
    cmp = {r.column_name: r for r in PR.compare_profiles(before, after).collect()}
    assert cmp["extra"].rows_before is None and cmp["extra"].nulls_after == 1
    sl = PR.schema_listing(spark, before).collect()
    assert [(r.column_name, r.data_type) for r in sl] == [("k", "string"), ("v", "double"), ("s", "string")]
    rc = PR.row_counts(before=before, after=after).first()
    assert (rc.before, rc.after) == (2, 1)
