"""Declarative column checks."""

from gridmart.operators import checks as C


def test_run_checks(spark):
    df = spark.createDataFrame(
        [("A", 2000, 1.0), ("A", 2000, None), ("B", 2031, 50.0), ("B", None, 101.0), (None, 2001, 5.0)],
        "entity string, year int, share double")
    out = {(r["column_name"], r["check_name"]): r for r in C.run_checks(df, "t", [
        C.not_null("share"), C.not_null("year"), C.accepted_range("year", 2000, 2030),
        C.accepted_range("share", 0, 100), C.unique("entity", "year"), C.unique("year"),
    ]).collect()}
    assert out[("share", "not_null")]["violations"] == 1
    assert out[("year", "not_null")]["violations"] == 1
    assert out[("year", "accepted_range[2000,2030]")]["violations"] == 1      # NULL passes
    assert out[("share", "accepted_range[0,100]")]["violations"] == 1
    assert out[("entity,year", "unique")]["violations"] == 2
    assert out[("year", "unique")]["violations"] == 2
    assert out[("share", "not_null")]["passed"] is False
    assert all(r["table_name"] == "t" for r in out.values())


def test_checks_pass_on_clean_table(spark):
    df = spark.createDataFrame([("A", 2000), ("A", 2001)], "entity string, year int")
    rows = C.run_checks(df, "t", [C.unique("entity", "year"), C.not_null("year")]).collect()
    assert all(r["passed"] for r in rows) and len(rows) == 2


def test_checks_multi_table(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(None,)], "x int")
    rows = C.run_table_checks({"a": a, "b": b}, {"a": [C.not_null("x")], "b": [C.not_null("x")]}).collect()
    assert {r["table_name"]: r["passed"] for r in rows} == {"a": True, "b": False}


def test_checks_observed_by_the_write(spark, tmpdir_path):
    """The report equals run_checks, and the table is not read for null and range checks."""
    from gridmart.operators import checks as C
    from gridmart.sources import files
    rows = [(i % 7 if i % 5 else None, 2000 + i % 50, float(i) if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "entity int, year int, v double").repartition(5)
    specs = [C.not_null("entity"), C.accepted_range("year", 2000, 2030), C.unique("entity", "year"), C.not_null("v"), C.accepted_range("v", 10, None)]
    passing, told = C.observed(df, specs)
    path = f"{tmpdir_path}/t"
    files.write_table(passing, path)
    stored = files.read_table(spark, path)
    want = sorted(tuple(r) for r in C.run_checks(stored, "t", specs).collect())
    assert sorted(C.report("t", specs, told, stored)) == want
    assert sorted(C.report("t", [s for s in specs if s.kind != "unique"], told, None)) == sorted(r for r in want if r[2] != "unique")
    assert C.observed(df, [C.unique("v")])[1] is None


def test_checks_of_an_empty_table(spark, tmpdir_path):
    from gridmart.operators import checks as C
    from gridmart.sources import files
    df, told = C.observed(spark.createDataFrame([], "year int"), [C.not_null("year")])
    files.write_table(df, f"{tmpdir_path}/e")
    assert C.report("e", [C.not_null("year")], told, df) == [("e", "year", "not_null", 0, True)]
