import pytest

from docketlab.operators import coverage, metrics
from docketlab.plans import records, scratch
from docketlab.sources import tables


def test_the_best_method_comes_first(spark):
    rows = [("a", "x", 0.1), ("b", "x", 0.9), ("b", "y", 0.7), ("c", "y", 0.8), ("d", "x", 0.8)]
    got = metrics.ranked_methods(spark.createDataFrame(rows, "method string, category string, f1 double")).collect()
    assert [r.method for r in got] == ["b", "c", "d", "a"] and got[0].x == 0.9 and got[0].y == 0.7 and got[1].x is None


def test_records_keep_breaks_quotes_and_nulls(spark):
    rows = [(1, 'a "quoted"\nline, é', None), (2, "", "x"), (3, None, "中")]
    df = spark.createDataFrame(rows, "id long, text string, more string")
    path = records.place(spark, "rows.jsonl")
    assert tables.write_records(df, path).first().n == 3
    assert sorted(map(tuple, tables.read_table(spark, path, df.schema).collect())) == rows
    tables.write_records(df, path, append=True)
    assert tables.read_table(spark, path, df.schema).count() == 6


def test_no_local_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch.shared_root(Session())


def test_rows_that_count(spark):
    rows = spark.createDataFrame([(1, "Fresno PD", "A", "p"), (1, "elsewhere", "B", None), (2, "elsewhere", None, "")], "person_nbr long, agency_name string, first_name string, text string")
    assert {(r.person_nbr, r.agency_name) for r in coverage.ever_worked_at(rows, ["fresno"]).collect()} == {(1, "Fresno PD"), (1, "elsewhere")}
    assert coverage.with_text(rows, "text").count() == 1 and coverage.with_text(rows, "text", present=False).count() == 2
    full = rows.selectExpr("first_name", "'M' AS middle_name", "'L' AS last_name", "CAST(NULL AS string) AS suffix", "agency_name", "'1' AS start_date", "CAST(NULL AS string) AS end_date", "person_nbr", "text")
    low = coverage.employment_rows(full).collect()
    assert low[0].asDict() == dict(first_name="a", middle_name="m", last_name="l", suffix="", agency_name="fresno pd", start_date="1", end_date="", person_nbr=1) and low[2].first_name == ""
    f = spark.createDataFrame([(["x", "y"], ["y", "z"]), (None, None)], "extracted_dates_fp array<string>, extracted_dates_fn array<string>")
    got = f.select(*[coverage.features_of("dates", m).alias(m) for m in ("filepath_only", "filename_only", "combined")]).collect()
    assert tuple(got[0]) == (["x", "y"], ["y", "z"], ["x", "y", "z"]) and tuple(got[1]) == (None, None, None)
    c = spark.createDataFrame([("TP",), ("FP",), ("FN",), (None,)], "class string")
    assert sorted(r[0] for r in coverage.mismatches(c).collect()) == ["FN", "FP"]
