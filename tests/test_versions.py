"""Versioned tables, the run ledger, quoted CSV in parallel, type inference."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tidemart.sources import databases, inference, quoted_csv, versions

def broken():
    return F.when(F.col("id") == 90, F.raise_error(F.lit("disk gone"))).otherwise(F.col("id")).cast("long").alias("id")


def ids(df):
    return sorted(r.id for r in df.collect())


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("v-"))


def test_a_failed_write_leaves_the_old_rows_and_is_cleaned_up(spark, tmp_path):
    path = tmp_path / "t"
    with pytest.raises(versions.NoVersion):
        versions.read(spark, str(path))
    versions.publish(spark.range(5), str(path))
    held = versions.read(spark, str(path))
    with pytest.raises(Exception, match="disk gone"):
        versions.publish(spark.range(0, 100, 1, 4).select(broken()), str(path))
    assert ids(versions.read(spark, str(path))) == [0, 1, 2, 3, 4]
    assert len(folders(path)) == 2  # the torn one is there, but not committed
    versions.publish(versions.read(spark, str(path)).select((F.col("id") + 1).alias("id")), str(path))
    assert ids(versions.read(spark, str(path))) == [1, 2, 3, 4, 5]
    assert ids(held) == [0, 1, 2, 3, 4]  # a reader of the version before goes on
    versions.publish(spark.range(2), str(path))
    assert ids(versions.read(spark, str(path))) == [0, 1] and len(folders(path)) == versions.KEEP


def test_an_empty_table_is_a_version(spark, tmp_path):
    versions.publish(spark.range(3), str(tmp_path / "t"))
    versions.publish(spark.range(3).filter("id > 5"), str(tmp_path / "t"))
    assert versions.read(spark, str(tmp_path / "t")).count() == 0


def test_a_name_follows_the_versions(spark, tmp_path):
    base = str(tmp_path)
    databases.replace_table(spark.range(3), "swap", "t", base)
    assert ids(spark.table("swap.t")) == [0, 1, 2]
    with pytest.raises(Exception, match="disk gone"):
        databases.replace_table(spark.range(0, 100, 1, 4).select(broken()), "swap", "t", base)
    assert ids(spark.table("swap.t")) == [0, 1, 2]
    databases.replace_table(spark.range(2), "swap", "t", base)
    assert ids(spark.table("swap.t")) == [0, 1]
    databases.replace_table(spark.createDataFrame([("x", 1)], "name string, id long"), "swap", "t", base)
    assert spark.table("swap.t").columns == ["name", "id"]
    spark.sql("DROP TABLE swap.t")
    assert ids(databases.open_table(spark, "swap", "t", base)) == [1]
    spark.sql("DROP DATABASE swap CASCADE")


def test_model_and_threshold_are_one_version(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer, StringIndexer
    from tidemart.plans import churn
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    stages = Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__"),
                              StringIndexer(inputCol="s", outputCol="i")]).fit(df)
    last = SQLTransformer(statement="SELECT *, i + 1 AS p FROM __THIS__")
    path = str(tmp_path / "m")
    churn.save_model(stages, last, ["i"], {"i": 0.0}, 0.25, path, spark)

    class Torn:
        pass
    with pytest.raises(Exception):
        churn.save_model(stages, Torn(), ["i"], {"i": 0.0}, 0.75, path, spark)
    model, meta = churn.load_model(path, spark)
    assert meta.first()["threshold"] == 0.25 and "p" in model.transform(df).columns


def test_a_stopped_batch_goes_on_at_the_failed_step(spark, tmp_path, monkeypatch):
    from tidemart.plans import ledger, refresh
    from tidemart.sources import files
    from tidemart.sources.fixtures import RawTables
    raw = RawTables(spark, "/root/testdata/sf0.001")
    landing = files.landing_for(spark, "/root/testdata/sf0.001", {n: raw.get(n) for n in RawTables.NAMES})
    out, names = str(tmp_path / "b"), {"raw_db": "raw_stop", "marts_db": "marts_stop"}
    whole = refresh.marts.mart_customer_features

    def stop(*a):
        raise OSError("lost the disk")
    monkeypatch.setattr(refresh.marts, "mart_customer_features", stop)
    with pytest.raises(OSError):
        refresh.refresh_all(spark, landing, out, **names)
    fct = tmp_path / "b" / "marts_stop.db" / "fct_orders"
    before = folders(fct)
    calls = []

    def once(*a):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("lost the disk again")
        return whole(*a)
    monkeypatch.setattr(refresh.marts, "mart_customer_features", once)
    report = {(r["step"], r["name"]): r for r in refresh.refresh_all(
        spark, landing, out, retries=1, **names).collect()}
    assert folders(fct) == before and len(calls) == 2
    status = {k[1]: r["status"] for k, r in report.items() if k[0] != "check"}
    assert {m for m, s in status.items() if s == "built"} == {"mart_customer_features", "mart_churn_labels"}
    assert all(s == "reused" for m, s in status.items() if m not in ("mart_customer_features", "mart_churn_labels"))
    assert report["model", "fct_orders"]["rows"] == 1500 == spark.table("marts_stop.fct_orders").count()
    states = [r["state"] for r in ledger.events(spark, f"{out}/ledger").orderBy("at").collect()]
    assert states.count("failed") == 2 and states[-1] == "finished"
    # a finished run is not gone on with; changed files are loaded anew
    again = refresh.refresh_all(spark, landing, out, **names)
    assert again.filter("status = 'reused'").count() == 0 and folders(fct) != before
    # a file that is gone while its old table exists is an error unless asked for
    import shutil
    import re
    shutil.copytree(re.sub("^file:", "", landing), tmp_path / "less", ignore=shutil.ignore_patterns("*sellers*"))
    with pytest.raises(refresh.RefreshFailed, match="sellers"):
        refresh.refresh_all(spark, str(tmp_path / "less"), out, **names)


# CSV ------------------------------------------------------------------------

def _write(path, rows, end):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["id", "a text", "n"])
        w.writerows(rows)


@pytest.mark.parametrize("split", ["7", "64", "1000000"])
def test_quoted_line_breaks_in_any_split(spark, tmp_path, split):
    """Ranges of a few bytes: breaks, quotes and record ends lie on the borders."""
    r = random.Random(int(split))
    texts = ["plain", 'with "quotes"', "line\nbreak", "a,b", "crlf\r\ninside", 'many\n\n\nbreaks "x"\n,"y', "", '"', '""\n"',
             "é\n" * 20, ",\"", "\n"]
    rows = [[f"id{i}", r.choice(texts), str(i)] for i in range(40)]
    _write(tmp_path / "a.csv", rows, "\n")
    _write(tmp_path / "b.csv", [[x + "b", t, n] for x, t, n in rows], "\r\n")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = sorted(tuple(x) for x in quoted_csv.read_records(spark, str(tmp_path)).collect())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == sorted((x + k, t or None, n) for x, t, n in rows for k in ("", "b"))


def test_quoted_csv_equals_the_unsplit_read(spark, tmp_path):
    _write(tmp_path / "a.csv", [["1", 'x\n"y"', "2"], ["2", "", "3"]], "\n")
    one = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path))
    many = quoted_csv.read_records(spark, str(tmp_path))
    assert many.columns == one.columns and sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))


def test_quotes_inside_plain_fields_are_characters():
    inside = quoted_csv.inside_after
    assert not inside('a"b,c', False) and inside('a,"b', False) and inside('"', False)
    assert not inside('x",y"z', True) and inside('x"",y', True) and not inside('"a" "b', False)
    assert inside('x","y', True) and not inside("", False) and inside("", True)


def test_csv_faults_are_errors(spark, tmp_path):
    for name, text in {"open": 'id,n\n1,"never closed\n', "more": "id,n\n1,2,3\n"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(text)
        with pytest.raises(Exception):
            quoted_csv.read_records(spark, str(tmp_path / name)).collect()
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "x.csv").write_text("id,n\n1,2\n")
    (tmp_path / "two" / "y.csv").write_text("n,id\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        quoted_csv.read_records(spark, str(tmp_path / "two"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("id,n\n\n\n")
    assert quoted_csv.read_records(spark, str(tmp_path / "none")).count() == 0


def test_inferred_types_are_those_of_pandas(spark, tmp_path):
    import pandas as pd
    from tidemart.sources.files import read_csv_inferred
    text = ('i,i_na,f,s,b,b_na,none,zip,big,day,t\n'
            '1,1,1.5,x,True,True,NA,00123,9223372036854775807,2017-01-01,"a\nb"\n'
            '-2,,2e3,7,false,,,00007,1,2017-02-01,"c ""d"""\n'
            '+3,N/A,inf,nan,TRUE,False,null,9,99999999999999999999,2018-01-01 10:00:00,e\n')
    (tmp_path / "x.csv").write_text(text)
    got = read_csv_inferred(spark, str(tmp_path), parse_dates=["day"])
    want = pd.read_csv(tmp_path / "x.csv")
    names = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string", "uint64": "double"}
    types = dict(got.dtypes)
    assert types.pop("day") == "timestamp_ntz"
    assert types.pop("big") == "double"  # beyond 64 bits, signed
    assert types == {c: names[str(want[c].dtype)] for c in want.columns if c not in ("day", "big")}
    rows = got.orderBy("i").collect()
    assert [r.i for r in rows] == [-2, 1, 3] and rows[1].t == "a\nb" and rows[0].t == 'c "d"'
    assert [r.zip for r in rows] == [7, 123, 9] and rows[2].s is None and rows[2].f == float("inf")
    with pytest.raises(ValueError):
        inference.typed(got, {}, ["nope"])
