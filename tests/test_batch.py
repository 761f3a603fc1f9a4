"""The batch end to end on the smallest tables: load -> marts -> checks."""

from tidemart.__main__ import main
from tidemart.sources import versions


def test_batch_runs_clean(spark, tmp_path):
    assert main(["--source", "/root/testdata/sf0.001", "--out", str(tmp_path / "batch")]) == 0
    fct = versions.read(spark, str(tmp_path / "batch" / "marts.db" / "fct_orders"))
    assert fct.count() == 1500 == spark.table("marts.fct_orders").count()
    assert spark.table("raw.orders").count() == 1500
    checks = spark.read.parquet(str(tmp_path / "batch" / "checks"))
    assert checks.filter("status = 'fail'").count() == 0 and checks.count() == 22


def test_missing_landing_file_is_skipped(spark, tmp_path):
    from tidemart.sources.files import multi_file_load
    landing = tmp_path / "landing"
    (landing / "sellers.csv").mkdir(parents=True)
    (landing / "sellers.csv" / "part-0.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00001,X,NA\n")
    rep = {r["table_name"]: r for r in multi_file_load(
        spark, str(landing), str(tmp_path / "raw"),
        {"sellers.csv": "sellers", "orders.csv": "orders"}).collect()}
    assert rep["orders"]["status"] == "skipped" and rep["orders"]["rows"] == 0
    assert rep["sellers"]["status"] == "loaded" and rep["sellers"]["rows"] == 1
    # pandas-style NA marker became NULL on load
    assert versions.read(spark, str(tmp_path / "raw" / "sellers")).first()["seller_state"] is None


def _csv(folder, name, *files):
    (folder / name).mkdir(parents=True)
    for i, text in enumerate(files):
        (folder / name / f"part-{i}.csv").write_text(text)
    return str(folder / name)


def test_csv_columns_are_matched_by_header(spark, tmp_path):
    from tidemart.sources.files import read_csv_text
    path = _csv(tmp_path, "s.csv", "seller_state,seller_id,seller_zip_code_prefix,seller_city\n"
                                   "SP,s1,01001,sao paulo\n")
    (r,) = read_csv_text(spark, path, "sellers").collect()
    assert r.asDict() == {"seller_id": "s1", "seller_zip_code_prefix": "01001",
                          "seller_city": "sao paulo", "seller_state": "SP"}


def test_csv_missing_unknown_and_differing_headers_fail(spark, tmp_path):
    import pytest
    from tidemart.sources.files import HeaderMismatch, multi_file_load, read_csv_text
    head = "seller_id,seller_zip_code_prefix,seller_city"
    for i, bad in enumerate((head, head + ",seller_state,more", head + ",state")):
        with pytest.raises(HeaderMismatch):
            read_csv_text(spark, _csv(tmp_path, f"b{i}.csv", bad + "\n"), "sellers")
    with pytest.raises(HeaderMismatch):  # only a missing path is skipped
        multi_file_load(spark, str(tmp_path), str(tmp_path / "raw"), {"b0.csv": "sellers"})
    two = _csv(tmp_path, "two.csv", head + ",seller_state\ns1,1,x,SP\n",
               "seller_state,seller_id,seller_zip_code_prefix,seller_city\nSP,s2,2,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, two, "sellers").collect()


def test_skipped_file_is_marked_and_can_fail(spark, tmp_path):
    import pytest
    from tidemart.plans.refresh import RefreshFailed, refresh_all
    from tidemart.sources.files import multi_file_load
    src = _csv(tmp_path, "sellers.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1,x,S\n")
    assert src
    multi_file_load(spark, str(tmp_path), str(tmp_path / "raw"), {"sellers.csv": "sellers"})
    (r,) = multi_file_load(spark, str(tmp_path / "none"), str(tmp_path / "raw"), {"sellers.csv": "sellers"}).collect()
    assert r["status"] == "skipped, table is stale"
    with pytest.raises(RefreshFailed):
        refresh_all(spark, str(tmp_path / "none"), str(tmp_path / "out"), fail_on_skipped=True)


def test_buckets_grow_with_the_landing_files(spark, tmp_path, monkeypatch):
    from tidemart.plans import refresh
    monkeypatch.setattr(refresh, "BUCKET_BYTES", 100)
    for name, size in (("olist_orders_dataset.csv", 390), ("olist_order_items_dataset.csv", 1000)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.csv").write_text("x" * size)
    assert refresh.bucket_count(spark, str(tmp_path), 4) == 16
    assert refresh.bucket_count(spark, str(tmp_path), 64) == 64
    assert refresh.bucket_count(spark, str(tmp_path / "none"), 4) == 4


def test_materialised_models_read_the_written_fact(spark, monkeypatch):
    from tidemart.keys import sources
    seen, materialise = {}, sources.files.materialise
    monkeypatch.setattr(sources.files, "materialise",
                        lambda df, path: seen.setdefault(path.rpartition("/")[2], df) and materialise(df, path))
    got = {r["model"]: r["rows"] for r in sources.table_materialise(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(sources.MART_TABLES) == set(seen)
    assert all("/fct_orders/" in f for f in seen["mart_churn_labels"].inputFiles())
    assert not any(f.endswith("/customer.parquet") for f in seen["mart_customer_features"].inputFiles())
