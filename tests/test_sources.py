"""Edge cases of the CSV and JSON extracts (FIXTURES.md §3)."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from salesmart.sources.api import read_api_pages
from salesmart.sources.csv import read_orders_csv, read_products_csv
from salesmart.sources.relational import read_db_orders


def _write(root, name, text):
    path = root.replace("file:", "") + "/" + name
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_binds_by_name_and_ignores_extra_columns(spark, tmp_root):
    p = _write(tmp_root, "reordered.csv",
               "Stock,Extra,Price,ProductName,ProductID,Category\n5,zz,10.50,Bolt,7,HW\n")
    assert _rows(read_products_csv(spark, p)) == [(7, "Bolt", "HW", pytest.approx(10.5), 5)]


def test_csv_trims_headers_and_cells(spark, tmp_root):
    # a thousands separator inside a quoted number is accepted
    p = _write(tmp_root, "padded.csv",
               ' ProductID , ProductName ,Category, Price ,Stock\n 7 ,  Bolt  , HW ,"1,234.50" , 5\n')
    r = read_products_csv(spark, p).collect()[0]
    assert (r.ProductID, r.ProductName, r.Category, str(r.Price), r.Stock) == (7, "Bolt", "HW", "1234.50", 5)


def test_csv_missing_column_fails(spark, tmp_root):
    p = _write(tmp_root, "missing.csv", "ProductID,ProductName,Category,Price\n1,a,b,1.00\n")
    with pytest.raises(AnalysisException):
        read_products_csv(spark, p).collect()


def test_csv_bad_number_fails(spark, tmp_root):
    p = _write(tmp_root, "bad.csv", "ProductID,ProductName,Category,Price,Stock\nzz,a,b,1.00,3\n")
    with pytest.raises(Exception):
        read_products_csv(spark, p).collect()


def test_csv_short_row_fails(spark, tmp_root):
    p = _write(tmp_root, "short.csv", "ProductID,ProductName,Category,Price,Stock\n1,a\n")
    with pytest.raises(Exception):
        read_products_csv(spark, p).select("ProductID").collect()


def test_csv_empty_string_cell_is_empty_text(spark, tmp_root):
    p = _write(tmp_root, "empty.csv", "ProductID,ProductName,Category,Price,Stock\n1,a,,1.00,3\n")
    assert read_products_csv(spark, p).collect()[0].Category == ""


def test_csv_quoted_line_break_with_multiline(spark, tmp_root):
    p = _write(tmp_root, "quoted.csv",
               'ProductID,ProductName,Category,Price,Stock\n1,"say ""hi"", then\nbreak",c,1.00,3\n')
    rows = read_products_csv(spark, p, multiline=True).collect()
    assert len(rows) == 1 and rows[0].ProductName == 'say "hi", then\nbreak'


def test_json_pages_unwrap_and_default_text(spark, tmp_root):
    p = _write(tmp_root, "api/p1.json",
               '{"products":[{"id":1,"title":null,"price":2.5,"stock":3},'
               '{"id":2,"title":"B","category":"c","price":"4.00","stock":1}],"total":2,"skip":0,"limit":0}\n'
               '{"products":[],"total":0,"skip":2,"limit":0}\n')
    rows = sorted(read_api_pages(spark, os.path.dirname(p)).collect())
    assert [(r.ProductID, r.ProductName, r.Category) for r in rows] == [(1, "", ""), (2, "B", "c")]


def test_json_numbers_as_text_are_accepted_and_junk_fails(spark, tmp_root):
    p = _write(tmp_root, "api3/p.json",
               '{"products":[{"id":"3","title":"C","category":"c","price":"1,5","stock":2}],'
               '"total":1,"skip":0,"limit":0}\n')
    with pytest.raises(Exception):
        read_api_pages(spark, os.path.dirname(p)).collect()
    p = _write(tmp_root, "api4/p.json",
               '{"products":[{"id":"3","title":"C","category":"c","price":"1.50","stock":"2"}],'
               '"total":1,"skip":0,"limit":0}\n')
    r = read_api_pages(spark, os.path.dirname(p)).collect()[0]
    assert (r.ProductID, str(r.Price), r.Stock) == (3, "1.50", 2)


def test_json_page_without_products_is_empty_and_missing_numbers_are_zero(spark, tmp_root):
    p = _write(tmp_root, "noprod.json", '{"total": 0}\n{"products": [{"id": 3, "title": "T"}]}\n')
    assert [tuple(map(str, r)) for r in read_api_pages(spark, p).collect()] == [("3", "T", "", "0.00", "0")]


def test_json_pretty_printed_page(spark, tmp_root):
    p = _write(tmp_root, "pretty.json", '{\n "products": [\n  {"id": 3, "title": "T", "price": 1.5,\n "stock": 2}],\n "total": 1}\n')
    assert read_api_pages(spark, p, multiline=True).count() == 1


def test_csv_folder_with_different_column_orders(spark, tmp_root):
    for name, text in (("a.csv", "ProductID,ProductName,Category,Price,Stock\n1,A,HW,1.00,10\n"),
                       ("b.csv", "Stock,ProductName,ProductID,Price,Category\n20,B,2,2.00,SW\n"),
                       ("sub/c.csv", "Price, Category ,Stock,Extra,ProductID,ProductName\n3.00,FW,30,zz,3,C\n"),
                       ("empty.csv", "")):
        folder = os.path.dirname(_write(tmp_root, f"mixed/{name}", text))
    folder = folder if folder.endswith("mixed") else os.path.dirname(folder)
    rows = [(r.ProductID, r.ProductName, r.Category, str(r.Price), r.Stock)
            for r in read_products_csv(spark, folder).orderBy("ProductID").collect()]
    assert rows == [(1, "A", "HW", "1.00", 10), (2, "B", "SW", "2.00", 20), (3, "C", "FW", "3.00", 30)]
    _write(tmp_root, "mixed/short.csv", "ProductID,ProductName,Category,Price\n4,D,HW,4.00\n")
    with pytest.raises(AnalysisException):
        read_products_csv(spark, folder).collect()


def test_csv_date_forms(spark, tmp_root):
    forms = ["2024-02-09", "02/09/2024", "2/9/2024", "2024-02-09 13:05:00", "2024-02-09T13:05:00", "02/09/2024 13:05:00"]
    p = _write(tmp_root, "dates.csv", "OrderID,CustomerID,OrderDate,Status\n" + "".join(f"{i},1,{d},F\n" for i, d in enumerate(forms)))
    assert {str(r.OrderDate) for r in read_orders_csv(spark, p).collect()} == {"2024-02-09"}
    for bad in ("2024-02-30", "13/13/2024", "soon"):
        p = _write(tmp_root, f"bad{len(bad)}{bad[:2]}.csv", f"OrderID,CustomerID,OrderDate,Status\n1,1,{bad},F\n")
        with pytest.raises(Exception):
            read_orders_csv(spark, p).collect()


def test_relational_null_fails(spark, tmp_root):
    good = spark.createDataFrame([(1, 2, "2024-01-02", "F", "2024-01-02 03:04:05")],
                                 "PedidoId int, ClienteId int, FechaPedido string, Estado string, FechaCreacion string")
    for i, column in enumerate(["ClienteId", "Estado"]):
        df = good.withColumn(column, F.lit(None).cast(dict(good.dtypes)[column]))
        df.write.parquet(f"{tmp_root}/null{i}")
        with pytest.raises(Exception, match=f"relational value missing in column {column}"):
            read_db_orders(spark, path=f"{tmp_root}/null{i}").collect()
    good.write.parquet(f"{tmp_root}/good")
    assert read_db_orders(spark, path=f"{tmp_root}/good").count() == 1


def test_landing_follows_its_input(spark, tmp_root):
    from salesmart.sources import landing
    sf = tmp_root + "/sf"
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    part.where("p_partkey <= 50").write.parquet(f"{sf}/part.parquet")
    first = read_products_csv(spark, landing.land_one(spark, sf, "products")).count()
    part.where("p_partkey <= 60").write.mode("overwrite").parquet(f"{sf}/part.parquet")
    assert (first, read_products_csv(spark, landing.land_one(spark, sf, "products")).count()) == (51, 61)


def test_strictness_does_not_depend_on_ansi_mode(spark, tmp_root):
    p = _write(tmp_root, "bad2.csv", "ProductID,ProductName,Category,Price,Stock\n1,a,b,zz,3\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            read_products_csv(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


# --- L1: the landed pages are the whole feed, once ------------------------------------
def _feed(root, pages, name="feed"):
    import json
    item = lambda i: {"id": i, "title": f"T{i}", "category": "c", "price": 1.5, "stock": 2}
    for k, (skip, size, total) in enumerate(pages):
        p = _write(root, f"{name}/p{k}.json", json.dumps(
            {"products": [item(skip + i) for i in range(size)], "total": total, "skip": skip, "limit": 3}))
    return os.path.dirname(p)


WHOLE = [(0, 3, 8), (3, 3, 8), (6, 2, 8)]


@pytest.mark.parametrize("pages", [WHOLE, WHOLE[::-1], WHOLE + [(8, 0, 8)], [(0, 1, 1)], [(0, 0, 0)]])
def test_complete_feeds_pass(spark, tmp_root, pages):
    from salesmart.sources.api import check_coverage
    check_coverage(spark, _feed(tmp_root, pages))


@pytest.mark.parametrize("pages, where", [
    (WHOLE[1:], "at 0"), (WHOLE[:2], "at 6"), ([WHOLE[0], WHOLE[2]], "at 3"),       # a page is lost
    (WHOLE + [WHOLE[1]], "at 3"),                                                      # doubled
    ([(0, 3, 8), (2, 4, 8), (6, 2, 8)], "at 2"),                                       # overlapping
    ([(0, 3, 8), (3, 3, 9), (6, 2, 8)], "at 9"),                                       # another total
    ([(0, 3, 8), (3, 3, 8), (6, 3, 8)], "at 8"),                                       # more than announced
    ([(0, 0, 8)], "at 0"),                                                             # nothing landed
])
def test_incomplete_feeds_fail(spark, tmp_root, pages, where):
    from salesmart.sources.api import FeedCoverageError, check_coverage
    with pytest.raises(FeedCoverageError, match=where):
        check_coverage(spark, _feed(tmp_root, pages))


def test_a_load_fails_on_a_lost_page_unless_the_check_is_off(spark, tmp_root):
    import dataclasses

    from salesmart.plans.pipeline import extract
    from salesmart.plans.queries import source_config
    from salesmart.sources.api import FeedCoverageError
    from tests.conftest import SF001
    cfg = dataclasses.replace(source_config(spark, SF001), api_pages=_feed(tmp_root, WHOLE[:2]))
    with pytest.raises(FeedCoverageError):
        extract(spark, cfg)
    assert extract(spark, dataclasses.replace(cfg, api_coverage=False))["api_products"].count() == 6
