from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest

from tillwright.plans import pipeline
from tillwright.session import shared_dir
from tillwright.sources import files, ingest
from tillwright.sources.landing import extract
from tillwright.sources.tables import Tables, newer, watermark


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "source files"

    def write(name, text):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")

    write("Region 1/customers_1.csv", 'customer_id,customer_email,customer_name,segment,country,city,state,region\n'
          'A-1,a@example.com,"Bell, ""Ann""", Home Office ,US,Here, There ,East\nA-2,NULL,Bo,CORP,US,,null,East\n0123,x,Short\n')
    write("Region 4/customers_4.csv", "﻿CustomerID,region,segment,customer_name,city,state\r\nA-3,W,CONS,Cy,Texas,Houston\r\n")
    write("Region2/transactions_1.csv", "Order_id,Product_id,Sales\nO1,P1,$5\n")
    write("transactions_3.csv", "Order_ID,Product_ID,Sales\nO2,P2,6\n")
    write("Region6/returns_1.json", json.dumps([
        {"order_id": "O1", "refund_amount": 8.25, "return_reason": "a ], b"}, {"order_id": "O2", "refund_amount": "?"}], indent=2))
    write("returns_2.json", '[\n{"OrderId":"O3","amount":1e3,"extra":{"k":[1,2]}},\n{"OrderId":"O4","amount":null}\n]\n')
    write("returns_3.json", '[{"OrderId":"O5"},{"OrderId":"O6"}]')
    write("returns_4.json", '{"OrderId":"O7"}\n{"OrderId":"O8"}\n')
    write("products.json", '{\n"product_id": "P1"\n}')
    write("notes.txt", "not a source file")
    return root, write


def test_csv_objects(spark, source, tmp_path):
    root, _ = source
    tables = Tables(spark, str(tmp_path / "wh"))
    ingest.ingest(spark, str(root), tables)
    rows = {r["_source_file"]: r for r in tables.read("landing_customers").collect()}
    assert set(rows) == {"Region 1/customers_1.csv", "Region 4/customers_4.csv"}
    assert rows["Region 4/customers_4.csv"]["raw_data"] == {
        "CustomerID": "A-3", "region": "W", "segment": "CONS", "customer_name": "Cy", "city": "Texas", "state": "Houston"}
    bronze = extract(tables.read("landing_customers"), "customers").where("_source_file like 'Region 1%'").orderBy("customer_id")
    short, first, second = bronze.collect()
    assert short["customer_id"] == "0123" and short["customer_name"] == "Short" and short["region"] is None
    assert first["customer_name"] == 'Bell, "Ann"' and first["segment"] == "Home Office" and first["state"] == "There"
    assert second["customer_email"] is None and second["state"] is None and second["city"] is None


def test_keys_that_differ_in_case(spark, source, tmp_path):
    root, _ = source
    tables = Tables(spark, str(tmp_path / "wh"))
    ingest.ingest(spark, str(root), tables)
    bronze = extract(tables.read("landing_transactions"), "transactions")
    found = {(r["order_id"], r["order_id_v1"], r["order_id_v2"], r["sales"]) for r in bronze.collect()}
    assert found == {(None, "O1", None, "$5"), (None, None, "O2", "6")}


def test_json_layouts(spark, source, tmp_path):
    root, _ = source
    tables = Tables(spark, str(tmp_path / "wh"))
    ingest.ingest(spark, str(root), tables)
    rows = {(r["order_id_v1"] or r["order_id_v2"]): r for r in extract(tables.read("landing_returns"), "returns").collect()}
    assert set(rows) == {f"O{i}" for i in range(1, 9)}
    assert rows["O1"]["refund_amount_v1"] == "8.25" and rows["O1"]["return_reason_v1"] == "a ], b"
    assert rows["O2"]["refund_amount_v1"] == "?" and rows["O4"]["refund_amount_v3"] is None
    assert float(rows["O3"]["refund_amount_v3"]) == 1000
    landed = tables.read("landing_returns").where("raw_data['OrderId'] = 'O3'").first()["raw_data"]
    assert json.loads(landed["extra"]) == {"k": [1, 2]}
    assert tables.read("landing_products").first()["raw_data"] == {"product_id": "P1"}


def test_modes_and_report(spark, source, tmp_path):
    root, write = source
    tables = Tables(spark, str(tmp_path / "wh"))
    with pytest.raises(ValueError):
        ingest.ingest(spark, str(root), tables, mode="fast")
    write("Region2/customers_2.csv", "\n")
    write("Region3/customers_3.csv", "cust_id,cust_id\n1,2\n")
    first = {(r["entity"], r["source_file"]): r for r in ingest.ingest(spark, str(root), tables, load_time=datetime(2024, 1, 1)).collect()}
    assert first["customers", "Region 1/customers_1.csv"]["row_count"] == 3
    assert first["customers", "Region2/customers_2.csv"]["status"] == "warning"
    assert first["customers", "Region3/customers_3.csv"]["status"] == "error"
    assert first["orders", None]["message"] == "no files found"
    write("Region1/orders_1.csv", "order_id\nO1\n")
    again = ingest.ingest(spark, str(root), tables, mode="incremental", load_time=datetime(2024, 1, 2))
    loaded = [(r["source_file"], r["row_count"]) for r in again.where("status = 'loaded'").collect()]
    assert loaded == [("Region1/orders_1.csv", 1)]
    counts = {r["entity"]: r["row_count"] for r in ingest.row_counts(tables).collect()}
    assert counts == {"customers": 4, "orders": 1, "transactions": 2, "returns": 8, "products": 1, "vendors": 0}
    assert {r["entity"]: r["row_count"] for r in ingest.totals(again).collect()}[None] == 1
    ingest.ingest(spark, str(root), tables, load_time=datetime(2024, 1, 3))
    assert tables.read("landing_customers").count() == 4
    assert watermark(tables.read("landing_orders")) == datetime(2024, 1, 3)


def test_a_load_that_broke_off_is_not_repeated(spark, source, tmp_path, monkeypatch):
    root, write = source
    tables = Tables(spark, str(tmp_path / "wh"))
    names = [ingest.landing_name(e) for e in ("customers", "returns", "products")]

    def load(day):
        ingest.ingest(spark, str(root), tables, mode="incremental", load_time=datetime(2024, 1, day))
        return [tables.read(n).count() for n in names]

    first = load(1)
    write("Region3/customers_3.csv", "cust_id\nA-7\n")
    record = ingest.record

    def broken(*arguments):
        raise RuntimeError("stopped before the files were noted")

    monkeypatch.setattr(ingest, "record", broken)
    with pytest.raises(RuntimeError):
        load(2)
    monkeypatch.setattr(ingest, "record", record)
    grown = [first[0] + 1, *first[1:]]
    assert load(3) == grown
    # from now on the landing tables are not searched for files
    monkeypatch.setattr(ingest, "_landed", broken)
    assert load(4) == grown
    write("Region3/customers_4.csv", "cust_id\nA-8\n")
    assert load(5) == [grown[0] + 1, *grown[1:]]


def test_a_warehouse_without_a_table_of_loaded_files(spark, source, tmp_path):
    root, _ = source
    tables = Tables(spark, str(tmp_path / "wh"))
    ingest.ingest(spark, str(root), tables, load_time=datetime(2024, 1, 1))
    counts = {tuple(r) for r in ingest.row_counts(tables).collect()}
    ingest.forget_loads(tables)
    for day in (2, 3):
        report = ingest.ingest(spark, str(root), tables, mode="incremental", load_time=datetime(2024, 1, day))
        assert {r["status"] for r in report.collect()} == {"skipped"}
        assert {tuple(r) for r in ingest.row_counts(tables).collect()} == counts


def test_unreadable_file_leaves_the_others(spark, source, tmp_path):
    root, write = source
    write("Region5/customers_5.csv.csv", "customer_id,region\nA-9,W\n")
    (root / "Region5" / "bad_customers.csv.gz").write_bytes(b"this is not gzip\n")
    routes = {**files.ROUTES, "customers": r".*customers.*[.]csv([.]gz)?"}
    write("returns_9.json", '[{"OrderId": "O1", ')
    tables = Tables(spark, str(tmp_path / "wh"))
    report = {r["source_file"]: r["status"] for r in ingest.ingest(spark, str(root), tables, routes=routes).collect()}
    assert report["Region5/bad_customers.csv.gz"] == "error"
    assert report["returns_9.json"] == "error" and report["returns_3.json"] == "loaded"
    assert tables.read("landing_returns").count() == 8
    assert report["Region5/customers_5.csv.csv"] == "loaded"
    assert tables.read("landing_customers").count() == 5


def test_many_files_with_headers_of_their_own(spark, tmp_path):
    """2,000 files in one read; each row gets the names of its own file."""
    root, tables = tmp_path / "src", Tables(spark, str(tmp_path / "wh"))
    headers = ["customer_id,region", "cust_id,segment,region", "CustomerID", "region,customerid,extra,more"]
    for i in range(2000):
        folder = root / f"Region{i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        names = headers[i % 4].split(",")
        (folder / f"customers_{i}.csv").write_text(headers[i % 4] + "\n" + ",".join(f"{n}{i}" for n in names) + "\n")
    report = ingest.ingest(spark, str(root), tables)
    assert dict(report.where("entity = 'customers'").groupBy("status").agg({"row_count": "sum"}).collect()) == {"loaded": 2000}
    for r in tables.read("landing_customers").collect():
        i = int(r["_source_file"].split("_")[1].removesuffix(".csv"))
        assert r["raw_data"] == {n: f"{n}{i}" for n in headers[i % 4].split(",")}
    again = ingest.ingest(spark, str(root), tables, mode="incremental")
    assert {r["status"] for r in again.collect()} == {"skipped"}


def test_notes_of_many_loads_stay_few_files(spark, tmp_path, monkeypatch):
    """However many loads there are, the notes are a bounded number of files, and none is lost."""
    monkeypatch.setattr(ingest, "NOTE_FILES", 8)
    tables = Tables(spark, str(tmp_path / "wh"))
    counts = []
    for i in range(60):
        rows = spark.range(i, i + 1).selectExpr("'orders'", "concat('o', id)", "timestamp_ntz'2024-01-01 00:00:00'")
        ingest._note(tables, ingest.LOADED_FILES, rows.toDF("entity", "source_file", "_load_timestamp"))
        counts.append(tables.file_count(ingest.LOADED_FILES))
    assert max(counts) <= 8 and counts.count(1) > 6
    assert tables.read(ingest.LOADED_FILES).select("source_file").distinct().count() == 60


def test_headers_by_scan(spark, source):
    root, _ = source
    listed = files.list_files(spark, str(root)).where("path like '%.csv'")
    scanned = {r["path"]: r["header"] for r in files._headers_by_scan(listed).collect()}
    assert len(scanned) == 4
    assert scanned == {r["path"]: r["header"] for r in files.headers(listed).collect()}


def test_line_breaks_in_quotes(spark, tmp_path):
    root = tmp_path / "src"
    root.mkdir()
    (root / "vendors.csv").write_text('vendor_id,vendor_name\nV1,"two\nlines"\nV2,one\n')
    tables = Tables(spark, str(tmp_path / "wh"))
    ingest.ingest(spark, str(root), tables, multiline=True)
    assert {r[0] for r in extract(tables.read("landing_vendors"), "vendors").select("vendor_name").collect()} == {"two\nlines", "one"}


def test_watermark_is_strict_and_null_loads_all(spark):
    rows = spark.sql("select * from values (1, timestamp_ntz'2024-01-01 00:00:00'), (2, timestamp_ntz'2024-01-01 00:00:01') t(v, _load_timestamp)")
    assert newer(rows, None).count() == 2
    assert watermark(rows.where("v > 9")) is None
    assert [r["v"] for r in newer(rows, watermark(rows.where("v = 1"))).collect()] == [2]


def test_whole_pipeline(spark, source, tmp_path):
    """Full, then incremental with a new file, then a repeat that adds nothing."""
    root, write = source
    write("Region1/orders_1.csv", "order_id,customer_id,vendor_id,ship_mode,order_status,order_purchase_date\nO1,A-1,V1,1st,Delivered,2018-01-05\n")
    write("Region2/transactions_1.csv", "Order_id,Product_id,vendor_id,Sales,Quantity,discount,profit\nO1,P1,V1,$5,1,10%,1\nO1,P2,V1,15,1,0,1\n")
    write("Region6/returns_1.json", '[{"order_id":"O1","return_reason":"Late","return_status":"APPRVD","refund_amount":8,"return_date":"2018-02-01"}]')
    write("products.json", '[{"product_id":"P1","product_name":"Pen"},{"product_id":"P2","product_name":"Cup"}]')
    write("vendors.csv", "vendor_id,vendor_name\nV1,Vel\n")
    tables = Tables(spark, str(tmp_path / "wh"))
    pipeline.run(spark, str(root), tables, "full", datetime(2024, 1, 1))
    shares = {r["product_id"]: r["allocated_refund"] for r in tables.read("bridge_return_products").collect()}
    assert shares == {"P1": 2.0, "P2": 6.0}
    assert tables.read("rag_query_history").count() == 5
    assert tables.read("ai_business_insights").count() == 3
    before = {r["doc_id"]: r["updated_at"] for r in tables.read("rag_documents").collect()}
    write("Region3/orders_2.csv", "order_id,customer_id,vendor_id,ship_mode,order_status,order_purchase_date\nO9,A-3,,Std,shipped,01/07/2018\n")
    write("Region4/transactions_2.csv", "order_id,product_id,vendor_id,Sales,Quantity,discount,profit\nO9,P1,V1,7,1,0,1\n")
    for moment in (datetime(2024, 1, 2), datetime(2024, 1, 3)):
        pipeline.run(spark, str(root), tables, "incremental", moment)
        assert tables.read("fact_sales").count() == 3
        assert tables.read("raw_orders").count() == 2
        assert tables.read("fact_returns").count() == 1
    after = {r["doc_id"]: r["updated_at"] for r in tables.read("rag_documents").collect()}
    assert after["product_P2"] == before["product_P2"] and after["vendor_V1"] > before["vendor_V1"]
    assert spark.table("mv_monthly_revenue_by_region").count() == 2
    assert spark.table("pipeline_audit_log").count() == 6
    pipeline.run(spark, str(root), tables, "full", datetime(2024, 1, 4))
    assert tables.read("fact_sales").count() == 3
    assert not list(Path(shared_dir(spark)).glob("tillwright/run-*"))
