from __future__ import annotations

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loanops.plans import daily, mandates, tickets
from loanops.sources import catalog, sinks
from loanops.sources.ticket_pages import parse_pages, read_ticket_pages
from tests.conftest import at, rows_of

AS_OF = "2024-03-10 15:00:00"


@pytest.fixture(scope="module")
def tables(make):
    requests = [
        (1, 21, 31, 41, "Alpha", "SUCCESS", 10.0, at("2024-03-10 06:59:59"), at("2024-03-10 08:00:00")),
        (2, 21, 32, None, "Beta", "SUCCESS", 20.0, at("2024-03-09 07:00:01"), None),
        (3, 22, 33, 42, "Beta", "SUCCESS", 30.0, at("2024-03-10 07:00:00"), None),
    ]
    payment = '{"bankRefNo": "B1", "paymentMode": "UPI"}'
    payments = [
        (41, 31, "SETTLED", "X", at("2024-03-09 10:00:00"), at("2024-03-09 10:00:00"), 5.0, "T41", None, payment),
        (42, 32, "SETTLED", "X", at("2024-03-08 10:00:00"), at("2024-03-09 09:00:00"), 6.0, "T42", at("2024-03-09 11:00:00"), payment),
        (43, 32, "COLLECTION_COMPLETE", "Y", at("2024-03-08 10:00:00"), at("2024-03-09 09:00:01"), 7.0, "T43", None, None),
        (44, 32, "FAILED", "Y", at("2024-03-09 10:00:00"), None, 8.0, "T44", None, payment),
        (45, 99, "SETTLED", "Y", at("2024-03-09 10:00:00"), None, 8.0, "T45", None, payment),
    ]
    return {
        "foreclosure_requests": make(
            "request_id int, account_id int, credit_id int, associated_collection_id int, lender_id string, status string, "
            "amount_due double, created_on ts, last_updated_on ts",
            requests,
        ),
        "collections": make(
            "collection_id int, credit_id int, collection_status string, collection_type string, payment_date ts, last_updated_on ts, "
            "actual_amount_collected double, transaction_id string, callback_received_on ts, pg_response string",
            payments,
        ),
        "credit_main": make("credit_id int, lender_loan_account_number string, lender_credit_id string", [(31, "L31", "LC31")]),
        "credits": make(
            "credit_id int, account_id int, lender_credit_id string, lending_partner_id string",
            [(31, 21, "LC31", "Alpha"), (32, 22, "LC32", "Beta")],
        ),
        "borrower_accounts": make("account_id int, account_holder_name string, account_holderpan string", [(21, "A", "PA"), (22, "B", "PB")]),
    }


def test_foreclosure_extract(tables, tmp_path):
    out = daily.foreclosure_collections(tables, AS_OF)
    shown = out.select("request_id", "collection_id", "created_on", "lender_credit_id", "actual_amount_collected", "callback_received_on")
    assert rows_of(shown) == [
        (1, 41, at("2024-03-10 12:29:59"), "LC31", 5.0, at("2024-03-09 15:30:00")),
        (2, None, at("2024-03-09 12:30:01"), None, None, None),
    ]
    assert daily.foreclosure_collections(tables, AS_OF, display=True).columns[:2] == ["Collection ID", "Customer Pan"]
    parts = daily.by_lender(out, ["Alpha", "Beta"])
    assert [parts[k].count() for k in ("Alpha", "Beta", None)] == [1, 1, 0]
    assert daily.by_lender(out, ["Beta"])[None].count() == 1
    sinks.write_per_lender(out, str(tmp_path / "x"))
    assert sorted(p.name for p in (tmp_path / "x").iterdir() if p.is_dir()) == ["lender=Alpha", "lender=Beta"]


def test_no_foreclosures_gives_no_rows(tables):
    assert daily.foreclosure_collections(tables, "2020-01-01").count() == 0


def test_repayments(tables):
    out = daily.repayments_of_day(tables, AS_OF, "Beta")
    assert rows_of(out) == [(43, "LC32", "B", at("2024-03-08 10:00:00"), 7.0, "Y", None, None, None)]
    alpha = daily.repayments_of_day(tables, AS_OF, "Alpha")
    assert rows_of(alpha) == [(41, "LC31", "A", at("2024-03-09 10:00:00"), 5.0, "X", "B1", "UPI", None)]


def test_mandates(make):
    request = '{{"mandate_request_id": "{}"}}'.format
    rows = [
        (1, at("2024-03-04 18:30:00"), "Finished", request("m1"), '{"emandate_status": "ok"}'),
        (1, at("2024-03-05 10:00:00"), "Failed", request("m1"), None),
        (2, at("2024-03-05 11:00:00"), "Failed", request("m2"), None),
        (3, at("2024-03-04 18:29:59"), "Finished", request("m3"), None),
    ]
    frame = make("application_id int, created_date_time ts, mandate_status string, save_mandate_request string, mandate_data string", rows)
    frame = frame.withColumns({"bank_account_number": F.lit("1"), "bank_ifsc_code": F.lit("2")})
    events = mandates.mandate_events(frame, AS_OF)
    assert events.count() == 3
    summary = mandates.mandate_summary(events, "Alpha")
    assert [tuple(r)[2:] for r in summary.collect()] == [
        (at("2024-03-04 00:00:00"), at("2024-03-01 00:00:00"), 2, 1, 2, 2, 1, 2)
    ]
    assert rows_of(mandates.application_counts(frame)) == [(1, 0, 1), (2, 0, 0), (3, 0, 1)]
    assert rows_of(mandates.status_counts(frame)) == [("Failed", 2), ("Finished", 2)]


@pytest.fixture(scope="module")
def pages(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    for page in range(1, 9):
        rows = [
            {
                "id": page * 10 + i,
                "status": "open",
                "subject": f"s{i}",
                "type": None,
                "requester_id": 5,
                "assignee_id": None,
                "tags": ["a", "b"],
                "custom_fields": [] if i else [{"id": 7, "value": f"v{page}"}, {"id": 7, "value": "later"}],
            }
            for i in range(2)
        ]
        (folder / f"page-{page}.json").write_text(json.dumps({"tickets": rows, "links": {"next": None}}))
    return str(folder)


def test_ticket_pages(spark, pages):
    raw = read_ticket_pages(spark, pages)
    assert raw.count() == 16 and read_ticket_pages(spark, pages, max_pages=6).count() == 12
    out = tickets.tickets(raw, {7: "Stage", 8: "Phone"})
    assert out.columns == ["Ticket ID", "Ticket Status", "Subject", "Type", "Requester", "Assignee", "Tags", "Stage", "Phone"]
    got = {r["Ticket ID"]: r["Stage"] for r in out.collect()}
    assert got[10] == "v1" and got[11] is None and got[80] == "v8"


def test_pages_without_a_number(spark, pages, tmp_path):
    text = Path(pages, "page-1.json").read_text()
    (tmp_path / "page-2.json").write_text(text)
    (tmp_path / "last.json").write_text(text)
    assert read_ticket_pages(spark, str(tmp_path)).count() == 4
    assert read_ticket_pages(spark, str(tmp_path), max_pages=5).count() == 2


def test_parse_pages(make, pages):
    text = Path(pages, "page-3.json").read_text()
    rows = parse_pages(make("n int, doc string", [(3, text), (4, "no json"), (5, None)]), "doc", "n")
    assert rows_of(rows.select("page", "position", "id")) == [(3, 0, 30), (3, 1, 31)]


def test_ticket_report_as_csv(spark, pages, tmp_path):
    report = tickets.tickets(read_ticket_pages(spark, pages), {7: "Stage"})
    sinks.write_indexed_csv(report, str(tmp_path / "t"), [F.col("`Ticket ID`").desc()])
    rows = sorted(_read_csv(tmp_path / "t"), key=lambda r: int(r["index"]))
    assert [int(r["Ticket ID"]) for r in rows] == sorted((p * 10 + i for p in range(1, 9) for i in range(2)), reverse=True)
    assert rows[0]["Tags"] == '["a","b"]'


def test_names_with_dots_and_order(spark, tmp_path):
    frame = spark.range(300, numPartitions=5).select(F.col("id").alias("ticket.id"), (F.col("id") % 7).alias("g"))
    assert sinks.with_row_number(frame, [F.col("`ticket.id`")]).columns == ["index", "ticket.id", "g"]
    sinks.write_csv(frame, str(tmp_path / "o"), [F.col("g"), F.col("`ticket.id`").desc()])
    assert [(int(r["g"]), int(r["ticket.id"])) for r in _read_csv(tmp_path / "o")] == sorted(((i % 7, i) for i in range(300)), key=lambda p: (p[0], -p[1]))


def test_lender_files_are_sorted(spark, tmp_path):
    frame = spark.range(200, numPartitions=4).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("lender_id"))
    sinks.write_per_lender(frame, str(tmp_path / "l"), order=[F.col("id").desc()])
    folders = sorted(p.name for p in (tmp_path / "l").iterdir() if p.is_dir())
    assert folders == ["lender=1", "lender=2", "lender=__HIVE_DEFAULT_PARTITION__"]
    for part in (tmp_path / "l").glob("*/*.csv"):
        with part.open() as handle:
            ids = [int(r["id"]) for r in csv.DictReader(handle)]
        assert ids == sorted(ids, reverse=True)


def test_equal_column_names_are_refused():
    assert sinks.table_columns(["5D Late", "5D+ Late"]) == {"5D Late": "5d_late", "5D+ Late": "5d_plus_late"}
    with pytest.raises(ValueError):
        sinks.table_columns(["A b", "a-b"])


def _read_csv(folder):
    rows = []
    for part in sorted(Path(folder).glob("*.csv")):
        with part.open() as handle:
            rows += list(csv.DictReader(handle))
    return rows


def test_csv_sinks(spark, tmp_path):
    frame = spark.range(500, numPartitions=7).select(F.col("id"), (F.col("id") % 5).alias("g"))
    sinks.write_csv(frame, str(tmp_path / "plain"))
    assert len(_read_csv(tmp_path / "plain")) == 500
    sinks.write_indexed_csv(frame, str(tmp_path / "indexed"), [F.col("g").desc(), "id"])
    rows = sorted(_read_csv(tmp_path / "indexed"), key=lambda r: int(r["index"]))
    assert [int(r["index"]) for r in rows] == list(range(500))
    assert [(int(r["g"]), int(r["id"])) for r in rows] == sorted(((i % 5, i) for i in range(500)), key=lambda p: (-p[0], p[1]))


def test_row_numbers_of_equal_rows_spread(spark):
    frame = spark.range(4000, numPartitions=8).select(F.lit(1).alias("same"))
    numbered = sinks.with_row_number(frame, ["same"])
    assert sorted(r[0] for r in numbered.select("index").collect()) == list(range(4000))


def test_publish(spark, tmp_path):
    frame = spark.sql("select 1 as `Ticket ID`, cast(null as string) as note")
    for _ in range(2):
        sinks.publish_all({"Grouped Created on": frame, "other": frame}, str(tmp_path), delivery=True)
    back = spark.read.parquet(str(tmp_path / "grouped_created_on"))
    assert [tuple(r) for r in back.select("ticket_id", "note").collect()] == [("1", "")]


def test_catalogs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    first = catalog.from_parquet(spark, str(tmp_path), ["a"])
    spark.range(5).createOrReplaceTempView("catalog_b")
    both = first | catalog.from_catalog(spark, ["catalog_b"])
    assert sorted(both) == ["a", "catalog_b"] and len(both) == 2
    assert both["a"].join(both["catalog_b"], "id").count() == 3


def test_session_settings(spark):
    from loanops.session import checkpoint_folder

    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert checkpoint_folder(spark) == checkpoint_folder(spark)
