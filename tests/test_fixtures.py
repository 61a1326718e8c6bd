import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from acceptance import fixtures as X
from acceptance import cases_sources  # noqa: F401  (registers the queries)
from acceptance.registry import QUERIES
from hearthlake.operators import extract as E


@pytest.fixture
def tables(spark, tmp_path):
    """Driver tables of a few rows: user 1 has events in two blocks, user 3 in one, page 2 lists nothing, page 7 is broken."""
    at = datetime(2024, 1, 1, 8)
    events = [(5, at, 1, "view", 30.0, "{}"), (3, at, 1, "click", 60.0, "{}"), (X.BLOCK + 1, at.replace(day=2), 1, "view", 10.0, "{}"),
              (8, at.replace(day=3), 3, "view", 10.0, "{}"), (9, at, 7, "view", 10.0, "{}"), (10, None, 4, "view", 10.0, "{}")]
    rows = {
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "customer": ([(n, f"c{n}", 0, "AUTO") for n in range(9)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, "BRAZIL", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "AMERICA")], "r_regionkey int, r_name string"),
        "pages": ([(n, "u", "<html><body>x</body></html>") for n in (1, 2, 3, 7)], "page_id long, url string, html string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    return str(tmp_path / "sf")


def test_landed_files_of_all_dates_are_scanned(spark, tables):
    rows = QUERIES["scan_snapshots"](spark, tables).collect()
    found = sorted((r.file_date or "", r.page, r.listings) for r in rows)
    assert [(d, n) for d, _, n in found] == [("", 1)] + [("2024-01-01", 1)] * 3 + [("2024-01-02", 1), ("2024-01-03", 1)]
    assert found[0][1] == 2  # the event without a time, on its page


def test_landed_pages_list_their_block_in_order_of_events(spark, tables):
    pages = X.listing_pages(spark, tables)
    assert pages.columns == ["page_id", "block", "url", "html"]
    found = E.extract_pages(pages).selectExpr("page_id", "block", "status", "transform(elements, e -> e.id) AS ids").collect()
    assert sorted(tuple(r) for r in found) == [
        (1, 0, "ok", ["3", "5"]), (1, 1, "ok", [str(X.BLOCK + 1)]), (2, 0, "no_item_list", None), (3, 0, "ok", ["8"]), (7, 0, "malformed_json", None),
    ]
    body = pages.where("page_id = 1 AND block = 0").select(E.jsonld_blocks(F.col("html"))[1]).first()[0]
    assert body == json.dumps(json.loads(body), separators=(",", ":"))
    assert [(e["@type"], e["position"]) for e in json.loads(body)["itemListElement"]] == [("ListItem", 1), ("ListItem", 2)]


def test_copies_of_html_are_neither_stored_nor_shuffled(spark, tables, plan_of):
    pages = X.listing_pages(spark, tables)
    stored = [f for f in pages.inputFiles() if tables not in f]
    assert stored and "html" not in spark.read.parquet(*stored).columns
    plan = plan_of(pages, "simple").splitlines()
    above_join = plan[: next(i for i, line in enumerate(plan) if "Join" in line)]
    assert not any("Exchange" in line for line in above_join)


def test_listings_are_made_after_the_events_are_dealt_out(spark, tables, plan_of):
    plan = plan_of(X.build_item_lists(spark, tables, False), "simple").splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(user_id" in line]
    made = [i for i, line in enumerate(plan) if "collect_list" in line or "StructsToJson" in line]
    assert len(exchanges) >= 1 and max(made) < exchanges[0]
