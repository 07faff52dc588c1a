"""Hosts of very many labels."""

from __future__ import annotations

from geoledger.llm import urls


def test_hosts_of_many_labels(spark):
    host = "a." * 60_000
    rows = [(1, f"http://{host}com/en/x"), (2, f"http://{host}net/x"), (3, "http://example.com/en/7"), (4, "http://" + "." * 50_000 + "com/en/"), (5, "http://com/en/"), (6, f"http://{host}xcom/en/")]
    rules = urls.rule_table(spark, [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "a.a.net/")])
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert found == {1: ("com/en/", "block"), 2: ("a.a.net/", "block"), 3: ("example.com/en/7", "allow"), 4: ("com/en/", "block"), 5: ("com/en/", "block"), 6: (None, "allow")}
