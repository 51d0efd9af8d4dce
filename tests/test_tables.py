"""Building the wide table and the responses: the same rows from as many tasks as the input needs."""

import datetime as dt
import json
import re

import pytest

from pixeltally.workload import tables

PARTS = 60
REGIONS = [(0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"), (4, "MIDDLE EAST")]
PRIORITIES = list(tables.CONSOLES)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    rows = {
        "region": ("r_regionkey int, r_name string", REGIONS),
        "nation": ("n_nationkey int, n_regionkey int", [(k, k % 5) for k in range(10)]),
        "customer": ("c_custkey long, c_nationkey int", [(k, k % 10) for k in range(40)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp", [
            (k if k != 7 else None, k % 40, PRIORITIES[k % 5], dt.datetime(2001, 1, 1 + k % 28)) for k in range(100)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double", [
            (k % 100 if k % 29 else None, k * 7 % PARTS, float(k % 9)) for k in range(400)] + [(3, 3, 2.0)] * 2),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [
            (k, f"p{k}", f"Brand#{k % 9}", list(tables.GENRES)[k % 6], k % 50 + 1) for k in range(PARTS)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def dealt(plan, key):
    return [int(n) for n in re.findall(rf" Exchange hashpartitioning\({key}, (\d+)\)", plan)]


def test_lines_meet_orders_in_as_many_tasks_as_they_need(spark, sf_dir, plan_of, monkeypatch):
    whole = sorted(tables.build_wide(spark, sf_dir).collect(), key=lambda r: r["row_ord"])
    assert len(whole) > PARTS
    monkeypatch.setattr(tables, "LINES_PER_TASK", 10)
    cut = tables.build_wide(spark, sf_dir)
    plan = plan_of(cut)
    assert dealt(plan, "l_orderkey") == dealt(plan, "o_orderkey") == [41]
    assert sorted(cut.collect(), key=lambda r: r["row_ord"]) == whole


def test_candidates_are_collected_in_as_many_tasks_as_they_need(spark, sf_dir, plan_of, monkeypatch):
    monkeypatch.setattr(tables, "PARTS_PER_TASK", 2)
    responses = tables.build_responses(spark, sf_dir)
    plan = plan_of(responses)
    # Records grow with the table and are not broadcast.
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert dealt(plan, "title") == dealt(plan, "p_partkey") == [30]
    found = {r["title"]: [g["id"] for g in json.loads(r["payload"])["results"]] for r in responses.collect()}
    wanted = {}
    for k in range(PARTS):
        steps = [s for s in range(-2, 3) if not (s == 0 and k % 9 == 7)]
        wanted[f"p{k} ({k})"] = [] if k % 50 + 1 <= 5 else [k + s for s in steps if 0 <= k + s < PARTS]
    assert found == wanted
