"""The adapter's lines: numbered over the whole input, dated by their logs, dealt once."""

import datetime as dt

from upkeep.sources import testdata as td

D = dt.datetime


def test_lines_are_numbered_and_dated_where_order_keys_repeat(spark, tmp_path):
    tables = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "C1", 0, -5.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(1, "P", "b", "t", 1)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": (
            [(5, 1, "F", 10.0, D(1996, 1, 1), "2-HIGH"), (5, 1, "O", 11.0, D(1997, 1, 1), "5-LOW"), (2, 1, "F", 9.0, D(1995, 1, 1), "5-LOW"), (3, 1, "F", 9.0, D(1995, 1, 1), "none"), (9, 1, "F", 1.0, D(1998, 1, 1), "1-URGENT")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(k, n, D(1996, 1, n), 1, 1, 1.0, 2.0, "R") for k, n in ((5, 2), (5, 1), (3, 1), (2, 1), (7, 1))],
            "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    t, details, kept = td.build_tables(spark, str(tmp_path))
    # orders 2, 3 and twice 5 (each line with either order); 7 has no order
    got = sorted(((r.id, r.maintenance_log_id, r[td.YEAR_COL]) for r in details.collect()), key=str)
    want = [(1, 2, 1995), (2, 3, None)] + [(i, 5, y) for i in (3, 4, 5, 6) for y in (1996, 1997)]
    assert got == sorted(want, key=str)
    comps = sorted((r.id, r.slot_label) for r in t.equipment_component.collect())
    assert comps == [(1, "1"), (2, "1"), (3, "1"), (4, "1"), (5, "2"), (6, "2")]
    assert sorted((r.id, r.equipment_component_id) for r in t.maintenance_log.collect()) == [(2, 1), (5, None), (5, None), (9, None)]
    plan = details._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 2  # the kept lines and starts: no join with the logs
    for frame in kept:
        frame.unpersist()
