"""The staged order flow on ten customers: one seeded difference, one control."""

import pytest
from pyspark.sql import functions as F

from tablecraft.functions.scalars import band
from tablecraft.operators import compare as cmp
from tablecraft.operators.projections import exclude_values
from tablecraft.sources.tables import rows, run_stages

# The demo rows.
CUSTOMERS = [
    (1, "Alice Johnson", "GOLD", "US"), (2, "Bob Smith", "SILVER", "US"),
    (3, "Carol White", "BRONZE", "UK"), (4, "David Brown", "GOLD", "UK"),
    (5, "Eve Davis", "SILVER", "CA"), (6, "Frank Miller", "BRONZE", "CA"),
    (7, "Grace Wilson", "GOLD", "US"), (8, "Henry Taylor", "SILVER", "UK"),
    (9, "Ivy Anderson", "BRONZE", "US"), (10, "Jack Thomas", "GOLD", "CA"),
]
ORDERS = [
    (1001, 1, "2024-01-05", "COMPLETED"), (1002, 2, "2024-01-08", "COMPLETED"),
    (1003, 1, "2024-01-12", "COMPLETED"), (1004, 3, "2024-01-15", "SHIPPED"),
    (1005, 4, "2024-01-18", "COMPLETED"), (1006, 5, "2024-01-22", "COMPLETED"),
    (1007, 2, "2024-01-25", "CANCELLED"), (1008, 6, "2024-01-28", "COMPLETED"),
    (1009, 7, "2024-02-01", "COMPLETED"), (1010, 8, "2024-02-05", "SHIPPED"),
    (1011, 1, "2024-02-08", "COMPLETED"), (1012, 9, "2024-02-12", "COMPLETED"),
    (1013, 10, "2024-02-15", "PENDING"), (1014, 3, "2024-02-18", "COMPLETED"),
    (1015, 4, "2024-02-22", "COMPLETED"),
]
ITEMS = [
    (1001, 1, "1299.99"), (1001, 2, "49.99"), (1002, 1, "299.99"), (1002, 2, "59.99"),
    (1003, 1, "449.99"), (1003, 1, "129.99"), (1004, 1, "1299.99"), (1004, 1, "79.99"),
    (1005, 1, "599.99"), (1005, 1, "299.99"), (1006, 3, "49.99"), (1006, 5, "19.99"),
    (1007, 1, "89.99"), (1008, 2, "449.99"), (1008, 1, "129.99"), (1009, 1, "1299.99"),
    (1009, 1, "49.99"), (1010, 1, "599.99"), (1011, 2, "79.99"), (1011, 3, "19.99"),
    (1012, 1, "299.99"), (1013, 1, "1299.99"), (1014, 2, "89.99"), (1014, 1, "59.99"),
    (1015, 1, "449.99"),
]
TOTALS = {1: 2199.90, 2: 419.97, 3: 1619.95, 4: 1349.97, 5: 249.92, 6: 1029.97, 7: 1349.98,
          8: 599.99, 9: 299.99}


def flow(spark, high, digits, by_division):
    items = rows(spark, ITEMS, "order_id int, quantity int, price string").withColumn(
        "price", F.col("price").cast("decimal(6,2)")
    )
    orders = rows(spark, ORDERS, "order_id int, customer_id int, order_date string, status string")
    customers = rows(spark, CUSTOMERS, "customer_id int, name string, tier string, country string")
    kept = exclude_values(orders, "status", ["CANCELLED", "PENDING"])
    total = F.sum("order_total")
    average = total / F.countDistinct("order_id") if by_division else F.avg("order_total")
    return run_stages(
        {
            "order_totals": lambda s: kept.join(items, "order_id")
            .groupBy("order_id", "customer_id", "order_date", "status")
            .agg(F.sum(F.col("quantity") * F.col("price")).alias("order_total")),
            "customer_metrics": lambda s: s["order_totals"].groupBy("customer_id").agg(
                F.countDistinct("order_id").alias("order_count"),
                F.round(total, digits).cast("decimal(20,2)").alias("total_amount"),
                F.round(average, 2).cast("decimal(20,2)").alias("avg_order_value"),
                F.min("order_date").alias("first_order_date"),
                F.max("order_date").alias("last_order_date"),
            ),
            "final": lambda s: customers.join(s["customer_metrics"], "customer_id").withColumn(
                "customer_segment",
                band(F.col("total_amount"),
                     [(2000, "Premium"), (high, "High Value"), (100, "Standard")], "Low Value"),
            ),
        }
    )


@pytest.fixture(scope="module")
def flows(spark):
    return flow(spark, 500, 2, False), flow(spark, 600, 4, True), flow(spark, 500, 2, False)


def test_seeded_difference(flows):
    a, b, _ = flows
    keys = {"FINAL": ["customer_id"], "customer_metrics": ["customer_id"]}
    results, summaries = cmp.compare_stages(a, b, keys)
    found = {
        r.cte_name: (r.status, r.rows_source, r.rows_target, r.except_source_vs_target,
                     r.except_target_vs_source, r.total_differences)
        for r in results.collect()
    }
    assert found == {
        "order_totals": ("PASS", 13, 13, 0, 0, 0),
        "customer_metrics": ("PASS", 9, 9, 0, 0, 0),
        "final": ("FAIL", 9, 9, 1, 1, 2),
    }
    assert [tuple(r) for r in summaries["final"].collect()] == [("customer_segment", 1)]
    assert set(summaries) == {"final"}  # only where there are differences
    looked = cmp.investigate(a["final"], b["final"], ["customer_id"], "customer_segment")
    assert [tuple(r) for r in looked["pairs"].collect()] == [("High Value", "Standard", 1)]
    assert looked["count"].first().diff_count == 1
    assert looked["samples"].first().customer_id == 8
    verdict = cmp.summarise(results).first()
    assert (verdict.total, verdict.passed, verdict.failed) == (3, 2, 1)
    assert verdict.verdict == "REGRESSION FAILURES DETECTED"


def test_matching_flow_passes(flows):
    a, _, c = flows
    results, _ = cmp.compare_stages(a, c)
    assert {r.status for r in results.collect()} == {"PASS"}
    assert cmp.summarise(results).first().verdict == "ALL REGRESSION TESTS PASSED"


def test_totals(flows):
    got = {r.customer_id: float(r.total_amount) for r in flows[0]["final"].collect()}
    assert got == TOTALS


def test_stages_without_counterpart_and_errors(flows):
    a, b, _ = flows
    one = {"order_totals": a["order_totals"], "extra": a["final"], "final": a["final"]}
    two = {"order_totals": a["order_totals"], "final": b["final"].drop("tier")}
    results, _ = cmp.compare_stages(one, two, only_common=False)
    assert {r.cte_name: r.status for r in results.collect()} == {
        "order_totals": "PASS", "extra": "SKIPPED", "final": "ERROR"
    }
    results, _ = cmp.compare_stages(one, two)
    assert "extra" not in {r.cte_name for r in results.collect()}


def test_skipped_columns_do_not_count(flows):
    a, b, _ = flows
    assert cmp.compare(a["final"], b["final"], skip=["customer_segment"]).first().status == "PASS"


def test_copies_are_seen_by_row_counts_only(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,)], "v int")
    row = cmp.compare(a, b).first()
    assert (row.status, row.rows_source, row.rows_target) == ("PASS", 3, 2)


def test_repeated_keys_count_pairs_without_building_them(spark):
    a = spark.createDataFrame([(1, "x", 1)] * 5 + [(1, "y", None), (2, "z", 3), (None, "q", 0)],
                              "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 1)] * 3 + [(1, None, None), (2, "z", 4), (None, "r", 1)],
                              "k int, s string, n int")
    pairs = cmp.aligned(a, b, ["k"])
    want = {
        c: pairs.filter(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).count() for c in ("s", "n")
    }
    got = {r.column_name: r.difference_count for r in cmp.column_diffs(a, b, ["k"]).collect()}
    assert got == {c: n for c, n in want.items() if n}


def test_null_keys_align_only_on_request(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    assert cmp.aligned(a, a, ["k"]).count() == 1
    assert cmp.aligned(a, a, ["k"], null_safe=True).count() == 2


def test_no_aligned_rows_gives_an_empty_summary(spark):
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    b = spark.createDataFrame([(2, 1)], "k int, v int")
    assert cmp.column_diffs(a, b, ["k"]).count() == 0
    row = cmp.key_coverage(a, b, ["k"]).first()
    assert (row.aligned_keys, row.source_only_keys, row.target_only_keys) == (0, 1, 1)
