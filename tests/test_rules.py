import pytest
from pyspark.sql import functions as F

from shopledger.functions import rules

SCHEMA = (
    "process string, working_hours double, make_ready bigint, output_qty double, revenue double, "
    "number_of_lines bigint, want boolean"
)


def check(spark, tier, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    bad = df.filter(rules.eligibility(tier) != F.col("want")).collect()
    assert bad == []


def test_table_spot_values():
    silver = {r[:3]: r[3:] for r in rules.threshold_rows("silver")}
    gold = {r[:3]: r[3:] for r in rules.threshold_rows("gold")}
    assert len(silver) == 66 + 12 and len(gold) == 70 + 12
    assert silver["Die Cutting", 8, 1] == (8, 34000) and silver["Die Cutting", 10, 2] == (8, 34400)
    assert silver["Die Cutting", 12, 4] == (6, 25800)
    assert silver["Printing_CX102", 8, 7] == (2, 16000) and silver["Printing_CX102", 8, 8] == (1, 0)
    assert silver["Printing_CX104", 10, 9] == (2, 17000) and silver["Printing_CX104", 12, 13] == (0, 0)
    assert gold["Die Cutting", 8, 2] == (6.5, 34450) and gold["Die Cutting", 12, 3] == (9, 47700)
    assert gold["Printing_CX102", 8, 2] == (7.15, 64350) and gold["Printing_CX102", 10, 12] == (0.65, 0)
    assert gold["Printing_CX102", 12, 13] == (1.8, 16200) and gold["Printing_CX104", 8, 8] == (2.05, 19475)
    assert gold["Printing_CX104", 12, 2] == (11.15, 105925) and gold["Printing_CX104", 10, 11] == (1.5, 14250)


@pytest.mark.parametrize("tier", ["silver", "gold"])
def test_printing_rows_at_and_below_the_threshold(spark, tier):
    table = [r for r in rules.threshold_rows(tier) if r[0].startswith("Printing")]
    rows = []
    for process, cap, m, hours, quantity in table:
        rows.append((process, hours, m, quantity, None, 1, True))
        if quantity > 0:
            # One sheet less fails unless another cap's row of the same count lets it pass.
            others = [r for r in table if r[0] == process and r[2] == m and hours <= r[1]]
            passes = any(hours >= r[3] and quantity - 1 >= r[4] for r in others)
            rows.append((process, hours, m, quantity - 1, None, 1, passes))
        rows.append((process, 12.5, m, 1e9, None, 1, False))
    rows.append(("Printing_CX102", 8.0, 99, 1e9, None, 1, False))
    check(spark, tier, rows)


@pytest.mark.parametrize("tier", ["silver", "gold"])
def test_die_cutting_rows(spark, tier):
    rows = []
    for process, cap, m, _hours, quantity in rules.threshold_rows(tier):
        if process == "Die Cutting":
            inside = {8: 9.0, 10: 11.0, 12: 13.0}[cap]
            rows.append((process, inside, m, quantity, None, 1, True))
            rows.append((process, inside, m, quantity - 1, None, 1, False))
    rows += [
        ("Die Cutting", 9.0, 5, 0.0, None, 1, True), ("Die Cutting", 8.0, 5, 1e9, None, 1, False),
        ("Die Cutting", 10.0, 7, 0.0, None, 1, True), ("Die Cutting", 9.0, 0, 1e9, None, 1, False),
        ("Die Cutting", None, 5, 1e9, None, 1, False), ("Die Cutting", 9.0, 5, None, None, 1, False),
        ("Printing", 9.0, 1, 1e9, 1e9, 1, False), (None, 9.0, 1, 1e9, 1e9, 1, False),
    ]
    check(spark, tier, rows)


@pytest.mark.parametrize("tier, rate", [("silver", 3500), ("gold", 4000)])
def test_line_processes(spark, tier, rate):
    rows = []
    for hours, cap in ((8.5, 8), (10.0, 8), (10.5, 10), (12.0, 10), (12.5, 12)):
        for lines, factor in ((1, 1.0), (3, 2.25), (0, 0.0)):
            need = rate * cap * factor
            rows.append(("Gluing", hours, 1, None, need, lines, True))
            rows.append(("WindowPatching", hours, 1, None, need - 1, lines, False))
    rows += [("Gluing", 8.0, 1, 1.0, 1e9, 1, False), ("Gluing", 9.0, 1, 1.0, None, 1, False)]
    check(spark, tier, rows)


def test_sheeting_gold(spark):
    cases = [
        (7.0, 1e9, False), (7.5, 80000, True), (7.5, 79999, False), (8.0, 80000, True), (8.01, 80000, False),
        (10.0, 100000, True), (10.0, 99999, False), (12.0, 120000, True), (12.0, 119999, False),
        (12.99, 120000, True), (13.0, 129999, False), (13.0, 130000, True), (None, 1e9, False), (9.0, None, False),
    ]
    df = spark.createDataFrame([(h, float(p) if p is not None else None, w) for h, p, w in cases],
                               "working_hours double, paper_sheets double, want boolean")
    assert df.filter(rules.sheeting_gold() != F.col("want")).collect() == []
