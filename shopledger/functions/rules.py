"""Bonus rules as column expressions.

A rule takes the frame's columns (hours, make-ready, quantity, revenue, lines)
and yields a boolean that is never null.  The thresholds are parameters, laid
out as a table by ``threshold_rows`` and looked up by make-ready count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.functions.text import flag

CAPS = (8, 10, 12)

# Fixed values.  Printing: hours per make-ready step, sheets per hour, rows per cap,
# and how many of the last rows of each cap ask for no quantity.
PRINTING = {
    ("silver", "Printing_CX102"): {"step": "1", "rate": 8000, "rows": (9, 11, 13), "free": 2},
    ("silver", "Printing_CX104"): {"step": "1", "rate": 8500, "rows": (9, 11, 13), "free": 2},
    ("gold", "Printing_CX102"): {"step": "0.85", "rate": 9000, "rows": (9, 12, 14), "free": 1},
    ("gold", "Printing_CX104"): {"step": "0.85", "rate": 9500, "rows": (9, 12, 14), "free": 1},
}
# Fixed values.  Die cutting: hours per make-ready step, sheets per hour.
DIE_CUTTING = {
    "silver": {"step": "2", "rate": 4300},
    "gold": {"step": "1.5", "rate": 5300},
}
# Fixed value.  The one quantity that does not follow rate * hours: (tier, cap, make-ready).
DIE_CUTTING_EXCEPTION = {("silver", 8, 1): 34000}
# Fixed values.  Line processes: revenue per hour of the band's cap, and the factor for several lines.
LINE_PROCESSES = ("Gluing", "WindowPatching")
LINE_RATE = {"silver": 3500, "gold": 4000}
LINE_FACTOR = 0.75
# Fixed values.  Sheeting: (hours above, hours up to, sheets at least).
SHEETING_BANDS = ((7, 8, 80000), (8, 10, 100000), (10, 12, 120000))
SHEETING_BASE, SHEETING_PER_HOUR = 120000, 10000


def _rows(cap: int, step: str, rate: int, n: int, free: int = 0) -> list[tuple[float, float]]:
    """(minimum hours, minimum quantity) for make-ready 1..n, in exact decimals."""
    out = []
    for k in range(n):
        hours = Decimal(cap) - Decimal(step) * k
        quantity = Decimal(0) if k >= n - free else rate * hours
        out.append((float(hours), float(quantity)))
    return out


def threshold_rows(tier: str) -> list[tuple[str, int, int, float, float]]:
    """The rule table: (process, cap, make-ready, minimum hours, minimum quantity)."""
    table = []
    for cap in CAPS:
        rule = DIE_CUTTING[tier]
        for m, (hours, quantity) in enumerate(_rows(cap, rule["step"], rule["rate"], 4), start=1):
            quantity = float(DIE_CUTTING_EXCEPTION.get((tier, cap, m), quantity))
            table.append(("Die Cutting", cap, m, hours, quantity))
    for (rule_tier, process), rule in PRINTING.items():
        if rule_tier != tier:
            continue
        for cap, n in zip(CAPS, rule["rows"], strict=True):
            for m, (hours, quantity) in enumerate(
                _rows(cap, rule["step"], rule["rate"], n, rule["free"]), start=1
            ):
                table.append((process, cap, m, hours, quantity))
    return table


def _lookup(tier: str, process: str, cap: int, make_ready: Column) -> tuple[Column, Column]:
    """Minimum hours and quantity for a make-ready count; null beyond the last row."""
    rows = [r for r in threshold_rows(tier) if r[0] == process and r[1] == cap]
    index = (make_ready - 1).cast("int")
    hours = F.get(F.array(*[F.lit(r[3]) for r in rows]), index)
    quantity = F.get(F.array(*[F.lit(r[4]) for r in rows]), index)
    return hours, quantity


def band_cap(hours: Column) -> Column:
    """The cap of the hour band: (8, 10] -> 8, (10, 12] -> 10, above -> 12, else null."""
    return F.when((hours > 8) & (hours <= 10), 8).when((hours > 10) & (hours <= 12), 10).when(hours > 12, 12)


def eligibility(
    tier: str,
    process: Column | None = None,
    hours: Column | None = None,
    make_ready: Column | None = None,
    quantity: Column | None = None,
    revenue: Column | None = None,
    lines: Column | None = None,
) -> Column:
    """Does the row reach the tier's thresholds for its process?"""
    process = F.col("process") if process is None else process
    hours = F.col("working_hours") if hours is None else hours
    make_ready = F.col("make_ready") if make_ready is None else make_ready
    quantity = F.col("output_qty") if quantity is None else quantity
    revenue = F.col("revenue") if revenue is None else revenue
    lines = F.col("number_of_lines") if lines is None else lines
    cap = band_cap(hours)

    def reaches(name: str, c: int) -> Column:
        need_hours, need_quantity = _lookup(tier, name, c, make_ready)
        return (hours >= need_hours) & (quantity >= need_quantity)

    die_cutting = cap.isNotNull() & (make_ready >= 5) & (quantity >= 0)
    for c in CAPS:
        die_cutting = flag(die_cutting) | flag((cap == c) & reaches("Die Cutting", c))

    need_revenue = F.lit(LINE_RATE[tier]) * cap
    several = F.when(lines == 1, F.lit(1.0)).otherwise(F.lit(LINE_FACTOR) * lines)
    line_process = revenue >= need_revenue * several

    rule = F.when(process == "Die Cutting", die_cutting)
    rule = rule.when(process.isin(*LINE_PROCESSES), line_process)
    for name in ("Printing_CX102", "Printing_CX104"):
        printing = F.lit(False)
        for c in CAPS:
            printing = printing | flag((hours <= c) & reaches(name, c))
        rule = rule.when(process == name, printing)
    return flag(rule)


def silver_rule() -> Column:
    return eligibility("silver")


def gold_rule() -> Column:
    return eligibility("gold")


def sheeting_gold(hours: Column | None = None, sheets: Column | None = None) -> Column:
    """Gold for sheeting: a sheet count per hour band, growing per full hour above 12."""
    hours = F.col("working_hours") if hours is None else hours
    sheets = F.col("paper_sheets") if sheets is None else sheets
    need = F.when(hours > 12, SHEETING_BASE + F.floor(hours - 12) * SHEETING_PER_HOUR)
    for above, upto, at_least in SHEETING_BANDS:
        need = need.when((hours > above) & (hours <= upto), at_least)
    return flag(sheets >= need)
