"""The payout against a brute-force calculation, and its special cases one by one."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stipend import fixed_values as fixed
from stipend.plans import incentive

SCHEMAS = {
    "pairs": "store_a int, store_b int, begda date, endda date, wage_type string, case_id int, ids int",
    "sales": "store int, sale_date date, amount decimal(14,2), status int",
    "focus": "store int, begda date, focus string",
    "tariff": "case_id int, focus int, band int, pay_leader decimal(14,2), "
              "pay_manager decimal(14,2), pay_leader_focus decimal(14,2)",
    "history": "payee int, store int, role string, status int, date_start date, date_end date, "
               "area string",
    "absences": "payee int, start_date date, days int",
    "inflation": "rate decimal(14,4), begda date, endda date",
}
COLUMNS = [name for name, _ in fixed.PAYOUT_COLUMNS]


def day(text):
    return dt.date.fromisoformat(text)


def example():
    """One pair in April 2024 that grows by half: band 7, focus I for store B and E for store A."""
    return {
        "pairs": [(1, 2, day("2024-04-01"), day("2024-04-30"), "W", 1, 1)],
        "sales": [(2, day("2024-04-10"), Decimal(150), 1), (2, day("2023-04-30"), Decimal(100), 1),
                  (2, day("2024-04-11"), Decimal(999), 0)],
        "focus": [(2, day("2024-03-01"), "I"), (1, day("2024-03-01"), "E")],
        "tariff": [(1, 2, 7, Decimal(300), Decimal(60), Decimal(30)),
                   (1, 1, 7, Decimal(1), Decimal(90), Decimal(2))],
        "history": [],
        "absences": [],
        "inflation": [(Decimal("0.0450"), day("2024-01-01"), day("2024-12-31"))],
    }


def payout(spark, rows, as_of="2024-04-15", **options):
    tables = {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}
    detail = incentive.incentive_payout(**tables, as_of=F.lit(as_of).cast("date"), **options)
    assert detail.columns == COLUMNS
    return detail.collect()


def employee(payee, store, role, start="2024-01-01", end="2024-12-31", area="9", status=1):
    return (payee, store, role, status, day(start), day(end), area)


def test_each_role_is_paid_by_its_store(spark):
    rows = example()
    rows["history"] = [
        employee(1, 1, "L1", area=None), employee(2, 1, "E1", area=None),
        employee(3, 2, "E9", area=None), employee(4, 2, "L1"), employee(5, 1, "X"),
        employee(6, 1, "L1", status=0), employee(7, 3, "L1"),
    ]
    got = {(r.payee, r.role): (r.pay, r.area, r.days, float(r.month_days), r.band) for r in payout(spark, rows)}
    assert got == {
        (1, "L"): (330.0, "NP", 30, 30.0, 7),
        (2, "EA"): (90.0, "NP", 30, 30.0, 7),
        (3, "EB"): (60.0, "3781", 30, 30.0, 7),
    }


def test_clipping(spark):
    rows = example()
    spans = [("2024-04-10", "2024-04-12"), ("2024-03-01", "2024-04-01"), ("2024-04-30", "2024-05-02"),
             ("2024-03-01", "2024-03-31"), ("2024-05-01", "2024-05-02"), ("2024-01-01", "9999-12-31")]
    rows["history"] = [employee(i, 1, "E", *span) for i, span in enumerate(spans)]
    got = {r.payee: (r.days, str(r.date_start), str(r.date_end)) for r in payout(spark, rows)}
    assert got == {
        0: (3, "2024-04-10", "2024-04-12"), 1: (1, "2024-04-01", "2024-04-01"),
        2: (1, "2024-04-30", "2024-04-30"), 5: (30, "2024-04-01", "2024-04-30"),
    }


def test_equal_clips_double_the_absence_but_not_the_pay(spark):
    rows = example()
    rows["history"] = [
        employee(1, 1, "E1", "2024-01-01", "2024-12-31"), employee(1, 1, "E2", "2023-01-01"),
        employee(1, 1, "E2", "2023-01-01"),  # a copy but for the role text
    ]
    rows["absences"] = [(1, day("2024-04-30"), 3), (1, day("2024-04-01"), None), (1, day("2024-05-01"), 9)]
    (row,) = payout(spark, rows)
    assert (row.pay, row.absence_days, row.absence_pay, row.final_pay) == (90.0, 6.0, 18.0, 72.0)


def test_a_missing_area_and_the_default_area_are_one(spark):
    rows = example()
    rows["history"] = [employee(1, 1, "E", area=None), employee(1, 1, "E", area="NP")]
    rows["absences"] = [(1, day("2024-04-02"), 1)]
    (row,) = payout(spark, rows)
    assert (row.area, row.absence_days) == ("NP", 2.0)


def test_final_pay_may_be_negative(spark):
    rows = example()
    rows["history"] = [employee(1, 1, "E", "2024-04-30")]
    rows["absences"] = [(1, day("2024-04-30"), 5)]
    (row,) = payout(spark, rows)
    assert (row.pay, row.final_pay) == (3.0, -12.0)


def test_no_inflation_and_no_pairs_give_an_empty_result(spark):
    rows = example()
    rows["history"] = [employee(1, 1, "E")]
    assert len(payout(spark, rows)) == 1
    assert payout(spark, rows, "2025-04-15") == []
    rows["pairs"] = []
    assert payout(spark, rows) == []


@pytest.mark.parametrize("zero_as_missing, band, pay", [(True, 1, 350.0), (False, None, 0.0)])
def test_prior_sales_of_zero(spark, zero_as_missing, band, pay):
    rows = example()
    rows["sales"][1] = (2, day("2023-04-30"), Decimal(0), 1)
    rows["tariff"].append((1, 2, 1, Decimal(300), Decimal(100), Decimal(50)))
    rows["history"] = [employee(7, 1, "L1")]
    (row,) = payout(spark, rows, zero_as_missing=zero_as_missing)
    assert (row.band, row.pay) == (band, pay)


def test_two_valid_inflations_are_an_error(spark):
    rows = example()
    rows["inflation"] *= 2
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        payout(spark, rows)


def test_several_sales_rows_multiply_the_pair(spark):
    rows = example()
    rows["history"] = [employee(1, 1, "E")]
    rows["sales"] += [(2, day("2024-04-20"), Decimal(150), 1), (2, day("2024-04-20"), Decimal(80), 1)]
    got = payout(spark, rows)
    assert sorted((float(r.sales), r.band) for r in got) == [(80.0, 1), (150.0, 7)]


def test_a_period_of_two_months_divides_by_the_first(spark):
    rows = example()
    rows["pairs"] = [(1, 2, day("2024-04-01"), day("2024-05-31"), "W", 1, 1)]
    rows["history"] = [employee(1, 1, "E"), employee(2, 1, "E")]
    rows["absences"] = [(1, day("2024-05-20"), 2), (1, day("2024-04-20"), 1)]
    got = {r.payee: (r.days, r.pay, r.absence_days) for r in payout(spark, rows)}
    assert got == {1: (61, 61 / 30 * 90.0, 3.0), 2: (61, 61 / 30 * 90.0, 0.0)}


@pytest.fixture(params=["small", "large"])
def join_settings(request, spark):
    """`large`: as with inputs too large to broadcast, and every larger partition split."""
    settings = {} if request.param == "small" else {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_an_interval_that_ends_before_it_starts(spark):
    rows = example()
    rows["pairs"] = [(1, 2, day("2024-04-01"), day("2024-05-31"), "W", 1, 1)]
    rows["history"] = [employee(1, 1, "E", "2024-05-20", "2024-04-10")]
    rows["absences"] = [(1, day("2024-05-01"), 2)]
    (row,) = payout(spark, rows)
    assert (row.days, row.absence_days) == (41, 0.0)


def brute_force(rows, rate):
    """The payout as nested loops over the rows, in the order of the business rules."""
    def month(d, back=0):
        index = d.year * 12 + d.month - 1 - back
        return index

    def code(store, begda):
        letters = [f for s, b, f in rows["focus"] if s == store and month(b) == month(begda, 1)]
        return [{"E": 1, "I": 2, "C": 3, "D": 4}.get(x, 0) for x in letters] or [0]

    def band(g):
        if g <= 0:
            return 1
        lows = [Decimal(0)] + [rate + Decimal("0.01") * i for i in range(6)]
        highs = [rate - Decimal("0.0001")] + [low + Decimal("0.0099") for low in lows[1:6]] + [Decimal(2000)]
        hits = [i + 1 for i, (lo, hi) in enumerate(zip(lows, highs)) if float(lo) <= g <= float(hi)]
        return hits[0] if hits else None

    rates = {(c, f, b): (float(x), float(y), float(z)) for c, f, b, x, y, z in rows["tariff"]}
    stage = set()
    for a, b, begda, endda, wage, case, ids in rows["pairs"]:
        if ids != 1:
            continue
        now = [s[2] for s in rows["sales"] if s[0] == b and s[3] == 1 and month(s[1]) == month(begda)]
        old = [s[2] for s in rows["sales"] if s[0] == b and s[3] == 1 and month(s[1]) == month(begda, 12)]
        for s in now or [None]:
            for v in old or [None]:
                g = (float(s) / float(v) if s is not None and v else 0.0) - 1
                for fa in code(a, begda):
                    for fb in code(b, begda):
                        rb = rates.get((case, fb, band(g)), (0.0, 0.0, 0.0))
                        ra = rates.get((case, fa, band(g)), (0.0, 0.0, 0.0))
                        stage.add((a, b, begda, endda, wage, s or 0, v or 0, g, case, band(g), fa, fb,
                                   rb[1], rb[0], rb[2], ra[1]))
    total = defaultdict(lambda: [0.0, 0.0])
    for tag, prefix, side, fallback in (("L", "L", 0, "NP"), ("EA", "E", 0, "NP"), ("EB", "E", 1, "3781")):
        people = {(h[0], h[1], h[4], h[5], h[6]) for h in rows["history"] if h[2].startswith(prefix) and h[3] == 1}
        for t in stage:
            for payee, store, start, end, area in people:
                if store != t[side] or start > t[3] or end < t[2]:
                    continue
                first, last = max(start, t[2]), min(end, t[3])
                days = (last - first).days + 1
                following = dt.date(t[2].year + t[2].month // 12, t[2].month % 12 + 1, 1)
                length = float((following - t[2].replace(day=1)).days)
                per = {"L": t[13] + t[14], "EA": t[15], "EB": t[12]}[tag]
                key = t + (payee, tag, days, first, last, area if area is not None else fallback)
                absent = sum(d or 0 for p, s, d in rows["absences"] if p == payee and first <= s <= last)
                total[key][0] += absent
                total[key][1] = days / length * per, length, per
    return {
        key: (round(pay[0], 6), absent, round(pay[0] - absent / pay[1] * pay[2], 6))
        for key, (absent, pay) in total.items()
    }


def test_payout_equals_brute_force(spark, join_settings):
    """Random rows with many copies; most of the history and absences belong to one store and
    employee."""
    rng = random.Random(11)
    months = [dt.date(2024, m, 1) for m in range(1, 5)]
    ends = {m: (m.replace(month=m.month + 1) - dt.timedelta(days=1)) for m in months}

    def some_day():
        return dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(-40, 150))

    rows = example()
    rows["pairs"] = [
        (rng.randrange(4), rng.randrange(4), m, ends[m], "W", rng.randint(1, 2), rng.choice([0, 1, 1]))
        for m in months for _ in range(12)
    ]
    rows["pairs"] += rows["pairs"][:4]
    rows["sales"] = [
        (s, m.replace(year=y, day=rng.randint(1, 28)), Decimal(rng.choice([0, 90, 95, 100, 105])), rng.choice([0, 1, 1]))
        for s in range(4) for m in months for y in (2023, 2024) for _ in range(rng.randrange(3))
    ]
    rows["focus"] = [(s, m, rng.choice("EICDX")) for s in range(3) for m in [dt.date(2023, 12, 1), *months]]
    rows["tariff"] = [
        (c, f, b, Decimal(100 * b + f), Decimal(70 * b + c), Decimal(10 * f))
        for c in (1, 2) for f in range(5) for b in range(1, 7)
    ]
    rows["history"] = []
    for _ in range(60):
        start = some_day()
        rows["history"].append((
            rng.choice([1, 1, 1, 2, 3, 4]), rng.choice([0, 0, 0, 1, 2, 3]), rng.choice(["L1", "L2", "E1", "X"]),
            rng.choice([0, 1, 1, 1]), start, start + dt.timedelta(days=rng.randrange(90)),
            rng.choice([None, "NP", "5"])))
    rows["history"] += rows["history"][:20]
    rows["absences"] = [(rng.choice([1, 1, 1, 2, 9]), some_day(), rng.choice([None, 1, 2, 3])) for _ in range(80)]
    expected = brute_force(rows, Decimal("0.0450"))
    got = {}
    for r in payout(spark, rows):
        key = (r.store_a, r.store_b, r.begda, r.endda, r.wage_type, r.sales, r.prior_sales, r.growth, r.case_id,
               r.band, r.focus_a, r.focus_b, float(r.pay_manager_b), float(r.pay_leader_sales_b),
               float(r.pay_leader_focus_b), float(r.pay_manager_a), r.payee, r.role, r.days, r.date_start,
               r.date_end, r.area)
        assert key not in got
        got[key] = (round(r.pay, 6), r.absence_days, round(r.final_pay, 6))
    assert len(expected) > 100
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-5)
