import datetime as dt
import random

from kabuto.operators.range_max import block_maxima, range_highs
from tests.conftest import D, rows

VALUES = "base_date date, ticker string, price double"


def _brute(values, periods):
    out = []
    for k, a, b in periods:
        held = [(v, d) for d, t, v in values if t == k and k is not None and d is not None and a is not None and b is not None and a <= d <= b]
        best = max(held, key=lambda x: (x[0] is not None, x[0] or 0, -x[1].toordinal()), default=(None, None))
        out.append((k, a, b, *best))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def test_any_period_against_brute_force(spark):
    rng = random.Random(8)
    day = lambda n: D("2019-11-20") + dt.timedelta(days=n)
    values = [(day(rng.randrange(1600)), rng.choice("AB"), rng.choice([None, 1.0, 2.5, 9.0, float(rng.randrange(100))])) for _ in range(500)]
    values += [(day(n), "N", None) for n in (5, 40, 400)] + [(None, "A", 1e9), (day(3), None, 5.0)]
    periods = [(rng.choice(["A", "B", "N", "none"]), day(a), day(a + rng.choice([0, 1, 20, 31, 90, 365, 900]))) for a in (rng.randrange(-100, 1600) for _ in range(150))]
    periods += [("A", D("2020-02-01"), D("2020-02-29")), ("A", D("2020-01-01"), D("2023-12-31")), ("B", D("2020-01-31"), D("2020-02-01")), ("A", day(9), day(2)), ("A", None, day(5)), (None, day(1), day(9))]
    v = spark.createDataFrame(values, VALUES)
    p = spark.createDataFrame(periods, "ticker string, start date, end date")
    assert rows(range_highs(p, v, block_maxima(v, months=64))) == _brute(values, periods)


def test_a_long_period_reads_two_blocks_and_two_months(spark):
    values = [(D("2010-01-01") + dt.timedelta(days=n), "A", float(n % 977)) for n in range(0, 5000, 3)]
    v = spark.createDataFrame(values, VALUES)
    blocks = block_maxima(v, months=256)
    assert blocks.count() < 9 * 2 * 256
    p = spark.createDataFrame([("A", D("2010-03-15"), D("2023-02-11"))], "ticker string, start date, end date")
    inside = [x for x in values if D("2010-04-01") <= x[0] <= D("2023-01-31")]
    few = v.filter("base_date < DATE'2010-04-01' OR base_date > DATE'2023-01-31'")  # the days of the cut months only
    assert rows(range_highs(p, few, blocks)) == _brute(values, [("A", D("2010-03-15"), D("2023-02-11"))])
    assert len(inside) > 1500
    empty = v.limit(0)
    assert rows(range_highs(p, empty, block_maxima(empty))) == [("A", D("2010-03-15"), D("2023-02-11"), None, None)]


def test_few_aggregates_for_all_levels(spark):
    plan = block_maxima(spark.createDataFrame([(D("2020-01-01"), "A", 1.0)], VALUES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 8  # each level used to hold the plans of all below it again: 45
    v = spark.createDataFrame([(D("2020-01-01"), "A", 1.0), (D("2020-04-01"), "A", 7.0)], VALUES)
    start, level = 2020 * 12, {}
    for r in block_maxima(v, months=70).collect():
        level.setdefault(r["_level"], {})[r["_m"] - start] = r["_best"]["v"]
    for k in range(7):
        assert level[k] == {m: 7.0 if m + (1 << k) > 3 else 1.0 for m in range(-70, 4) if m <= 0 < m + (1 << k) or m <= 3 < m + (1 << k)}
