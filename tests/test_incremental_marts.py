"""Marts by deltas against marts built anew."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.plans import gold
from tidemark.plans import incremental_marts as m

FACTS = (
    "order_id string, customer_unique_id string, order_date date, order_total decimal(38,2), items_value decimal(38,2), "
    "freight_value decimal(38,2), delivered_to_customer_at timestamp_ntz, is_late_delivery boolean, is_valid_for_revenue boolean"
)
LINES = (
    "order_id string, category string, units long, price decimal(38,2), freight decimal(38,2), total decimal(38,2), "
    "priced long, freighted long, totalled long, valid boolean, order_date date, persons array<string>"
)


def order(rnd, n, months):
    """An order in one of some months (or without a date) and its lines; some persons are shared, some unknown."""
    day = None if n % 17 == 0 else dt.date(2024, rnd.choice(months), rnd.randrange(1, 28))
    person = rnd.choice([None, f"p{rnd.randrange(25)}", f"q{n}"])
    valid, late = rnd.choice([True, True, False, None]), rnd.choice([True, False, None])
    lines = [
        (f"o{n}", c, rnd.randrange(1, 4), Decimal(rnd.randrange(-500, 9000)) / 100, Decimal(1), Decimal(rnd.randrange(9000)) / 100,
         rnd.randrange(2), 1, 1, bool(valid), day, [person] if person else [])
        for c in rnd.sample(["a", "b", "c", "unknown"], rnd.randrange(1, 4))
    ]
    total = sum(x[5] for x in lines)
    fact = (f"o{n}", person, day, total, total - 1, Decimal(1),
            dt.datetime(2024, 6, 1) if late is not None else None, late, valid)
    return fact, lines


def test_three_runs_equal_a_rebuild(lake, spark):
    rnd = random.Random(6)
    state = {}

    def run(run_id, numbers, months, **options):
        changed = {n: order(rnd, n, months) for n in numbers}
        state.update(changed)
        facts = spark.createDataFrame([f for f, _ in changed.values()], FACTS)
        lines = spark.createDataFrame([x for _, ls in changed.values() for x in ls], LINES)
        return m.update_marts(lake, facts, lines, run_id, **options)

    def check():
        facts = spark.createDataFrame([f for f, _ in state.values()], FACTS)
        want = gold.mart_daily_revenue(facts)
        got = m.daily_revenue(lake).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        sums, people = defaultdict(lambda: [0, 0, Decimal(0)]), defaultdict(set)
        for _, lines in state.values():
            for line in lines:
                if line[9]:
                    one = sums[line[1]]
                    one[0], one[1], one[2] = one[0] + line[2], one[1] + 1, one[2] + line[5]
                    people[line[1]] |= set(line[11])
        rows = {r.category: r for r in m.category_performance(lake).collect()}
        assert {c: [r.units_sold, r.orders, r.total_revenue, r.customers] for c, r in rows.items()} == {
            c: [*v, len(people[c])] for c, v in sums.items()}
        months = defaultdict(set)
        for f, _ in state.values():
            if f[8] and f[1]:
                months[f[2] and f[2].replace(day=1)].add(f[1])
        found = m.customers_by(lake, lambda d: F.trunc(d, "month"), "month").collect()
        assert {r.month: r.customers for r in found} == {k: len(v) for k, v in months.items()}

    run("r1", range(300), range(1, 9))
    check()
    # late orders and changed ones, all in one month before and after: few parts are opened
    march = [n for n, (f, _) in state.items() if f[2] and f[2].month == 3]
    opened = run("r2", [*march[:10], *range(300, 305)], [3])
    check()
    assert opened[m.DAYS] <= 2 and opened[m.DAY_PEOPLE] <= 2 and opened[m.FACTS] <= 3
    # orders move to other months, lose or change their person, become invalid
    run("r3", range(0, 60), range(1, 13))
    check()
    assert {r.customer_unique_id for r in lake.read("gold", m.FACTS).collect()} == {f[1] for f, _ in state.values()}
    numbers = [r.number for r in lake.read("gold", m.PEOPLE).collect()]
    assert sorted(numbers) == list(range(len(numbers)))


def test_nothing_changed(lake, spark):
    assert m.update_marts(lake, spark.createDataFrame([], FACTS), spark.createDataFrame([], LINES), "r1") == {}
    assert not lake.state("gold", m.DAYS).exists


def test_runs_read_no_more_silver_than_is_written_for_them(lake, spark):
    """The columns named for a run are enough for it."""
    from tidemark.plans import silver
    from tidemark.sources import testbed

    b = testbed.bronze(spark, "/root/testdata/sf0.001")
    names = ("stg_orders", "stg_order_items", "stg_order_payments", "stg_customers", "stg_products")
    tables = {t: silver.SILVER[t](b) for t in names}
    narrow = {t: tables[t].select(*m.SILVER_COLUMNS.get(t, tables[t].columns)) for t in names}
    m.update_marts_from_silver(lake, narrow, "r1", span="year")
    facts = gold.fct_orders(*(tables[t] for t in names[:4]))
    want = gold.mart_daily_revenue(facts)
    assert sorted(map(str, m.daily_revenue(lake).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    want = gold.mart_category_performance(tables["stg_order_items"], facts, gold.dim_products(tables["stg_products"]))
    got = m.category_performance(lake).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
