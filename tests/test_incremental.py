"""Batches against full rebuilds, and what a failed or repeated batch leaves behind."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from storeloom.operators import kpis, temporal
from storeloom.plans import incremental
from storeloom.plans.incremental import apply_batch
from storeloom.schemas import PURCHASE_COLUMNS, SILVER
from storeloom.session import scratch_path
from storeloom.sources import published
from storeloom.sources.published import Store


def _frame(spark, rows):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER["purchases"].fields)
    return spark.createDataFrame(rows, fields + ", deleted boolean")


def _row(key, client=1, product="p", price="2.50", quantity=2, day=date(2024, 1, 5), deleted=False):
    total = None if price is None else Decimal(price) * quantity
    return (key, client, product, None if price is None else Decimal(price), quantity, day, total, deleted)


def _expected(spark, rows):
    p = _frame(spark, rows).select(*PURCHASE_COLUMNS)
    clients = kpis.purchase_aggregates(p).drop("spent_cents")
    return (sorted(map(tuple, clients.collect()), key=str),
            sorted(map(tuple, temporal.daily_totals(p).collect()), key=str))


def _found(store):
    clients = incremental.client_totals(store).drop("total_spent")
    columns = ["date", "total_revenue", "total_orders", "unique_customers", "total_quantity"]
    return (sorted(map(tuple, clients.collect()), key=str),
            sorted(map(tuple, incremental.daily_totals(store).select(columns).collect()), key=str))


@pytest.fixture
def store(spark):
    return Store(spark, scratch_path(spark, "store"))


def test_a_batch_is_not_written_before_its_join(spark, store, monkeypatch):
    names, through = [], incremental.through_table
    monkeypatch.setattr(incremental, "through_table", lambda df, name: names.append(name) or through(df, name))
    monkeypatch.setattr(incremental, "_extremes", lambda *_: pytest.fail("no key has lost its extremes"))
    # Twice the same id, and an unknown one that is taken back.
    rows = [_row(1), _row(1, quantity=5), _row(2), _row(3, deleted=True)]
    report = apply_batch(store, "b", _frame(spark, rows)).first()
    assert (report.received, report.added, report.deleted, report.repeated) == (3, 2, 0, 0)
    assert "incoming" not in names
    assert _found(store) == _expected(spark, [rows[0], rows[2]])


def test_random_batches_equal_a_rebuild(spark, store):
    rng = random.Random(5)
    held = {}
    for n in range(3):
        batch = {}
        for _ in range(120):
            key = rng.randrange(200)
            # A third of the rows is one client's; null clients and products are groups too.
            client = rng.choice([7, 7, 7, rng.randrange(20), None, rng.randrange(20), 3, 4, 5])
            batch[key] = _row(key, client, rng.choice(["a", "b", None]), f"{rng.randrange(1, 999)}.{rng.randrange(10)}0",
                              rng.randrange(1, 4), date(2024, 1, 1) + timedelta(days=rng.randrange(120)),
                              rng.random() < 0.25)
        apply_batch(store, f"b{n}", _frame(spark, list(batch.values())))
        held |= batch
        held = {k: r for k, r in held.items() if not r[-1]}
    assert _found(store) == _expected(spark, list(held.values()))
    stored = incremental.read_purchases(store).collect()
    assert sorted(map(tuple, stored)) == sorted(r[:-1] for r in held.values())
    products = {(r["product"], r.min_price, r.max_price, r.unique_customers) for r in
                incremental.product_country_totals(store, spark.createDataFrame(
                    [(-1, "x")], "id_client bigint, country string")).collect()}
    want = set()
    for name in {r[2] for r in held.values()}:
        mine = [r for r in held.values() if r[2] == name]
        want.add((name, min(r[3] for r in mine), max(r[3] for r in mine), len({r[1] for r in mine} - {None})))
    assert products == want


def test_a_batch_twice_changes_nothing(spark, store):
    batch = _frame(spark, [_row(1), _row(2, 2), _row(3, day=date(2024, 2, 1))])
    first = apply_batch(store, "b1", batch).first()
    before, files = store._newest(), _found(store)
    assert apply_batch(store, "b1", batch).first() == first and store._newest() == before
    # The same rows under another id: all repeated, no partition but the report's is written.
    again = apply_batch(store, "b2", batch).first()
    assert (again.received, again.added, again.repeated, again.late) == (3, 0, 3, 0)
    now = store._newest()[1]
    assert {k: v for k, v in now.items() if k[0] != "batches"} == {
        k: v for k, v in before[1].items() if k[0] != "batches"} and _found(store) == files


def test_report(spark, store):
    apply_batch(store, "b1", _frame(spark, [_row(1), _row(2, day=date(2024, 3, 1)), _row(9)]))
    out = apply_batch(store, "b2", _frame(spark, [
        _row(1), _row(2, quantity=5, day=date(2024, 3, 1)), _row(3, day=date(2024, 2, 1)), _row(4, day=date(2024, 4, 1)),
        _row(9, deleted=True), _row(99, deleted=True), _row(None), _row(5, day=None)])).first()
    assert out.asDict() == {"batch_id": "b2", "received": 6, "added": 2, "corrected": 1, "deleted": 1, "repeated": 1,
                            "late": 1, "high_water": date(2024, 4, 1)}
    assert [r.batch_id for r in incremental.batch_reports(store).orderBy("batch_id").collect()] == ["b1", "b2"]


def test_extremes_after_a_correction(spark, store):
    apply_batch(store, "b1", _frame(spark, [
        _row(1, price="1.00", day=date(2023, 1, 1)), _row(2, price="5.00"), _row(3, price="9.00", day=date(2025, 1, 1)),
        _row(4, price=None)]))
    apply_batch(store, "b2", _frame(spark, [_row(1, 2), _row(3, price="4.00", day=date(2024, 6, 1))]))
    one = incremental.client_totals(store).filter("id_client = 1").first()
    assert (one.min_order_value, one.max_order_value) == (Decimal("8.00"), Decimal("10.00"))
    assert (one.first_purchase_date, one.last_purchase_date) == (date(2024, 1, 5), date(2024, 6, 1))


def test_untouched_months_keep_their_files(spark, store):
    apply_batch(store, "b1", _frame(spark, [_row(i, i, day=date(2024, 1 + i % 3, 1)) for i in range(9)]))
    before = store._newest()[1]
    apply_batch(store, "b2", _frame(spark, [_row(0, 0, quantity=9), _row(100, 3, day=date(2024, 1, 9))]))
    after = store._newest()[1]
    for table in ("purchases", "day_client_state"):
        changed = {part for (t, part), run in after.items() if t == table and before.get((t, part)) != run}
        assert changed == {"2024-01"}
    # A month that loses all rows is gone.
    apply_batch(store, "b3", _frame(spark, [_row(i, deleted=True) for i in range(9) if i % 3 == 1]))
    assert store.parts("purchases") == ["2024-01", "2024-03"]


def test_a_failed_batch_is_not_seen(spark, store, monkeypatch):
    apply_batch(store, "b1", _frame(spark, [_row(1)]))
    before = _found(store)
    with monkeypatch.context() as broken:
        broken.setattr(published.Run, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply_batch(store, "b2", _frame(spark, [_row(1, quantity=7), _row(2)]))
    assert _found(store) == before and store.version() == 1
    apply_batch(store, "b2", _frame(spark, [_row(1, quantity=7), _row(2)]))
    assert _found(store) == _expected(spark, [_row(1, quantity=7), _row(2)])


def test_only_one_writer(spark, store):
    first, second = store.start(), store.start()
    rows = spark.createDataFrame([(1, "a")], "x int, part string")
    for run in (first, second):
        run.replace("t", rows, ["a"])
    first.publish()
    with pytest.raises(RuntimeError):
        second.publish()


def test_names_of_partitions(spark, store):
    run = store.start()
    with pytest.raises(ValueError):
        run.replace("t", spark.createDataFrame([(1, "a/b")], "x int, part string"), ["a/b"])
    with pytest.raises(ValueError):
        run.replace("t", spark.createDataFrame([(1, "b")], "x int, part string"), ["a"])


def test_empty_batches(spark, store):
    empty = _frame(spark, [])
    assert incremental.read_purchases(store).count() == 0
    assert apply_batch(store, "b0", empty).first().received == 0 and _found(store) == ([], [])
    apply_batch(store, "b1", _frame(spark, [_row(1)]).drop("deleted"))
    assert apply_batch(store, "b2", empty).first().high_water == date(2024, 1, 5)
    assert incremental.read_purchases(store).count() == 1 and store.version() == 3


def test_months_are_pruned(spark, store):
    apply_batch(store, "b1", _frame(spark, [_row(i, day=date(2024, 1 + i, 1)) for i in range(6)]))
    some = incremental.read_purchases(store, "2024-02", "2024-03")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: []" in plan
    assert some.count() == 2
