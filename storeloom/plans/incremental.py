"""Gold that follows batches of changed purchases instead of being rebuilt.

The store holds the purchases by month and three aggregate states, per client,
per day and client and per product and client, from which the gold tables are
short aggregations. A batch is compared with the stored rows of its ids; what
differs becomes deltas, the new row with sign +1 and the old one with -1, so a
correction or a deletion retracts what it replaces and a row that comes again
changes nothing. Only the months and buckets that a delta touches are written
anew, and all of them are published together with the batch's id.

Sums are folded from deltas. A minimum or maximum is folded too, and computed
again from the purchases only for the keys that lost their smallest or largest
value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from storeloom.functions.calendar import year_month
from storeloom.functions.numeric import cents, cents_to_money, from_cents, ratio
from storeloom.operators.quality import dedup_by_key
from storeloom.operators.silver import PURCHASE_ORDER
from storeloom.plans.parallel import run_together
from storeloom.schemas import PURCHASE_COLUMNS, SILVER
from storeloom.session import through_table
from storeloom.sources.published import Run, Store

#: Partitions of the states that have no date; a batch rewrites those that it touches.
BUCKETS = 16

_REPORT = ("batch_id string, received bigint, added bigint, corrected bigint, deleted bigint, repeated bigint, "
           "late bigint, high_water date")


@dataclass(frozen=True)
class State:
    """An aggregate by ``keys``: sums, and extremes as {low: value} and {high: value}."""

    name: str
    keys: Sequence[str]
    part: Callable[[], Column]
    sums: Sequence[str]
    lows: dict[str, str]
    highs: dict[str, str]
    ddl: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _bucket(*keys: str) -> Callable[[], Column]:
    return lambda: F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("string")


def _month() -> Column:
    return year_month(F.col("purchase_date"))


def _summed(name: str) -> Column:
    """What a row adds to a sum of a state."""
    return {"orders": lambda: F.lit(1).cast("bigint"), "quantity": lambda: F.col("quantity").cast("bigint"),
            "revenue": lambda: cents("total"), "prices": lambda: cents("price")}[name]()


STATES = (
    State("client_state", ["id_client"], _bucket("id_client"), ["orders", "quantity", "revenue"],
          {"min_total": "total", "first_date": "purchase_date"}, {"max_total": "total", "last_date": "purchase_date"},
          "id_client bigint, orders bigint, quantity bigint, revenue bigint, min_total decimal(18,2), "
          "first_date date, max_total decimal(18,2), last_date date"),
    State("day_client_state", ["purchase_date", "id_client"], _month,
          ["orders", "quantity", "revenue"], {}, {},
          "purchase_date date, id_client bigint, orders bigint, quantity bigint, revenue bigint"),
    State("product_client_state", ["product", "id_client"], _bucket("product", "id_client"),
          ["orders", "quantity", "revenue", "prices"], {"min_price": "price"}, {"max_price": "price"},
          "product string, id_client bigint, orders bigint, quantity bigint, revenue bigint, prices bigint, "
          "min_price decimal(18,2), max_price decimal(18,2)"),
)


def _values(df: DataFrame, column: str) -> list:
    """The distinct values of a column that names partitions: months or buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _deltas(run: Run, changes: DataFrame) -> DataFrame:
    """Rows to add with ``sign`` 1, rows to take back with -1, repeated ones with 0, deletions of unknown ids with null.

    Only ids and months of the stored purchases are read to find the months in
    question; whole rows are read of those months alone. Of the changes of an id
    the first counts; they are ranked where the join with the stored rows has
    brought them, so the batch is shuffled once and not written before.
    """
    schema = SILVER["purchases"]
    ids = changes.select("id_purchase")
    months = _values(run.read("purchases", schema).select("id_purchase", "part").join(ids, "id_purchase", "left_semi"),
                     "part")
    incoming = dedup_by_key(changes, "id_purchase", [*PURCHASE_ORDER, "deleted"])
    old = run.read("purchases", schema, months).select(F.col("id_purchase").alias("id"),
                                                       F.struct(*PURCHASE_COLUMNS).alias("old"))
    both = incoming.join(old, incoming["id_purchase"] == old["id"], "left").select(
        F.struct(*PURCHASE_COLUMNS).alias("new"), "deleted", "old")
    same = ~F.col("deleted") & F.col("old").eqNullSafe(F.col("new"))
    signed = F.when(same, F.array(F.struct(F.lit(0).alias("sign"), F.col("new").alias("row")))).otherwise(
        F.filter(F.array(
            F.struct(F.when(F.col("deleted"), None).otherwise(1).alias("sign"), F.col("new").alias("row")),
            F.struct(F.when(F.col("old").isNotNull(), -1).alias("sign"), F.col("old").alias("row"))),
            lambda x: x["sign"].isNotNull()))
    return both.select(F.col("old").isNotNull().alias("known"), F.explode_outer(signed).alias("x")).select(
        "known", "x.sign", "x.row.*")


def _folded(state: State, old: DataFrame, deltas: DataFrame) -> DataFrame:
    """Old state and deltas as one; ``again`` marks keys whose extremes must be computed again."""
    sign = F.col("sign")
    added = [F.sum(sign * _summed(s)).alias(f"d_{s}") for s in state.sums]
    ends = {**{k: (F.min, v) for k, v in state.lows.items()}, **{k: (F.max, v) for k, v in state.highs.items()}}
    news = [f(F.when(sign > 0, F.col(v))).alias(f"n_{k}") for k, (f, v) in ends.items()]
    gone = [f(F.when(sign < 0, F.col(v))).alias(f"g_{k}") for k, (f, v) in ends.items()]
    delta = deltas.groupBy(*state.keys).agg(*added, *news, *gone)
    # Both sides hold the touched keys; null keys are keys.
    o, d = old.alias("o"), delta.alias("d")
    same = F.lit(True)
    for k in state.keys:
        same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"d.{k}"))
    joined = o.join(d, same, "full")
    zero = F.lit(0).cast("bigint")
    lost = F.lit(False)
    for k in state.lows:
        lost = lost | F.coalesce(F.col(f"g_{k}") <= F.col(f"o.{k}"), F.lit(False))
    for k in state.highs:
        lost = lost | F.coalesce(F.col(f"g_{k}") >= F.col(f"o.{k}"), F.lit(False))
    present = F.col("o.orders").isNotNull()
    return joined.select(
        *[F.when(present, F.col(f"o.{k}")).otherwise(F.col(f"d.{k}")).alias(k) for k in state.keys],
        *[(F.coalesce(F.col(f"o.{s}"), zero) + F.coalesce(f"d_{s}", zero)).alias(s) for s in state.sums],
        *[F.least(f"o.{k}", f"n_{k}").alias(k) for k in state.lows],
        *[F.greatest(f"o.{k}", f"n_{k}").alias(k) for k in state.highs],
        lost.alias("again")).filter("orders <> 0")


def _extremes(state: State, keys: DataFrame, purchases: DataFrame) -> DataFrame:
    ends = ([F.min(v).alias(f"r_{k}") for k, v in state.lows.items()]
            + [F.max(v).alias(f"r_{k}") for k, v in state.highs.items()])
    k, p = keys.alias("k"), purchases.alias("p")
    same = F.lit(True)
    for c in state.keys:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"k.{c}"))
    return p.join(k, same, "left_semi").groupBy(*[F.col(c).alias(f"r_{c}") for c in state.keys]).agg(*ends)


def _update(run: Run, state: State, deltas: DataFrame) -> None:
    touched = _values(deltas.select(state.part().alias("part")), "part")
    old = run.read(state.name, state.schema, touched).drop("part")
    new = _folded(state, old, deltas)
    names = state.schema.names
    if state.lows:
        new = through_table(new, state.name)
        again = new.filter("again")
        if not again.isEmpty():
            # Only the keys in question take part in the joins, not the whole state.
            found = _extremes(state, again.select(*state.keys), run.read("purchases", SILVER["purchases"]))
            same = F.lit(True)
            for c in state.keys:
                same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
            again = again.join(found, same, "left").withColumns(
                {k: F.col(f"r_{k}") for k in [*state.lows, *state.highs]})
            new = new.filter("NOT again").select(*names).unionByName(again.select(*names))
    run.replace(state.name, new.select(*names, state.part().alias("part")), touched)


def apply_batch(store: Store, batch_id: str, changes: DataFrame) -> DataFrame:
    """Take a batch of purchases into the store, and return its report of one row.

    ``changes`` has the columns of purchases: new rows, later versions of stored
    rows, rows that came before, in any order; an optional boolean ``deleted``
    takes the row of that id back. Of several rows of an id the first in the
    order of silver counts. Rows without an id or a date are left out.
    A batch whose id has been applied changes nothing and gives its first
    report, and so does one that failed before and is given again.

    Report: ``received`` ids, of which ``added``, ``corrected``, ``deleted`` and
    ``repeated``; ``late``, how many rows were added or corrected before the
    high-water mark of the batches before; and ``high_water``, the last
    purchase date that any batch has had.
    """
    spark = store.spark
    schema = StructType.fromDDL(_REPORT)
    if batch_id in store.parts("batches"):
        return store.read("batches", schema, [batch_id]).drop("part")
    if "deleted" not in changes.columns:
        changes = changes.withColumn("deleted", F.lit(False))
    changes = changes.withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    kept = changes.filter("id_purchase IS NOT NULL AND purchase_date IS NOT NULL").select(
        *[F.col(f.name).cast(f.dataType) for f in SILVER["purchases"].fields], "deleted")
    run = store.start()
    all_rows = through_table(_deltas(run, kept), "deltas")
    deltas = all_rows.filter("sign <> 0").drop("known")

    before = F.lit(store.read("batches", schema).agg(F.max("high_water")).first()[0]).cast("date")
    plus, minus = F.col("sign") == 1, F.col("sign") == -1
    counts = all_rows.agg(
        # A correction is two rows, any other id is one.
        (F.count(F.lit(1)) - F.count_if(plus & F.col("known"))).alias("received"),
        F.count_if(plus & ~F.col("known")).alias("added"), F.count_if(plus & F.col("known")).alias("corrected"),
        (F.count_if(minus) - F.count_if(plus & F.col("known"))).alias("deleted"),
        F.count_if(F.col("sign") == 0).alias("repeated"),
        F.count_if(plus & F.coalesce(F.col("purchase_date") < before, F.lit(False))).alias("late"),
        F.max(F.when(F.col("sign") >= 0, F.col("purchase_date"))).alias("last"))
    report = counts.select(F.lit(batch_id).alias("batch_id"), "received", "added", "corrected", "deleted", "repeated",
                           "late", F.greatest("last", before).alias("high_water"))

    months = _values(deltas.select(_month().alias("part")), "part")
    held = run.read("purchases", SILVER["purchases"], months)
    changed = deltas.filter("sign = -1").select("id_purchase")
    fresh = deltas.filter("sign = 1").select(*PURCHASE_COLUMNS, _month().alias("part"))
    run.replace("purchases", held.join(changed, "id_purchase", "left_anti").select(*PURCHASE_COLUMNS, "part")
                .unionByName(fresh), months)
    run_together(spark, [lambda s=s: _update(run, s, deltas) for s in STATES])
    run.replace("batches", report.withColumn("part", F.col("batch_id")), [batch_id])
    run.publish()
    return store.read("batches", schema, [batch_id]).drop("part")


def batch_reports(store: Store) -> DataFrame:
    return store.read("batches", StructType.fromDDL(_REPORT)).drop("part")


def read_purchases(store: Store, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored purchases, of the months from ``first`` to ``last`` (``yyyy-MM``) if given.

    The months are folders, so others are not read.
    """
    rows = store.read("purchases", SILVER["purchases"])
    for month, keep in ((first, F.col("part") >= F.lit(first)), (last, F.col("part") <= F.lit(last))):
        rows = rows.filter(keep) if month else rows
    return rows.select(*PURCHASE_COLUMNS)


def _state(store: Store, name: str) -> DataFrame:
    state = next(s for s in STATES if s.name == name)
    return store.read(name, state.schema).drop("part")


def client_totals(store: Store) -> DataFrame:
    """Per client what :func:`storeloom.operators.kpis.purchase_aggregates` has, from the state."""
    return _state(store, "client_state").select(
        "id_client", F.col("orders").alias("total_purchases"), cents_to_money(F.col("revenue")).alias("total_spent"),
        F.col("min_total").alias("min_order_value"), F.col("max_total").alias("max_order_value"),
        F.col("quantity").alias("total_quantity"), F.col("first_date").alias("first_purchase_date"),
        F.col("last_date").alias("last_purchase_date"))


def daily_totals(store: Store) -> DataFrame:
    """As :func:`storeloom.operators.temporal.daily_totals`; a (day, client) is one row, so clients are a plain count."""
    return _state(store, "day_client_state").groupBy(F.col("purchase_date").alias("date")).agg(
        from_cents(F.sum("revenue")).alias("total_revenue"), F.sum("orders").alias("total_orders"),
        F.count("id_client").alias("unique_customers"), F.sum("quantity").alias("total_quantity"))


def product_country_totals(store: Store, clients: DataFrame) -> DataFrame:
    """Per product and country, from the state per product and client.

    Countries are joined at that grain when the table is read, so a client that
    moves needs no retraction.
    """
    held = _state(store, "product_client_state").join(clients.select("id_client", "country"), "id_client", "left")
    return held.groupBy("product", "country").agg(
        F.sum("orders").alias("total_orders"), F.sum("quantity").alias("total_quantity"),
        from_cents(F.sum("revenue")).alias("total_revenue"), F.count("id_client").alias("unique_customers"),
        ratio(from_cents(F.sum("prices")), F.sum("orders")).alias("avg_price"),
        F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"))


def rebuild(spark: SparkSession, root: str, purchases: DataFrame) -> Store:
    """A new store from whole purchases, as one batch."""
    store = Store(spark, root)
    apply_batch(store, "rebuild", purchases)
    return store
