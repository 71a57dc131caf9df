"""Hot keys: results are unchanged when AQE splits skewed join partitions.

One e-mail holds a third of the registrations and one user a third of the
orders and items. The layers are computed twice -- with the session's
defaults and with broadcasts off and skew thresholds lowered so that the
hot partitions are actually split -- and must agree row for row.
"""

from __future__ import annotations

import datetime as dt

import pytest

from revlens.config import FIXTURE_AS_OF
from revlens.plans.warehouse import Warehouse
from revlens.sources.raw import RawTables

T = dt.datetime
N_USERS, N_ORDERS = 300, 900

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _raw(spark) -> RawTables:
    users = []
    for i in range(1, N_USERS + 1):
        email = "hot@x.com" if i % 3 == 0 else f"u{i}@x.com"
        if i % 50 == 1:
            email = None
        users.append(
            (i, "ana", "silva", email, 30, "F", "brasil", "rio", "Search", T(2000, 1, 1) + dt.timedelta(days=i))
        )
    orders, items = [], []
    statuses = ["Complete", "Shipped", "Processing", "Cancelled", "Returned"]
    for o in range(1, N_ORDERS + 1):
        uid = 3 if o % 3 == 0 else (o % N_USERS) + 1  # user 3 places a third of the orders
        st = statuses[o % 5]
        created = T(2001, 1, 1, 13) + dt.timedelta(days=o % 200)
        orders.append((o, uid, st, created, created + dt.timedelta(hours=30), None, 2))
        for line in (1, 2):
            items.append((o * 10 + line, o, uid, 7 if line == 1 else o % 40, 10.0 + o % 7, st, created))
    products = [(p, 4.0 + p % 3, f"cat{p % 4}", None if p % 9 == 0 else "acme") for p in range(40)]
    return RawTables(
        users=spark.createDataFrame(
            users,
            "id long, first_name string, last_name string, email string, age long, gender string, "
            "country string, city string, traffic_source string, created_at timestamp_ntz",
        ),
        orders=spark.createDataFrame(
            orders,
            "order_id long, user_id long, status string, created_at timestamp_ntz, "
            "shipped_at timestamp_ntz, delivered_at timestamp_ntz, num_of_item long",
        ),
        order_items=spark.createDataFrame(
            items,
            "id long, order_id long, user_id long, product_id long, sale_price double, status string, "
            "created_at timestamp_ntz",
        ),
        products=spark.createDataFrame(products, "id long, cost double, category string, brand string"),
    )


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def skew_conf(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    yield
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_results_unchanged_when_hot_partitions_split(spark, skew_conf):
    raw = _raw(spark)
    layers = ("stg_users", "stg_user_id_mapping", "customer_metrics", "vw_sales_analysis")
    base = {name: _rows(getattr(Warehouse(raw, FIXTURE_AS_OF), name)) for name in layers}

    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    w = Warehouse(raw, FIXTURE_AS_OF)
    plans = []
    for name in layers:
        df = getattr(w, name)
        assert _rows(df) == base[name], name
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    # the hot e-mail / hot user partitions were really split somewhere
    assert any("skew=true" in p for p in plans)
    # one survivor per e-mail (NULL e-mails keep one), everyone else mapped
    assert len(base["stg_users"]) + len(base["stg_user_id_mapping"]) == N_USERS - 6 + 1
