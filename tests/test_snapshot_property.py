"""Type-2 history against a plain model over random sequences of loads."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmarts.operators import snapshots

SCHEMA = "customer_key bigint, customer_address string, phone_number string, account_balance decimal(12,2), market_segment string"
CHECK = ["account_balance", "market_segment", "customer_address"]

entity = st.tuples(
    st.sampled_from(["a", "b", None]),  # address (checked)
    st.sampled_from(["p", "q"]),  # phone (not checked)
    st.sampled_from([Decimal("1.00"), Decimal("2.00"), None]),  # balance (checked)
)
load = st.dictionaries(st.integers(0, 4), entity, max_size=5)


def model(loads):
    current, closed = {}, []
    for i, rows in enumerate(loads):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
        for k, (addr, phone, bal) in rows.items():
            old = current.get(k)
            if old is None:
                current[k] = (addr, phone, bal, t)
            elif (old[0], old[2]) != (addr, bal):
                closed.append((k, old[0], old[1], old[2], old[3], t))
                current[k] = (addr, phone, bal, t)
    versions = closed + [(k, a, p, b, f, None) for k, (a, p, b, f) in current.items()]
    return sorted(versions, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.dictionaries(st.integers(0, 4), entity, min_size=1, max_size=5), rest=st.lists(load, max_size=2))
def test_history_matches_model(spark, scratch, first, rest):
    loads = [first, *rest]
    path = scratch("snp-prop")
    for i, rows in enumerate(loads):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
        data = [(k, a, p, b, "S") for k, (a, p, b) in rows.items()]
        snapshots.snapshot_check(spark, spark.createDataFrame(data, SCHEMA), path, "customer_key", CHECK, t)
    got = sorted(
        (tuple(r) for r in snapshots.read_snapshot(spark, path)
         .select("customer_key", "customer_address", "phone_number", "account_balance", "valid_from", "valid_to")
         .collect()),
        key=repr,
    )
    assert got == model(loads)
