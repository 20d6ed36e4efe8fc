from __future__ import annotations

import datetime as dt

import pytest

from eventloom.operators.staging import flatten_events, flatten_items
from eventloom.session import local_session
from eventloom.sources.schema import RAW_EVENT

DAY = dt.datetime(2024, 3, 4, tzinfo=dt.timezone.utc)  # a Monday


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, shuffle_partitions=4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


def micros(seconds: float) -> int:
    return int(DAY.timestamp()) * 1_000_000 + round(seconds * 1_000_000)


def event(
    name,
    seconds=0.0,
    user="a",
    session=1,
    date=None,
    transaction=None,
    revenue=None,
    units=None,
    items=(),
    device=None,
    params=None,
    **top,
):
    """One raw nested event as a dict; the date follows the time unless given."""
    row = {f.name: None for f in RAW_EVENT.fields}
    moment = DAY + dt.timedelta(seconds=seconds)
    row.update(
        event_date=date or moment.strftime("%Y%m%d"),
        event_timestamp=micros(seconds),
        event_name=name,
        user_pseudo_id=user,
        platform="WEB",
        device={"category": device, "operating_system": None, "language": None, "web_info": {"browser": None}},
        geo={"country": None, "region": None, "city": None},
        traffic_source={"source": None, "medium": None, "name": None},
        ecommerce={
            "transaction_id": transaction,
            "purchase_revenue_in_usd": revenue,
            "total_item_quantity": units,
        },
        event_params=list(params or [])
        + ([{"key": "ga_session_id", "value": {"string_value": None, "int_value": session}}] if session is not None else []),
        items=[{**{f: None for f in RAW_EVENT["items"].dataType.elementType.names}, **i} for i in items],
    )
    row.update(top)
    return row


@pytest.fixture(scope="session")
def raw_of(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW_EVENT)


@pytest.fixture(scope="session")
def events_of(raw_of):
    return lambda *rows: flatten_events(raw_of(*rows))


@pytest.fixture(scope="session")
def items_of(raw_of):
    return lambda *rows: flatten_items(raw_of(*rows))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def only(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
