import os
import sys
import tempfile
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tributary.sources.fixtures import FLAT_EVENT_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]").appName("tributary-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tributary-test-ckpt-"))
    yield s


def us(y, mo, d, h=0, mi=0, s=0, micro=0) -> int:
    return int(datetime(y, mo, d, h, mi, s, micro, tzinfo=timezone.utc).timestamp() * 1_000_000)


def make_events(spark, rows):
    """Flat events from dicts (missing columns NULL)."""
    names = [c for c, _ in FLAT_EVENT_SCHEMA]
    schema = ", ".join(f"{c} {t}" for c, t in FLAT_EVENT_SCHEMA)
    data = []
    for r in rows:
        r = dict(r)
        if "event_date" not in r:
            r["event_date"] = datetime.fromtimestamp(r["event_timestamp"] / 1e6, tz=timezone.utc).strftime("%Y%m%d")
        r.setdefault("platform", "WEB")
        data.append(tuple(r.get(c) for c in names))
    return spark.createDataFrame(data, schema)


def session_event(user, sid, ts, source=None, medium=None, campaign=None, name="page_view", **kw):
    return dict(user_pseudo_id=user, session_id=sid, event_timestamp=ts, event_name=name, source=source,
                medium=medium, campaign=campaign, **kw)


def conversion_event(user, ts, name="purchase", usd=None, local=None, tid=None, sid=None, **kw):
    return dict(user_pseudo_id=user, session_id=sid, event_timestamp=ts, event_name=name,
                purchase_revenue_in_usd=usd, purchase_revenue=local, transaction_id=tid, **kw)
