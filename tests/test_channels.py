"""19-way channel golden over the 24 fixture traffic rows, and the 8-way
stand-alone taxonomy."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tributary.functions.channels import CHANNELS, channel_grouping_8, channel_grouping_19
from tributary.oracle import channel8_sql, channel19_sql
from tributary.sources.fixtures import TRAFFIC_ROWS

EXPECTED_19 = [
    "Direct", "Paid Search Brand", "Paid Search Non-Brand", "Cross-network", "Paid Shopping", "Paid Video",
    "Paid Social", "Display", "Organic Shopping", "Organic Video", "Organic Social", "Organic Search", "Email",
    "SMS", "Affiliate", "Audio", "Mobile Push", "Referral", "Unknown", "Paid Search Non-Brand", "Direct",
    "Paid Video", "Unknown", "Organic Social", "Cross-network", "Cross-network",
]


def _traffic(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(TRAFFIC_ROWS)],
                                 "i int, source string, medium string, campaign string")


def test_lookup_rows_cover_all_19_channels(spark):
    df = _traffic(spark).select("i", channel_grouping_19(
        F.coalesce("medium", F.lit("(none)")), F.coalesce("source", F.lit("(direct)")),
        F.coalesce("campaign", F.lit(""))).alias("channel"))
    got = [r.channel for r in df.orderBy("i").collect()]
    assert got == EXPECTED_19
    assert set(got) == set(CHANNELS)


def test_oracle_case_agrees(spark):
    con = duckdb.connect()
    rows = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in TRAFFIC_ROWS)
    sql = (f"SELECT {channel19_sql('COALESCE(m, ' + chr(39) + '(none)' + chr(39) + ')', 'COALESCE(s, ' + chr(39) + '(direct)' + chr(39) + ')', 'COALESCE(c, ' + chr(39) + chr(39) + ')', 'your-brand-here|yourbrand')} "
           f"FROM (VALUES {rows}) t(s, m, c)")
    assert [r[0] for r in con.execute(sql).fetchall()] == EXPECTED_19


@pytest.mark.parametrize("medium,source,expected", [
    ("cpc", "google", "Paid Search"), ("organic", "google", "Organic Search"), ("paid_social", "fb", "Social"),
    ("email", "news", "Email"), ("banner", "x", "Display"), ("referral", "blog", "Referral"),
    ("affiliate", "p", "Affiliate"), (None, None, "Direct"), ("", "a", "Direct"), ("cpv", None, "(direct) / cpv"),
    ("CPC", "google", "google / CPC"),
])
def test_channel_8(spark, medium, source, expected):
    df = spark.createDataFrame([(medium, source)], "medium string, source string")
    assert df.select(channel_grouping_8("medium", "source")).first()[0] == expected
    m = "NULL" if medium is None else f"'{medium}'"
    s = "NULL" if source is None else f"'{source}'"
    got = duckdb.connect().execute(f"SELECT {channel8_sql('m', 's')} FROM (SELECT {m} AS m, {s} AS s)").fetchall()
    assert got[0][0] == expected


def test_brand_regex_tests_campaign_not_source(spark):
    df = spark.createDataFrame([("google", "cpc", "x"), ("yourbrand", "cpc", "generic")],
                               "source string, medium string, campaign string")
    got = [r[0] for r in df.select(channel_grouping_19("medium", "source", "campaign")).collect()]
    assert got == ["Paid Search Non-Brand", "Paid Search Non-Brand"]
    got = df.select(channel_grouping_19("medium", "source", "campaign", brand_regex="^x$")).first()[0]
    assert got == "Paid Search Brand"
