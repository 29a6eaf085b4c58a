"""First groups by fingerprint: ties by string, and no string in a shuffle of all rows."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tributary.operators.reports import path_analysis
from tributary.plans.catalog import pipe
from tributary.plans.topk import by_fingerprint, first_groups


def test_first_groups_with_ties_equal_a_plain_count(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows = spark.createDataFrame([(w,) for w in words], "w string").repartition(5)
    want = sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))
    for top in (1, 7, 20, 1000, None):
        keyed, groups = by_fingerprint(rows, F.col("w"), [F.count(F.lit(1)).alias("n")])
        got = [(r.s, r.n) for r in first_groups(keyed, groups, F.col("w"), "s", "n", top).collect()]
        assert got == want[:top]
    keyed, groups = by_fingerprint(rows.limit(0), F.col("w"), [F.count(F.lit(1)).alias("n")])
    assert first_groups(keyed, groups, F.col("w"), "s", "n", 3).collect() == []


def test_groups_are_shuffled_by_fingerprint_only(spark):
    p = pipe(spark, SF_SMALL)
    rows = p.matched.select("user_pseudo_id", "path_length", "path.channel")
    _, groups = by_fingerprint(rows, F.array_join("channel", " > "), [F.count(F.lit(1)).alias("n"), F.countDistinct("user_pseudo_id").alias("u")])
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\(_fp", plan) and "Expand" not in plan
    assert not any("channel" in line or "path" in line for line in plan.splitlines() if "Exchange" in line)
    out = path_analysis(p.matched.withColumnRenamed("purchase_revenue_in_usd", "conversion_value_usd"))
    assert "row_number" not in out._jdf.queryExecution().executedPlan().toString()
