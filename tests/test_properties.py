"""Property tests: Spark expressions vs a plain-Python statement of each rule
over random inputs (one Spark job per property)."""

from datetime import timedelta
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.config import AS_OF
from tillroll.functions import rules

TIERS = st.sampled_from(["Bronze", "Silver", "Gold", "Platinum", "", None])
DAYS = st.one_of(st.none(), st.integers(min_value=0, max_value=150))
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def _gt(a, b):
    return None if a is None else a > b


def _le(a, b):
    return None if a is None else a <= b


def _and(a, b):
    if a is False or b is False:
        return False
    if a is None or b is None:
        return None
    return True


def _or(a, b):
    if a is True or b is True:
        return True
    if a is None or b is None:
        return None
    return False


def py_segment(tier, dp, da, signup):
    high = None if tier is None else tier in ("Gold", "Platinum")
    since_signup = (AS_OF.date() - signup).days
    if _and(high, _le(dp, 30)) is True:
        return "High-Value Active"
    if _and(high, _gt(dp, 30)) is True:
        return "High-Value At-Risk"
    if _or(_gt(dp, 60), _gt(da, 30)) is True:
        return "Dormant"
    if since_signup <= 90:
        return "New"
    if _and(_gt(dp, 30), _le(dp, 60)) is True:
        return "At-Risk"
    return "Active"


@SETTINGS
@given(st.lists(st.tuples(TIERS, DAYS, DAYS, st.integers(min_value=0, max_value=400)), min_size=50, max_size=200))
def test_segment_rule(spark, rows):
    data = [(i, t, dp, da, AS_OF.date() - timedelta(days=s)) for i, (t, dp, da, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, loyalty_tier string, days_since_last_purchase int, "
                                     "days_since_last_activity int, signup_date date")
    got = dict(df.select("id", rules.segment(as_of=AS_OF)).collect())
    assert got == {i: py_segment(t, dp, da, sd) for i, t, dp, da, sd in data}


def py_progress(points, threshold):
    if threshold <= 0:
        return 0.0
    x = Fraction(points * 100, threshold)
    tenths = (x * 10 + Fraction(1, 2)).__floor__()   # half-up on the exact ratio
    return min(100.0, tenths / 10)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30000), st.sampled_from([0, 5000, 15000, 50000, 100000])),
                min_size=50, max_size=200))
def test_tier_progress(spark, rows):
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "id int, p int, t int")
    got = dict(df.select("id", rules.tier_progress("p", "t")).collect())
    assert got == {i: py_progress(p, t) for i, (p, t) in enumerate(rows)}


@SETTINGS
@given(st.lists(st.floats(min_value=-500, max_value=500, allow_nan=False), min_size=50, max_size=200))
def test_offer_discount(spark, scores):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "id int, s double")
    got = dict(df.select("id", rules.offer_discount("s")).collect())
    assert got == {i: min(30, max(5, int(s / 5))) for i, s in enumerate(scores)}

