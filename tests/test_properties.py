"""Property tests of the rounding rules the results depend on (D8, D8b)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from consentflow.functions import conversion_rate, extrapolated_count

pairs = st.lists(st.tuples(st.integers(0, 10**7), st.integers(1, 10**7)), min_size=1, max_size=200)
counts = st.lists(st.tuples(st.integers(0, 10**6), st.sampled_from([0.1, 0.2, 0.25, 0.4, 0.5, 1.0])),
                  min_size=1, max_size=200)


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_conversion_rate_is_exact_half_up(spark, rows):
    df = spark.createDataFrame([(float(g), float(a)) for g, a in rows], "g double, a double")
    got = [r[0] for r in df.select(conversion_rate("g", "a")).collect()]
    want = [(Decimal(g) / Decimal(a)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for g, a in rows]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(counts)
def test_extrapolation_is_half_even(spark, rows):
    df = spark.createDataFrame([(c, r) for c, r in rows], "c long, r double")
    got = [x[0] for x in df.select(extrapolated_count("c", "r")).collect()]
    assert got == [float(round(c / r)) for c, r in rows]  # Python rounds half to even
