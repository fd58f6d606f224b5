"""Column-level helpers (pure ``Column -> Column`` functions, JVM-side)."""

from consentflow.functions.defaults import *  # noqa: F401,F403
from consentflow.functions.keys import random_id, surrogate_key  # noqa: F401
from consentflow.functions.metrics import (  # noqa: F401
    conversion_rate, extrapolated_count, hour_start, micros_between, seconds_between,
    strip_quotes)
