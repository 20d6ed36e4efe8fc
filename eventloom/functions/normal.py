"""Normal quantiles (driver-side constants) and tail probability (on aggregated rows)."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def upper_tail(z: Column) -> Column:
    """P(Z > z). Spark has no erf, so a pandas UDF does it, after aggregation only."""

    @F.pandas_udf("double")
    def tail(values: pd.Series) -> pd.Series:
        return values.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2)), na_action="ignore")

    return tail(z.cast("double"))
