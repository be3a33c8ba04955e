"""Principal components of the KPI matrix (periods x indicators at one coordinate).

The matrix is a ``groupBy(cycle_timestamp).pivot(indicator, <fixed list>)``
(explicit pivot values: no extra distinct job, fixed columns).  One aggregation
gives means, variances and correlations, d (d + 3) / 2 numbers for d indicators;
the eigenvectors of that d x d matrix are found on the driver, and the scores
are a projection with literal weights.

For many coordinates at once the same aggregation is grouped by coordinate; the
small matrices stay distributed, their eigenvectors are found batch by batch,
and each period meets the weights of its coordinate in one equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kpi_matrix(report: DataFrame, indicators: list[str], period: str, coordinate: str = "{}") -> DataFrame:
    """Periods where every indicator has a value at the coordinate, one column per indicator."""
    return (report.where((F.col("cycle") == period) & (F.col("dimensions") == coordinate))
            .groupBy("cycle_timestamp").pivot("indicator", indicators)
            .agg(F.max(F.col("current_value").cast("double"))).dropna())


def kpi_pca(report: DataFrame, indicators: list[str], period: str, coordinate: str = "{}", k: int = 2) -> DataFrame:
    """``cycle_timestamp, pc1..pck`` of the standardised matrix, and ``total_variance`` of all its components.

    A component's sign is fixed by its largest weight being positive.  Fewer than
    two periods, or an indicator that never changes, has no components: no rows.
    """
    m = kpi_matrix(report, indicators, period, coordinate)
    pairs = [(i, j) for i in range(len(indicators)) for j in range(i)]
    row = m.agg(*_moments(indicators)).first()
    d = len(indicators)
    scores = [f"pc{i + 1}" for i in range(k)]
    if any(x is None or x == 0 for x in row[d:2 * d]):
        return m.where(F.lit(False)).select("cycle_timestamp", *[F.lit(0.0).alias(s) for s in scores],
                                            F.lit(0.0).alias("total_variance"))
    corr = np.eye(d)
    for (i, j), covariance in zip(pairs, row[2 * d:]):
        corr[i, j] = corr[j, i] = covariance / (row[d + i] * row[d + j])
    _, vectors = np.linalg.eigh(corr)
    z = [(F.col(c) - row[i]) / row[d + i] for i, c in enumerate(indicators)]
    out = []
    for name, v in zip(scores, vectors.T[::-1]):
        v = v * np.sign(v[np.abs(v).argmax()])
        out.append(F.round(sum((zi * float(w) for zi, w in zip(z, v)), F.lit(0.0)), 6).alias(name))
    return m.select("cycle_timestamp", *out, F.lit(float(d)).alias("total_variance"))


def _moments(indicators: list[str]) -> list[Column]:
    """Means, deviations and covariances (a correlation would divide by the deviation of what never changes)."""
    pairs = [(i, j) for i in range(len(indicators)) for j in range(i)]
    return ([F.avg(c).alias(f"m{i}") for i, c in enumerate(indicators)]
            + [F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(indicators)]
            + [F.covar_samp(indicators[i], indicators[j]).alias(f"c{i}_{j}") for i, j in pairs])


def kpi_pca_by_coordinate(report: DataFrame, indicators: list[str], period: str, k: int = 2) -> DataFrame:
    """``dimensions, cycle_timestamp, pc1..pck`` and their ``variance_1..k`` for every coordinate by itself.

    Signs as in :func:`kpi_pca`. A coordinate with fewer than two full periods, or with an indicator that never
    changes, has no components and no rows."""
    d = len(indicators)
    m = (report.where(F.col("cycle") == period).groupBy("dimensions", "cycle_timestamp").pivot("indicator", indicators)
         .agg(F.max(F.col("current_value").cast("double"))).dropna(subset=indicators))
    moving = F.lit(True)
    for i in range(d):
        moving &= F.coalesce(F.col(f"s{i}") > 0, F.lit(False))
    moments = m.groupBy("dimensions").agg(*_moments(indicators)).where(moving)

    def components(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            corr = np.tile(np.eye(d), (len(rows), 1, 1))
            for i in range(d):
                for j in range(i):
                    corr[:, i, j] = corr[:, j, i] = rows[f"c{i}_{j}"] / (rows[f"s{i}"] * rows[f"s{j}"])
            values, vectors = np.linalg.eigh(corr)
            out = rows[["dimensions", *[f"m{i}" for i in range(d)], *[f"s{i}" for i in range(d)]]].copy()
            for c in range(k):
                v = vectors[:, :, d - 1 - c]
                largest = np.abs(v).argmax(axis=1)
                v = v * np.sign(v[np.arange(len(v)), largest])[:, None]
                out[f"variance_{c + 1}"] = values[:, d - 1 - c]
                for i in range(d):
                    out[f"w{c}_{i}"] = v[:, i]
            yield out

    numbers = [*[f"m{i}" for i in range(d)], *[f"s{i}" for i in range(d)]]
    for c in range(k):
        numbers += [f"variance_{c + 1}", *[f"w{c}_{i}" for i in range(d)]]
    weights = moments.mapInPandas(components, "dimensions string, " + ", ".join(f"{n} double" for n in numbers))
    z = [(F.col(c) - F.col(f"m{i}")) / F.col(f"s{i}") for i, c in enumerate(indicators)]
    scores = [F.round(sum((zi * F.col(f"w{c}_{i}") for i, zi in enumerate(z)), F.lit(0.0)), 6).alias(f"pc{c + 1}") for c in range(k)]
    return m.join(weights, "dimensions").select("dimensions", "cycle_timestamp", *scores, *[f"variance_{c + 1}" for c in range(k)])
