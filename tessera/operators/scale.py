"""Winsorising, scaling, PCA and quantile maps fitted on train.

Bounds and centre/scale values come from one aggregation over the training
rows and are applied as column expressions (literals), so the transform is a
narrow map with no join.  Exact quantiles come from the range-partitioned
ranking in :mod:`.quantiles` (numpy's linear interpolation);
``exact=False`` switches to ``percentile_approx``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import normal_quantile
from .columns import q, wide_agg
from .quantiles import column_quantiles


def _pct(c: str, ps: list[float], exact: bool):
    return F.percentile(q(c), ps) if exact else F.percentile_approx(q(c), ps, 10000)


def fit_winsor(train: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99,
               exact: bool = True) -> dict:
    if exact:
        qs = column_quantiles(train, cols, [lower, upper])
        return {c: tuple(v) for c, v in qs.items() if v[0] is not None}
    row = wide_agg(train, [_pct(c, [lower, upper], exact).alias(f"w{i}") for i, c in enumerate(cols)])
    return {c: tuple(row[f"w{i}"]) for i, c in enumerate(cols) if row[f"w{i}"] is not None}


def apply_winsor(df: DataFrame, bounds: dict) -> DataFrame:
    """Clip to the train bounds; NULL stays NULL (K1)."""
    new = {c: F.when(q(c).isNull(), q(c)).otherwise(F.greatest(F.least(q(c), F.lit(hi)), F.lit(lo)))
           for c, (lo, hi) in bounds.items() if c in df.columns}
    return df.withColumns(new) if new else df


@dataclass
class FittedScaler:
    kind: str
    center: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)


def fit_scaler(train: DataFrame, cols: list[str], kind: str = "standard", with_mean: bool = True,
               with_std: bool = True, exact: bool = True) -> FittedScaler:
    """``standard``: mean / population std (K2); ``robust``: median / IQR (K3).
    A zero scale becomes 1."""
    if kind == "robust":
        if exact:
            qs = column_quantiles(train, cols, [0.25, 0.5, 0.75])
            row = {f"r{i}": qs[c] for i, c in enumerate(cols)}
        else:
            row = wide_agg(train, [_pct(c, [0.25, 0.5, 0.75], exact).alias(f"r{i}") for i, c in enumerate(cols)])
        center = {c: (row[f"r{i}"][1] if with_mean else 0.0) for i, c in enumerate(cols)}
        scale = {}
        for i, c in enumerate(cols):
            s = row[f"r{i}"][2] - row[f"r{i}"][0] if with_std else 1.0
            scale[c] = s if s else 1.0
    else:
        exprs = []
        for i, c in enumerate(cols):
            exprs += [F.avg(q(c)).alias(f"m{i}"), F.stddev_pop(q(c)).alias(f"s{i}")]
        row = wide_agg(train, exprs)
        center = {c: (row[f"m{i}"] if with_mean else 0.0) for i, c in enumerate(cols)}
        scale = {c: ((row[f"s{i}"] or 1.0) if with_std else 1.0) for i, c in enumerate(cols)}
    return FittedScaler(kind, center, scale)


def apply_scaler(df: DataFrame, fit: FittedScaler) -> DataFrame:
    new = {c: (q(c) - F.lit(fit.center[c])) / F.lit(fit.scale[c]) for c in fit.center if c in df.columns}
    return df.withColumns(new) if new else df


@dataclass
class QuantileMap:
    """Quantiles of a training column: distinct values, each with the first and
    the last of the evenly spaced references it stands at."""

    col: str
    values: list[float] = field(default_factory=list)
    first: list[float] = field(default_factory=list)
    last: list[float] = field(default_factory=list)


#: uniform values are kept this far from 0 and 1 before they become normal
EDGE = 1e-7


def fit_quantile_map(train: DataFrame, column: str, n_quantiles: int = 1000) -> QuantileMap:
    """Exact quantiles at ``n_quantiles`` (at most the rows there are, at least
    two) even steps; NULL, NaN and infinite values take no part.  Without any
    value the map is empty."""
    v = q(column).cast("double")
    rows = train.select(v.alias("_qv")).where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    n = max(min(n_quantiles, rows.count()), 2)
    refs = [i / (n - 1) for i in range(n)]
    fit = QuantileMap(column)
    for ref, value in zip(refs, column_quantiles(rows, ["_qv"], refs)["_qv"]):
        if value is None:
            break
        if not fit.values or value > fit.values[-1]:
            fit.values.append(value)
            fit.first.append(ref)
            fit.last.append(ref)
        else:
            fit.last[-1] = ref
    return fit


def apply_quantile_map(df: DataFrame, fit: QuantileMap, out_col: str, output: str = "uniform") -> DataFrame:
    """Place of a value among the training quantiles, 0 to 1, linear between two
    of them; a value at several references takes their middle, the least and
    the greatest one (and all beyond) 0 and 1.  ``output='normal'`` gives the
    normal quantile of it, ends moved in by ``EDGE``.  NULL and NaN stay NULL, as does
    everything under an empty map.  The quantile is found by binary search
    (``Bucketizer``), the map is a literal of at most ``n_quantiles`` entries."""
    from pyspark.ml.feature import Bucketizer
    if output not in ("uniform", "normal"):
        raise ValueError(f"no such output distribution: {output}")
    if not fit.values:
        return df.withColumn(out_col, F.lit(None).cast("double"))
    v = q(fit.col).cast("double")
    rows = df.withColumn("_qm_v", F.nanvl(v, F.lit(None).cast("double")))
    inf = float("inf")
    rows = Bucketizer(splits=[-inf, *fit.values, inf], inputCol="_qm_v", outputCol="_qm_b", handleInvalid="keep").transform(rows)
    # bucket b starts at quantile b - 1, which is entry b of a list counted from 1
    b, top = F.col("_qm_b").cast("int"), len(fit.values)

    def at(values, i):
        return F.get(F.lit([float(x) for x in values]), i)

    here, low, high = at(fit.values, b - 1), at(fit.first, b - 1), at(fit.last, b - 1)
    on_way = high + (F.col("_qm_v") - here) / (at(fit.values, b) - here) * (at(fit.first, b) - high)
    place = (F.when(F.col("_qm_v").isNull(), None).when(F.col("_qm_v") <= fit.values[0], 0.0)
             .when(F.col("_qm_v") >= fit.values[top - 1], 1.0)
             .when(F.col("_qm_v") == here, (low + high) / 2).otherwise(on_way))
    # columns of their own: an expression used many times is not written out again inside the next one
    rows = rows.withColumn("_qm_p", place)
    if output == "normal":
        rows = rows.withColumn("_qm_p", F.when(F.col("_qm_p").isNotNull(), F.least(F.greatest("_qm_p", F.lit(EDGE)), F.lit(1 - EDGE))))
        rows = rows.withColumn("_qm_z", normal_quantile("_qm_p"))
    return rows.withColumn(out_col, F.col("_qm_z" if output == "normal" else "_qm_p")).drop("_qm_v", "_qm_b", "_qm_p", "_qm_z")


def fit_pca(train: DataFrame, cols: list[str], n_components: float | int = 0.95):
    """PCA on the (already scaled) columns with Spark ML (K4).

    ``n_components`` < 1 is a share of explained variance.  Returns the
    fitted model and k; components are sign-fixed so the largest-magnitude
    loading is positive."""
    from pyspark.ml.feature import PCA, VectorAssembler
    va = VectorAssembler(inputCols=cols, outputCol="_x", handleInvalid="keep")
    vec = va.transform(train.na.fill(0.0, cols)).select("_x")
    full = PCA(k=len(cols), inputCol="_x", outputCol="_pcs").fit(vec)
    ev = list(full.explainedVariance)
    if isinstance(n_components, float) and n_components < 1:
        acc, k = 0.0, 0
        for v in ev:
            acc += v
            k += 1
            if acc >= n_components:
                break
    else:
        k = int(n_components)
    return full, k, va


def apply_pca(df: DataFrame, model_k_va, keep: list[str] = ()) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    model, k, va = model_k_va
    cols = va.getInputCols()
    import numpy as np
    pc = model.pc.toArray()
    signs = [1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(pc.shape[1])]
    x = model.transform(va.transform(df.na.fill(0.0, cols)))
    arr = vector_to_array(F.col("_pcs"))
    return x.select(*[q(c) for c in keep],
                    *[(arr[j] * F.lit(signs[j])).alias(f"PC{j + 1}") for j in range(k)])
