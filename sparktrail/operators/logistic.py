"""L2 logistic regressions of all tenants at once.

Each Newton step is one aggregate over the features: rows meet their tenant's
coefficients, and the loss, the gradient and the upper triangle of the Hessian
are summed by tenant (partial sums first, so a tenant with a third of the rows
is as good as any). The steps themselves, a small linear system for each tenant,
are solved in the tasks that hold the tenants' rows. A step that makes the loss
larger is halved. The driver sees how many tenants are not done, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktrail.plans.materialize import materialize
from sparktrail.plans.sizing import maybe_broadcast

MAX_STEPS = 100
TOLERANCE = 1e-10
_STATE = "web_id string, beta array<double>, base array<double>, step array<double>, loss double, done boolean"


def _sums(x: list[Column], y: Column) -> list[Column]:
    """Loss, gradient and Hessian of rows with values ``x`` (the last is 1) and their tenant's ``beta``."""
    z = F.lit(0.0)
    for i, c in enumerate(x):
        z = z + c * F.col("beta")[i]
    p = F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z
    return [z, p, loss]


def _update(d: int, penalty: float, batches: Iterator) -> Iterator:
    """One step for each tenant: (state, sums) -> state."""
    import numpy as np
    import pandas as pd

    fine = np.append(np.full(d - 1, penalty), 0.0)  # the intercept isn't penalised
    upper = np.triu_indices(d)
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            beta, base, step = (np.array(v, float) for v in (r.beta, r.base, r.step))
            loss = r.nll + 0.5 * float((fine * beta * beta).sum())
            worse = loss > r.loss + 1e-12 * (1 + abs(r.loss)) or not np.isfinite(loss)
            if worse and np.abs(step).max() > TOLERANCE * (1 + np.abs(base).max()):
                step = step / 2
                out.append((r.web_id, base + step, base, step, r.loss, False))
                continue
            if worse:
                out.append((r.web_id, base, base, step, r.loss, True))
                continue
            hessian = np.zeros((d, d))
            hessian[upper] = np.array(r.hessian, float)
            hessian = hessian + np.triu(hessian, 1).T + np.diag(fine)
            scale = np.sqrt(np.maximum(np.diag(hessian), 1e-300))
            gradient = np.array(r.gradient, float) - fine * beta
            step = np.linalg.lstsq(hessian / np.outer(scale, scale), gradient / scale, rcond=1e-14)[0] / scale
            end = np.abs(step).max() <= TOLERANCE * (1 + np.abs(beta).max())
            out.append((r.web_id, beta + step, beta, step, loss, bool(end)))
        yield pd.DataFrame([(w, *(list(map(float, v)) for v in vs), lo, e) for w, *vs, lo, e in out],
                           columns=["web_id", "beta", "base", "step", "loss", "done"])


def fit_tenants(df: DataFrame, features: list[str], label: str = "is_purchased", C: float = 1.0,
                whole: str | None = "default", max_steps: int = MAX_STEPS) -> DataFrame:
    """For each tenant, and for all rows together under the name ``whole``, the minimum of the summed log loss plus
    |w|^2 / (2 C) (intercept not penalised, no scaling).

    A null feature counts as 0; rows without a label or tenant are no training
    rows. A tenant whose labels are all the same has zeros, and an intercept of
    plus or minus infinity. Returns (web_id, coef, intercept, n_rows, n_null_rows)."""
    if whole is not None:
        everyone = F.explode(F.array("web_id", F.lit(whole)))
    else:
        everyone = F.col("web_id")
    some_null = F.greatest(*[F.col(c).isNull().cast("int") for c in features], F.lit(0))
    rows = df.where(F.col(label).isNotNull() & F.col("web_id").isNotNull()).select(
        "web_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("y"), some_null.alias("gaps"))
    rows = materialize(rows)
    named = rows.select(everyone.alias("web_id"), *[c for c in rows.columns if c != "web_id"])
    tenants = materialize(named.groupBy("web_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("gaps").alias("n_null_rows"),
                                                      F.min("y").alias("low"), F.max("y").alias("high")))
    d = len(features) + 1
    zeros = F.array(*[F.lit(0.0)] * d)
    state = tenants.where("low < high").select("web_id", zeros.alias("beta"), zeros.alias("base"), zeros.alias("step"),
                                               F.lit(float("inf")).alias("loss"), F.lit(False).alias("done"))
    state = materialize(state)
    x = [*[F.col(f"x{i}") for i in range(d - 1)], F.lit(1.0)]
    for _ in range(max_steps):
        going = state.where(~F.col("done"))
        z, p, loss = _sums(x, F.col("y"))
        seen = named.join(maybe_broadcast(going.select("web_id", "beta")), "web_id").withColumn("p", p).withColumn("nll", loss)
        weight = F.col("p") * (1 - F.col("p"))
        sums = seen.groupBy("web_id").agg(
            F.sum("nll").alias("nll"), *[F.sum((F.col("y") - F.col("p")) * x[i]).alias(f"g{i}") for i in range(d)],
            *[F.sum(weight * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(d) for j in range(i, d)])
        sums = sums.select("web_id", "nll", F.array(*[f"g{i}" for i in range(d)]).alias("gradient"),
                           F.array(*[f"h{i}_{j}" for i in range(d) for j in range(i, d)]).alias("hessian"))
        moved = going.drop("done").join(sums, "web_id").mapInPandas(partial(_update, d, 1.0 / C), _STATE)
        state = materialize(state.where("done").unionByName(moved.select(*state.columns)))
        if state.where(~F.col("done")).isEmpty():
            break
    fitted = state.select("web_id", F.slice("beta", 1, d - 1).alias("coef"), F.element_at("beta", d).alias("intercept"))
    flat = tenants.where("low = high").select("web_id", F.array(*[F.lit(0.0)] * (d - 1)).alias("coef"),
                                              F.when(F.col("low") > 0, float("inf")).otherwise(float("-inf")).alias("intercept"))
    return fitted.unionByName(flat).join(tenants.select("web_id", "n_rows", "n_null_rows"), "web_id")
