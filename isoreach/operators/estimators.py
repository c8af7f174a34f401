"""Estimators whose data passes are Spark aggregates and whose small systems are solved on the driver.

Each iteration is one aggregate over the rows; what comes back is a matrix of
features x features, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _normal(rows: DataFrame, xs: list[Column], y: Column, w: Column) -> tuple[np.ndarray, np.ndarray, float, float, float, int]:
    """X'WX, X'Wy, y'Wy, sum of wy, sum of w, n in one pass."""
    p = len(xs)
    aggs = [F.sum(w * xs[i] * xs[j]).alias(f"g{i}_{j}") for i in range(p) for j in range(i, p)] + [F.sum(w * xs[i] * y).alias(f"m{i}") for i in range(p)]
    r = rows.agg(*aggs, F.sum(w * y * y).alias("yy"), F.sum(w * y).alias("sy"), F.sum(w).alias("sw"), F.count("*").alias("n")).first()
    g = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            g[i, j] = g[j, i] = r[f"g{i}_{j}"] or 0.0
    return g, np.array([r[f"m{i}"] or 0.0 for i in range(p)]), r.yy or 0.0, r.sy or 0.0, r.sw or 0.0, r.n


def _design(features: list[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(f).cast("double") for f in features]]


def complete(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.dropna(subset=columns)


def ols(rows: DataFrame, y: str, features: list[str], weight: str | None = None) -> dict[str, float]:
    """Least squares with a constant: const, the features' coefficients, r2, residual_sd, n."""
    rows = complete(rows, [y, *features, *([weight] if weight else [])])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    g, m, yy, sy, sw, n = _normal(rows, _design(features), F.col(y).cast("double"), w)
    beta = np.linalg.lstsq(g, m, rcond=None)[0]
    rss, tss = max(0.0, yy - beta @ m), yy - sy * sy / sw if sw else 0.0
    out = dict(zip(["const", *features], beta.tolist(), strict=True))
    return out | {"r2": 1 - rss / tss if tss > 0 else math.nan, "residual_sd": math.sqrt(rss / max(1, n - len(beta))), "n": n}


def _irls(rows: DataFrame, y: str, features: list[str], weight_of: Callable[[Column], Column], rounds: int, tolerance: float) -> dict[str, float]:
    rows = complete(rows, [y, *features]).persist()
    xs, target = _design(features), F.col(y).cast("double")
    try:
        g, m, *_ = _normal(rows, xs, target, F.lit(1.0))
        beta = np.linalg.lstsq(g, m, rcond=None)[0]
        for _ in range(rounds):
            fit = reduce(lambda a, b: a + b, [F.lit(float(b)) * x for b, x in zip(beta, xs, strict=True)])
            g, m, *_ = _normal(rows, xs, target, weight_of(target - fit))
            new = np.linalg.lstsq(g, m, rcond=None)[0]
            moved = np.abs(new - beta).max() / max(1.0, np.abs(new).max())
            beta = new
            if moved < tolerance:
                break
    finally:
        rows.unpersist()
    return dict(zip(["const", *features], beta.tolist(), strict=True))


def median_regression(rows: DataFrame, y: str, features: list[str], rounds: int = 60, tolerance: float = 1e-7, least: float = 1e-6) -> dict[str, float]:
    """The least absolute residuals, by reweighting with 1 / max(|r|, least)."""
    return _irls(rows, y, features, lambda r: 1.0 / F.greatest(F.abs(r), F.lit(least)), rounds, tolerance)


def huber(rows: DataFrame, y: str, features: list[str], scale: float, t: float = 1.345, rounds: int = 60, tolerance: float = 1e-9) -> dict[str, float]:
    """Huber's regression: residuals beyond t * scale count by their absolute value."""
    return _irls(rows, y, features, lambda r: F.least(F.lit(1.0), F.lit(t * scale) / F.greatest(F.abs(r), F.lit(1e-12))), rounds, tolerance)


def poisson(rows: DataFrame, y: str, features: list[str], rounds: int = 50, tolerance: float = 1e-10) -> dict[str, float]:
    """Log-link Poisson regression by iteratively reweighted least squares."""
    rows = complete(rows, [y, *features]).persist()
    xs, target = _design(features), F.col(y).cast("double")
    try:
        mean = rows.agg(F.avg(target)).first()[0]
        beta = np.zeros(len(xs))
        beta[0] = math.log(max(mean, 1e-12))
        for _ in range(rounds):
            eta = reduce(lambda a, b: a + b, [F.lit(float(b)) * x for b, x in zip(beta, xs, strict=True)])
            mu = F.exp(eta)
            g, m, *_ = _normal(rows, xs, eta + (target - mu) / mu, mu)
            new = np.linalg.lstsq(g, m, rcond=None)[0]
            moved = np.abs(new - beta).max()
            beta = new
            if moved < tolerance:
                break
    finally:
        rows.unpersist()
    return dict(zip(["const", *features], beta.tolist(), strict=True))


def interval_em(rows: DataFrame, lo: str, hi: str, features: list[str], rounds: int = 50, burn_in: int = 20) -> dict[str, float]:
    """Regression on values known as intervals: each value is replaced by its expectation in its interval, then the fit is
    renewed; the estimates after the burn-in are averaged.  Deterministic: expectations stand for draws."""
    rows = complete(rows, [lo, hi, *features]).persist()
    xs, a, b = _design(features), F.col(lo).cast("double"), F.col(hi).cast("double")
    pdf = lambda z: F.exp(-z * z / 2) / math.sqrt(2 * math.pi)

    def cdf(z: Column) -> Column:
        # fixed values: the coefficients of the rational approximation of the normal integral
        t = 1.0 / (1.0 + 0.2316419 * F.abs(z))
        tail = pdf(z) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.when(z >= 0, 1.0 - tail).otherwise(tail)

    try:
        g, m, yy, *_, n = _normal(rows, xs, (a + b) / 2, F.lit(1.0))
        beta = np.linalg.lstsq(g, m, rcond=None)[0]
        sigma, kept = math.sqrt(max(1e-12, (yy - beta @ m) / max(1, n - len(beta)))), []
        for k in range(rounds):
            fit = reduce(lambda p, q: p + q, [F.lit(float(c)) * x for c, x in zip(beta, xs, strict=True)])
            za, zb = (a - fit) / sigma, (b - fit) / sigma
            mass = F.greatest(cdf(zb) - cdf(za), F.lit(1e-12))
            shift = (pdf(za) - pdf(zb)) / mass
            mean = F.greatest(a, F.least(b, fit + sigma * shift))
            # what a value varies by within its interval counts in the spread, as it would with draws
            within = F.greatest(F.lit(0.0), F.least((b - a) * (b - a) / 4, sigma * sigma * (1 + (za * pdf(za) - zb * pdf(zb)) / mass - shift * shift)))
            g, m, yy, *_ = _normal(rows, xs, mean, F.lit(1.0))
            spread = rows.agg(F.sum(within)).first()[0] or 0.0
            beta = np.linalg.lstsq(g, m, rcond=None)[0]
            sigma = math.sqrt(max(1e-9, (yy - beta @ m + spread) / max(1, n)))
            if k >= burn_in:
                kept.append(beta)
    finally:
        rows.unpersist()
    return dict(zip(["const", *features], np.mean(kept, axis=0).tolist(), strict=True))


def multinomial_logit(rows: DataFrame, choice: str, alternatives: dict[str, dict[str, str]], available: dict[str, str] | None = None, weight: str | None = None, rounds: int = 60, tolerance: float = 1e-9) -> dict[str, float]:
    """Maximum likelihood by Newton steps: parameters, ll, ll_null, rho2_bar, n, and robust errors <name>_se.

    alternatives: alternative -> parameter -> column of the attribute ('1' for a
    constant).  An alternative whose availability column is 0 or null can't be
    chosen.  One aggregate a step brings the likelihood, its slope and curvature.
    """
    names = sorted({p for a in alternatives.values() for p in a})
    at = {p: k for k, p in enumerate(names)}
    p = len(names)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    open_ = {a: (F.coalesce(F.col(available[a]) == 1, F.lit(False)) if available and a in available else F.lit(True)) for a in alternatives}
    xs = {a: [None] * p for a in alternatives}
    for a, terms in alternatives.items():
        for name, column in terms.items():
            xs[a][at[name]] = F.lit(1.0) if column == "1" else F.col(column).cast("double")
    zero = F.lit(0.0)
    rows = rows.where(F.col(choice).isin(*alternatives)).where(reduce(lambda q, r: q | r, [(F.col(choice) == a) & open_[a] for a in alternatives])).persist()

    def moments(beta: np.ndarray, robust: bool = False):
        v = {a: reduce(lambda q, r: q + r, [F.lit(float(b)) * x for b, x in zip(beta, xs[a], strict=True) if x is not None], zero) for a in alternatives}
        top = F.greatest(*[F.when(open_[a], v[a]) for a in alternatives]) if len(v) > 1 else next(iter(v.values()))
        e = {a: F.when(open_[a], F.exp(v[a] - top)).otherwise(zero) for a in alternatives}
        total = reduce(lambda q, r: q + r, e.values())
        base = rows.select("*", *[(e[a] / total).alias(f"_p_{a}") for a in alternatives], (reduce(lambda q, r: q + r, [F.when(F.col(choice) == a, v[a]).otherwise(zero) for a in alternatives]) - top - F.log(total)).alias("_ll"))
        mean = [reduce(lambda q, r: q + r, [F.col(f"_p_{a}") * xs[a][i] for a in alternatives if xs[a][i] is not None], zero) for i in range(p)]
        score = [reduce(lambda q, r: q + r, [F.when(F.col(choice) == a, xs[a][i]).otherwise(zero) for a in alternatives if xs[a][i] is not None], zero) - mean[i] for i in range(p)]
        base = base.select("*", *[s.alias(f"_s{i}") for i, s in enumerate(score)], *[m.alias(f"_m{i}") for i, m in enumerate(mean)])
        aggs = [F.sum(w * F.col("_ll")).alias("ll"), F.count("*").alias("n"), *[F.sum(w * F.col(f"_s{i}")).alias(f"s{i}") for i in range(p)]]
        for i in range(p):
            for j in range(i, p):
                second = reduce(lambda q, r: q + r, [F.col(f"_p_{a}") * xs[a][i] * xs[a][j] for a in alternatives if xs[a][i] is not None and xs[a][j] is not None], zero)
                aggs.append(F.sum(w * (second - F.col(f"_m{i}") * F.col(f"_m{j}"))).alias(f"h{i}_{j}"))
                if robust:
                    aggs.append(F.sum(w * w * F.col(f"_s{i}") * F.col(f"_s{j}")).alias(f"b{i}_{j}"))
        r = base.agg(*aggs).first()
        full = lambda c: np.array([[r[f"{c}{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)])
        return r.ll or 0.0, np.array([r[f"s{i}"] or 0.0 for i in range(p)]), full("h"), (full("b") if robust else None), r.n

    try:
        beta = np.zeros(p)
        ll, slope, curve, _, n = moments(beta)
        null = ll
        for _ in range(rounds):
            step = np.linalg.lstsq(curve, slope, rcond=None)[0]
            scale = 1.0
            while True:  # the likelihood is concave; a step too long is halved
                ll2, slope2, curve2, _, _ = moments(beta + scale * step)
                if ll2 >= ll - 1e-9 or scale < 1e-6:
                    break
                scale /= 2
            beta, slope, curve = beta + scale * step, slope2, curve2
            moved, ll = abs(ll2 - ll), ll2
            if moved < tolerance * max(1.0, abs(ll)):
                break
        _, _, curve, outer, n = moments(beta, robust=True)
        inverse = np.linalg.pinv(curve)
        se = np.sqrt(np.maximum(np.diag(inverse @ outer @ inverse), 0))
    finally:
        rows.unpersist()
    out = dict(zip(names, beta.tolist(), strict=True)) | {f"{k}_se": float(s) for k, s in zip(names, se, strict=True)}
    return out | {"ll": ll, "ll_null": null, "rho2_bar": 1 - (ll - p) / null if null else math.nan, "n": n}


def bounded_ols(rows: DataFrame, y: str, features: list[str], lower: dict[str, float] | None = None, upper: dict[str, float] | None = None, weight: str | None = None) -> dict[str, float]:
    """Least squares with bounds on coefficients: const, coefficients, r2, n.

    One pass brings the moments; the small problem is solved exactly by coordinate
    steps, each the best value of one coefficient within its bounds, to a fixpoint.
    """
    rows = complete(rows, [y, *features, *([weight] if weight else [])])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    g, m, yy, sy, sw, n = _normal(rows, _design(features), F.col(y).cast("double"), w)
    names = ["const", *features]
    low = np.array([(lower or {}).get(k, -math.inf) for k in names])
    high = np.array([(upper or {}).get(k, math.inf) for k in names])
    beta = np.clip(np.linalg.lstsq(g, m, rcond=None)[0], low, high)
    for _ in range(100_000):
        moved = 0.0
        for i in range(len(names)):
            if g[i, i] > 0:
                best = float(np.clip(beta[i] + (m[i] - g[i] @ beta) / g[i, i], low[i], high[i]))
                moved, beta[i] = max(moved, abs(best - beta[i])), best
        if moved < 1e-12 * max(1.0, float(np.abs(beta).max())):
            break
    tss = yy - sy * sy / sw if sw else 0.0
    rss = yy - 2 * beta @ m + beta @ g @ beta
    return dict(zip(names, beta.tolist(), strict=True)) | {"r2": 1 - rss / tss if tss > 0 else math.nan, "n": n}


def nested_logit(rows: DataFrame, choice: str, alternatives: dict[str, dict[str, str]], nests: dict[str, list[str]], weight: str | None = None, rounds: int = 80, tolerance: float = 1e-7) -> dict[str, float]:
    """Two-level nested logit by maximum likelihood: parameters, lambda_<nest> for nests of several alternatives, ll, ll_null, rho2_bar, n.

    alternatives as for the multinomial logit; each is in one nest.  A nest's
    lambda is the scale of its inclusive value, 1 for the multinomial logit, and is
    kept in [0.05, 1.5].  Each step is one aggregate that brings the scores' sum and
    their outer products (Berndt-Hall-Hall-Hausman), halved until the likelihood grows.
    """
    names = sorted({p for a in alternatives.values() for p in a})
    scaled = [k for k, members in nests.items() if len(members) > 1]
    p, q = len(names), len(names) + len(scaled)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    zero = F.lit(0.0)
    add = lambda items: reduce(lambda a, b: a + b, items, zero)
    xs = {a: [(F.lit(1.0) if terms[n] == "1" else F.col(terms[n]).cast("double")) if n in terms else zero for n in names] for a, terms in alternatives.items()}
    rows = rows.where(F.col(choice).isin(*alternatives)).persist()

    def moments(theta: np.ndarray):
        lam = {k: float(theta[p + scaled.index(k)]) if k in scaled else 1.0 for k in nests}
        v = {a: add([F.lit(float(b)) * x for b, x in zip(theta, xs[a], strict=False)]) for a in alternatives}
        r = rows.select("*", *[v[a].alias(f"_v_{a}") for a in alternatives])
        v = {a: F.col(f"_v_{a}") for a in alternatives}
        top = {k: F.greatest(*[v[a] for a in members]) if len(members) > 1 else v[members[0]] for k, members in nests.items()}
        e = {a: F.exp((v[a] - top[k]) / lam[k]) for k, members in nests.items() for a in members}
        r = r.select("*", *[(top[k] / lam[k] + F.log(add([e[a] for a in members]))).alias(f"_i_{k}") for k, members in nests.items()])
        i = {k: F.col(f"_i_{k}") for k in nests}
        best = F.greatest(*[F.lit(lam[k]) * i[k] for k in nests]) if len(nests) > 1 else F.lit(lam[next(iter(nests))]) * i[next(iter(nests))]
        r = r.select("*", (best + F.log(add([F.exp(F.lit(lam[k]) * i[k] - best) for k in nests]))).alias("_total"))
        within = {a: F.exp(v[a] / lam[k] - i[k]) for k, members in nests.items() for a in members}
        outer = {k: F.exp(F.lit(lam[k]) * i[k] - F.col("_total")) for k in nests}
        mean = {k: [add([within[a] * xs[a][j] for a in members]) for j in range(p)] for k, members in nests.items()}
        inner = {k: add([within[a] * v[a] for a in members]) for k, members in nests.items()}
        chosen = lambda value: add([F.when(F.col(choice) == a, value(a, k)).otherwise(zero) for k, members in nests.items() for a in members])
        ll = chosen(lambda a, k: v[a] / lam[k] - i[k] + F.lit(lam[k]) * i[k]) - F.col("_total")
        score = [chosen(lambda a, k, j=j: (xs[a][j] - mean[k][j]) / lam[k] + mean[k][j]) - add([outer[k] * mean[k][j] for k in nests]) for j in range(p)]
        for k in scaled:
            at = lam[k]
            own = chosen(lambda a, n, k=k, at=at: (-v[a] + inner[k]) / (at * at) + i[k] - inner[k] / at if n == k else zero)
            score.append(own - outer[k] * (i[k] - inner[k] / at))
        r = r.select(w.alias("_w"), ll.alias("_ll"), *[s.alias(f"_s{j}") for j, s in enumerate(score)])
        aggs = [F.sum(F.col("_w") * F.col("_ll")).alias("ll"), F.count("*").alias("n"), *[F.sum(F.col("_w") * F.col(f"_s{j}")).alias(f"s{j}") for j in range(q)]]
        aggs += [F.sum(F.col("_w") * F.col(f"_s{a}") * F.col(f"_s{b}")).alias(f"b{a}_{b}") for a in range(q) for b in range(a, q)]
        got = r.agg(*aggs).first()
        curve = np.array([[got[f"b{min(a, b)}_{max(a, b)}"] or 0.0 for b in range(q)] for a in range(q)])
        return got.ll or 0.0, np.array([got[f"s{j}"] or 0.0 for j in range(q)]), curve, got.n

    try:
        theta = np.concatenate([np.zeros(p), np.ones(len(scaled))])
        ll, slope, curve, n = moments(theta)
        null = ll
        for _ in range(rounds):
            step = np.linalg.lstsq(curve + 1e-9 * np.eye(q), slope, rcond=None)[0]
            scale = 1.0
            while True:
                new = theta + scale * step
                new[p:] = np.clip(new[p:], 0.05, 1.5)
                found = moments(new)
                if found[0] >= ll - 1e-9 or scale < 1e-4:
                    break
                scale /= 2
            moved = found[0] - ll
            if moved < 0:
                break
            theta, (ll, slope, curve, n) = new, found
            if moved < tolerance * max(1.0, abs(ll)):
                break
    finally:
        rows.unpersist()
    out = dict(zip([*names, *(f"lambda_{k}" for k in scaled)], theta.tolist(), strict=True))
    return out | {"ll": ll, "ll_null": null, "rho2_bar": 1 - (ll - q) / null if null else math.nan, "n": n}
