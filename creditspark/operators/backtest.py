"""K1–K5 — PD model back-test.

* K1: exact stratified 70/30 split. Each loan has a key (hash of its id alone, so
  a corrected label does not move a loan's place in the order); within a class
  the loans with the smallest keys are the test rows, as many as the class's
  share of ``ceil(test_size · n)``. The cut is found by radix selection
  (``smallest_keys``): histograms of the key's leading bits, one pass each, not a
  per-class sort — a class may be a third of the book.
* K2: L2 logistic regression by Newton steps. A step is one aggregate over the
  training rows: log-loss, gradient and Hessian, 78 sums for ten features and an
  intercept, however many rows there are; the driver solves the 11 equations. The
  objective is that of an L2 model with C = 1 on summed log-loss, the intercept
  left free. ``fit_pd_model`` is the ``pyspark.ml`` form of the same model.
* K3: score = probability of class 1, a projection. A row with a NULL or
  NaN feature or label is an error, never dropped.
* K4: exact tie-aware ROC AUC (Mann–Whitney) from per-score counts and
  distributed prefix sums (``ordered.prefix_sums``).
* K5: Brier score, a plain mean.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import Term, require_columns
from ..functions import sqltext as X
from ..functions.core import with_exprs
from .ordered import checkpointed, prefix_sums

# ---- fixed values: back-test feature list (no loan_amount) and settings ----
FEATURES = ("age", "annual_income", "credit_score", "employment_years", "dti_ratio", "utilization_ratio",
            "num_inquiries_12m", "booking_unemp", "booking_gdp_growth", "vintage_index")
TEST_SIZE = 0.3
MAX_ITER = 200
SPLIT_SALT = "split"
KEY_BITS = 52
# radix selection: leading bits a pass, and the number of keys that are fetched rather than counted again
RADIX_BITS, FETCHED = 12, 10_000
# Newton steps at most (the fit ends when a step changes no scaled coefficient by STEP_TOL), bound of the linear score
NEWTON_STEPS, STEP_TOL, LOGIT_BOUND = 12, 1e-9, 35.0
# unit of each feature in which the equations are solved (the solution does not depend on it)
UNITS = {"age": 100.0, "annual_income": 100_000.0, "credit_score": 1000.0, "employment_years": 10.0,
         "num_inquiries_12m": 10.0, "booking_unemp": 10.0, "booking_gdp_growth": 10.0, "vintage_index": 10.0}
# A documented coefficient vector to score with where no fit is wanted (champion model): intercept and weights.
CHAMPION_INTERCEPT = 0.5
CHAMPION_TERMS = (
    Term(0.015, "age"), Term(-4e-6, "annual_income"), Term(-0.006, "credit_score"), Term(-0.02, "employment_years"),
    Term(5.0, "dti_ratio"), Term(2.5, "utilization_ratio"), Term(0.2, "num_inquiries_12m"),
    Term(0.1, "booking_unemp"), Term(-0.05, "booking_gdp_growth"), Term(0.12, "vintage_index"),
)
CHAMPION_BOUND = 30.0


def split_key(key_col: str = "loan_id") -> F.Column:
    """52 bits of an md5 of the loan id: exact as a double, ties between loans are negligible."""
    digest = F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{SPLIT_SALT}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _test_rows(counts: dict, test_size: float) -> dict:
    """Rows of each class in the test part: shares of ``ceil(test_size · n)`` by largest remainder."""
    n = sum(counts.values())
    total = min(n, math.ceil(test_size * n - 1e-9))
    exact = {c: counts[c] * total / n for c in counts}
    out = {c: math.floor(exact[c]) for c in counts}
    for c in sorted(counts, key=lambda c: (out[c] - exact[c], c))[: total - sum(out.values())]:
        out[c] += 1
    return out


def smallest_keys(df: DataFrame, key: F.Column, class_col: str, wanted, *, bits: int = RADIX_BITS,
                  fetched: int = FETCHED, key_bits: int = KEY_BITS) -> tuple[dict, dict]:
    """``({class: rows}, {class: cut})`` with exactly ``wanted(rows)[class]`` keys below each class's cut.

    Radix selection: the first pass counts the leading ``bits`` of the keys by
    class (a histogram of bounded size, combined on the map side) and tells the
    sizes of the classes and the bucket that each cut lies in; further passes count
    the next bits within those buckets only, until few enough keys are left to
    look at. Equal keys stay together: if they straddle the wanted number, the cut lies above them.
    """
    keyed = df.select(F.col(class_col).alias("c"), key.alias("k"))
    shift, prefix, before, sizes, want = key_bits, {}, {}, {}, {}
    cuts: dict = {}
    while True:
        shift = max(0, shift - bits)
        rows = keyed
        if prefix:
            inside = F.lit(False)
            for c, (p, width) in prefix.items():
                inside = inside | ((F.col("c") == F.lit(c)) & (F.shiftright("k", width) == F.lit(p)))
            rows = keyed.where(inside)
        counts: dict = {}
        for r in rows.groupBy("c", F.shiftright("k", shift).alias("b")).count().collect():
            counts.setdefault(r["c"], {})[r["b"]] = r["count"]
        if not sizes:
            sizes = {c: sum(h.values()) for c, h in counts.items()}
            if None in sizes:
                raise ValueError(f"{sizes[None]} rows have no {class_col}")
            want = wanted(sizes) if sizes else {}
            cuts = {c: 0 for c in sizes if not want[c]} | {c: 1 << key_bits for c in sizes if want[c] == sizes[c]}
            prefix, before = {c: (0, 0) for c in sizes if c not in cuts}, {c: 0 for c in sizes}
        left = 0
        for c in list(prefix):
            for b in sorted(counts[c]):
                if before[c] + counts[c][b] >= want[c]:
                    prefix[c] = (b, shift)
                    left += counts[c][b]
                    break
                before[c] += counts[c][b]
            if shift == 0:
                cuts[c] = prefix.pop(c)[0] + 1
        if not prefix:
            return sizes, cuts
        if left <= fetched:
            inside = F.lit(False)
            for c, (p, width) in prefix.items():
                inside = inside | ((F.col("c") == F.lit(c)) & (F.shiftright("k", width) == F.lit(p)))
            keys: dict = {}
            for r in keyed.where(inside).collect():  # at most ``fetched`` rows
                keys.setdefault(r["c"], []).append(r["k"])
            for c in prefix:
                cuts[c] = sorted(keys[c])[want[c] - before[c] - 1] + 1
            return sizes, cuts


def stratified_split(df: DataFrame, *, label_col: str = "default_12m", test_size: float = TEST_SIZE,
                     key_col: str = "loan_id", out: str = "split") -> DataFrame:
    """K1 — ``split`` = 'test' for exactly the class's share of rows, else 'train'.

    Reads ``df`` two or three times (see :func:`smallest_keys`): pass a written table.
    """
    require_columns(df, label_col, key_col)
    key = split_key(key_col)
    _, cuts = smallest_keys(df, key, label_col, lambda sizes: _test_rows(sizes, test_size))
    test = F.lit(False)
    for c, cut in cuts.items():
        test = test | ((F.col(label_col) == F.lit(c)) & (key < F.lit(cut)))
    return df.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train")))


def auc(df: DataFrame, score_col: str, label_col: str, *, buckets: int | None = None) -> DataFrame:
    """K4 — ROC AUC with ties counted half: Σ_v pos(v)·(neg_below(v) + neg(v)/2) / (P·N).

    Rows collapse to per-score counts (checkpointed); bucketed prefix sums give
    the negatives below each score. Rows without score or label are left out; NaN
    scores and a book with one class only are errors.
    """
    counts = (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
              .select(F.lit("auc").alias("g"), F.col(score_col).cast("double").alias("s"),
                      F.col(label_col).cast("long").alias("y"))
              .groupBy("g", "s").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))
    counts = checkpointed(counts)
    seen = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                      F.count(F.when(F.isnan("s"), 1)).alias("nan")).first()
    return auc_of_counts(counts, (seen["pos"], seen["neg"], seen["nan"]), score_col, label_col, buckets)


def auc_of_counts(counts: DataFrame, seen: tuple, score_col: str, label_col: str, buckets: int | None = None) -> DataFrame:
    """AUC from a written table ``g, s, pos, neg``, one row a score; ``seen``: its positives, negatives and NaN scores."""
    if seen[2]:
        raise ValueError(f"{score_col} holds NaN")
    if not seen[0] or not seen[1]:
        raise ValueError(f"AUC needs both classes of {label_col}; found {seen[0] or 0} ones and {seen[1] or 0} zeros")
    ps = prefix_sums(counts, "g", "s", ["neg"], buckets)
    return ps.agg(
        (F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
         / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("auc"))


def brier(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """K5 — mean squared error of the probability."""
    d = F.col(score_col) - F.col(label_col).cast("double")
    return df.agg(F.avg(d * d).alias("brier"))


def _assembled(df: DataFrame, features) -> DataFrame:
    """Feature vectors; a NULL or NaN feature raises."""
    from pyspark.ml.feature import VectorAssembler

    out = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)
    nan = F.lit(False)
    for c in features:
        nan = nan | F.isnan(F.col(c).cast("double"))
    ok = F.when(nan, F.raise_error(F.lit("a feature is NaN"))).otherwise(F.lit(True))
    return out.where(ok)


def fit_pd_model(train: DataFrame, features=FEATURES, *, label_col: str = "default_12m",
                 max_iter: int = MAX_ITER):
    """K2 — unscaled L2 logistic regression; returns the fitted ``pyspark.ml`` model."""
    from pyspark.ml.classification import LogisticRegression

    label = F.coalesce(F.col(label_col).cast("double"), F.raise_error(F.lit(f"{label_col} is NULL")).cast("double"))
    rows = _assembled(train.select(*features, label.alias("label")), features)
    n = rows.count()  # the rows that are fitted: none is dropped
    lr = LogisticRegression(maxIter=max_iter, regParam=1.0 / max(n, 1), elasticNetParam=0.0, tol=1e-12,
                            standardization=False, fitIntercept=True, family="binomial")
    return lr.fit(rows)


@dataclass(frozen=True)
class Logistic:
    """A fitted logistic regression: ``weights`` of ``features`` and the intercept, in the features' own units."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    steps: int
    log_loss: float

    def table(self, spark) -> DataFrame:
        """``feature, coefficient`` rows, the intercept as ``intercept``."""
        rows = [("intercept", float(self.intercept)), *zip(self.features, map(float, self.weights))]
        return spark.createDataFrame(rows, "feature string, coefficient double")


def _checked(c: str) -> str:
    """A feature or label as double; NULL or NaN raises."""
    v = f"CAST(`{c}` AS DOUBLE)"
    return f"CASE WHEN {v} IS NULL OR isnan({v}) THEN CAST(raise_error('{c} is NULL or NaN') AS DOUBLE) ELSE {v} END"


def newton_sums(rows: DataFrame, names: Sequence[str], label: str, weights: np.ndarray):
    """Log-loss, gradient and Hessian of the summed log-loss at ``weights`` (intercept first), from one aggregate."""
    k = len(names) + 1
    z = " + ".join([X.num(weights[0]), *(f"{X.num(w)} * `{n}`" for w, n in zip(weights[1:], names))])
    z = X.clip(f"({z})", -LOGIT_BOUND, LOGIT_BOUND)
    scored = rows.selectExpr("*", f"{z} AS _z").selectExpr("*", "1D / (1D + exp(-_z)) AS _p")
    scored = scored.selectExpr("*", f"_p * (1D - _p) AS _v", f"_p - `{label}` AS _e", f"log1p(exp(_z)) - `{label}` * _z AS _l")
    x = ["", *(f" * `{n}`" for n in names)]
    sums = [f"sum(_e{x[i]}) AS g{i}" for i in range(k)]
    sums += [f"sum(_v{x[i]}{x[j]}) AS h{i}_{j}" for i in range(k) for j in range(i, k)]
    row = scored.selectExpr("count(*) AS n", "sum(_l) AS loss", *sums).first()
    if not row["n"]:
        raise ValueError("no rows to fit")
    gradient = np.array([row[f"g{i}"] for i in range(k)])
    hessian = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    return row["loss"], gradient, hessian


def fit_logistic(train: DataFrame, features=FEATURES, *, label_col: str = "default_12m", penalty: float = 1.0,
                 steps: int = NEWTON_STEPS, tol: float = STEP_TOL) -> Logistic:
    """K2 — Newton steps on Σ log-loss + penalty/2 · Σ w², the intercept free.

    Reads ``train`` once a step: pass a written table. A step that does not lower the objective is halved.
    """
    require_columns(train, label_col, *features)
    unit = np.array([1.0, *(UNITS.get(f, 1.0) for f in features)])
    names = [f"x{i}" for i in range(len(features))]
    rows = train.selectExpr(f"{_checked(label_col)} AS y",
                            *(f"({_checked(f)}) / {X.num(u)} AS {n}" for f, u, n in zip(features, unit[1:], names)))
    ridge = penalty / unit**2 * np.array([0.0, *([1.0] * len(features))])  # the penalty on weights in own units
    w = np.zeros(len(names) + 1)
    step, last = np.zeros_like(w), math.inf
    for done in range(steps + 1):
        loss, gradient, hessian = newton_sums(rows, names, "y", w)
        objective = loss + 0.5 * float(ridge @ w**2)
        if objective > last + 1e-9 * abs(last):
            step = step / 2
            w = w - step
            continue
        last, final = objective, w
        step = -np.linalg.solve(hessian + np.diag(ridge), gradient + ridge * w)
        if done == steps or np.abs(step).max() < tol:
            break
        w = w + step
    own = final / unit
    return Logistic(tuple(features), tuple(own[1:].tolist()), float(own[0]), done, last)


def logistic_score(df: DataFrame, model: Logistic, *, out: str = "pd_model") -> DataFrame:
    """K3 — probability of class 1 under a :class:`Logistic` model: a projection; a NULL or NaN feature raises."""
    z = " + ".join([X.num(model.intercept), *(f"{X.num(w)} * ({_checked(f)})" for f, w in zip(model.features, model.weights))])
    return with_exprs(df, {out: X.sigmoid(f"({z})", LOGIT_BOUND)})


def score(model, df: DataFrame, features=FEATURES, *, out: str = "pd_model") -> DataFrame:
    """K3 — probability of class 1 from a fitted model."""
    from pyspark.ml.functions import vector_to_array

    return (model.transform(_assembled(df, features))
            .withColumn(out, vector_to_array(F.col("probability"))[1])
            .drop("features", "rawPrediction", "probability", "prediction"))


def champion_score(df: DataFrame, *, out: str = "pd_model") -> DataFrame:
    """K3 with the documented coefficient vector: a projection, no fit."""
    require_columns(df, *FEATURES)
    z = X.linear_score(CHAMPION_INTERCEPT, CHAMPION_TERMS)
    return with_exprs(df, {out: X.sigmoid(z, CHAMPION_BOUND)})


def split_table(df: DataFrame, features=FEATURES, *, label_col: str = "default_12m") -> DataFrame:
    """Loan id, label, features and split, written once to the checkpoint folder."""
    narrow = checkpointed(df.select("loan_id", label_col, *features))
    return stratified_split(narrow, label_col=label_col)


def metrics(scored: DataFrame, score_col: str = "pd_model", *, label_col: str = "default_12m") -> DataFrame:
    """K4 + K5 out of sample: one row ``n_train, n_test, auc, brier``.

    One pass collapses the test rows to one per score (the train rows to one); everything follows from that table.
    """
    test = F.col("split") == "test"
    one, zero = F.col(label_col) == 1, F.col(label_col) == 0
    counts = checkpointed(scored.groupBy(F.when(test, F.col(score_col).cast("double")).alias("s"), test.alias("test")).agg(
        F.count(F.when(one, 1)).alias("pos"), F.count(F.when(zero, 1)).alias("neg"), F.count(F.lit(1)).alias("n")))
    s, n = F.col("s"), F.col("pos") + F.col("neg")
    error = F.col("pos") * (s - 1.0) * (s - 1.0) + F.col("neg") * s * s
    sums = counts.agg(F.sum(F.when(~F.col("test"), F.col("n"))).alias("n_train"), F.sum(F.when(F.col("test"), F.col("n"))).alias("n_test"),
                      (F.sum(F.when(F.col("test") & s.isNotNull(), error)) / F.sum(F.when(F.col("test") & s.isNotNull(), n))).alias("brier"),
                      F.count(F.when(F.isnan("s"), 1)).alias("nan"), F.sum(F.when(F.col("test"), F.col("pos"))).alias("pos"),
                      F.sum(F.when(F.col("test"), F.col("neg"))).alias("neg")).first()
    area = auc_of_counts(counts.where("test and s is not null").select(F.lit("auc").alias("g"), "s", "pos", "neg"),
                         (sums["pos"], sums["neg"], sums["nan"]), score_col, label_col)
    return area.select(F.lit(sums["n_train"] or 0).cast("long").alias("n_train"), F.lit(sums["n_test"] or 0).cast("long").alias("n_test"),
                       "auc", F.lit(sums["brier"]).cast("double").alias("brier"))


def fitted(df: DataFrame, features=FEATURES, *, label_col: str = "default_12m") -> tuple[Logistic, DataFrame]:
    """K1, K2 — the model of the training rows and the split table (written once)."""
    split = split_table(df, features, label_col=label_col)
    return fit_logistic(split.where(F.col("split") == "train"), features, label_col=label_col), split


def pd_backtest(df: DataFrame, features=FEATURES, *, label_col: str = "default_12m") -> DataFrame:
    """K1–K5 end to end: one row ``n_train, n_test, auc, brier`` (out of sample)."""
    model, split = fitted(df, features, label_col=label_col)
    return metrics(logistic_score(split, model), label_col=label_col)
