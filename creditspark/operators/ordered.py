"""Exact order statistics without a single-task global sort.

Two tools, each with one plan at every size:

* :func:`prefix_sums` — for each value, sums over the rows strictly below it. Rows
  are first collapsed to one per distinct (group, value), a hash aggregate with
  map-side combine, so a value repeated on a third of all rows becomes one row
  per map task. The counts are range-partitioned by (group, value); each range
  is summed by a window of its own and shifted by the totals of the ranges
  before it, a table of one row per range and group (broadcast: it is bounded by
  the number of shuffle partitions plus groups).
* :func:`exact_ranks` — the k-th smallest values of several columns. Each rank is
  bracketed, by mergeable KLL sketches (:func:`column_states`) that the caller
  keeps or by one wide ``percentile_approx`` aggregate; one further pass counts the
  rows below each bracket (as observed metrics) and collapses only the values inside it
  (a small part of the rows), which are summed by prefix to find the rank.

Tables that are read twice go through ``checkpoint`` (reliable storage under
``spark.checkpoint.dir``), so the expensive upstream runs once and a lost
executor does not re-run it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# relative accuracy of the brackets: a rank is sought within 2·N/ACCURACY ranks either side
ACCURACY = 10_000
# size of the KLL sketches, and how far from a rank (as a share of all) its bracket reaches: a multiple of their error
SKETCH_K, SKETCH_MARGIN = 2048, 0.004


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the session's checkpoint folder and cut its lineage."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def prefix_sums(vc: DataFrame, group_col: str, value_col: str, sum_cols: list[str],
                buckets: int | None = None) -> DataFrame:
    """Add ``<c>_before`` = Σ c over rows of the same group with a smaller value.

    ``vc`` must have one row per (group, value) and be cheap to read twice
    (checkpointed): Spark samples it to choose the ranges. ``buckets`` is the
    number of ranges (default: the session's shuffle partitions).
    """
    keys = [group_col, value_col]
    ranged = vc.repartitionByRange(buckets, *keys) if buckets else vc.repartitionByRange(*keys)
    ranged = checkpointed(ranged.withColumn("_range", F.spark_partition_id()))
    w = (Window.partitionBy("_range", group_col).orderBy(value_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    within = ranged.withColumns({f"_{c}_in": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols})
    totals = ranged.groupBy(group_col, "_range").agg(*[F.sum(c).alias(f"_{c}_tot") for c in sum_cols])
    wo = Window.partitionBy(group_col).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group_col, "_range", *[
        F.coalesce(F.sum(f"_{c}_tot").over(wo), F.lit(0)).alias(f"_{c}_off") for c in sum_cols])
    out = within.join(F.broadcast(offsets), [group_col, "_range"], "inner")
    out = out.withColumns({f"{c}_before": F.col(f"_{c}_off") + F.col(f"_{c}_in") for c in sum_cols})
    return out.drop("_range", *[f"_{c}_in" for c in sum_cols], *[f"_{c}_off" for c in sum_cols])


def number(c: str | Column) -> Column:
    """A column as double, NaN as NULL."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(v), v)


def column_states(df: DataFrame, cols: Sequence[str], by: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """Mergeable state of each column, one row for each value of ``by`` (a bounded key such as the booking year).

    ``n_<c>, mean_<c>, m2_<c>, min_<c>, max_<c>`` and ``sketch_<c>``, a KLL sketch of its
    values. One pass; a new part of the book adds its rows, the others stay as they are.
    """
    keys = [by] if by else []
    values = df.select(*keys, *[number(c).alias(f"v_{c}") for c in cols])
    aggs = []
    for c in cols:
        v = f"v_{c}"
        aggs += [F.count(v).alias(f"n_{c}"), F.avg(v).alias(f"mean_{c}"), (F.var_pop(v) * F.count(v)).alias(f"m2_{c}"),
                 F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}"),
                 F.kll_sketch_agg_double(F.col(v), F.lit(k)).alias(f"sketch_{c}")]
    return values.groupBy(*keys).agg(*aggs)


def merged_states(states: DataFrame, cols: Sequence[str], shares: Mapping[str, Sequence[float]] | None = None) -> dict[str, dict]:
    """``{c: n, mean, std, min, max, at}`` of all rows behind ``states``; ``at``: about the quantiles at ``shares[c]``."""
    aggs = []
    for c in cols:
        n, mean = F.col(f"n_{c}"), F.col(f"mean_{c}")
        aggs += [F.sum(n).alias(f"n_{c}"), (F.sum(n * mean) / F.sum(n)).alias(f"mean_{c}"),
                 F.collect_list(F.struct(n.alias("n"), mean.alias("mean"), F.col(f"m2_{c}").alias("m2"))).alias(f"parts_{c}"),
                 F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}"),
                 F.kll_merge_agg_double(f"sketch_{c}").alias(f"sketch_{c}")]
    one = states.agg(*aggs)
    keep = []
    for c in cols:
        keep += [f"n_{c}", f"mean_{c}", f"min_{c}", f"max_{c}", f"parts_{c}"]
        at = F.lit(None).cast("array<double>")
        if shares and shares.get(c):
            cut = F.array(*[F.lit(min(1.0, max(0.0, float(x)))) for x in shares[c]])
            at = F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(F.col(f"sketch_{c}"), cut))
        keep.append(at.alias(f"at_{c}"))
    row = one.select(*keep).first()
    out = {}
    for c in cols:
        n, mean = row[f"n_{c}"] or 0, row[f"mean_{c}"]
        m2 = math.fsum(p["m2"] + p["n"] * (p["mean"] - mean) ** 2 for p in row[f"parts_{c}"] if p["n"])
        out[c] = {"n": n, "mean": mean, "std": math.sqrt(m2 / (n - 1)) if n > 1 else None, "min": row[f"min_{c}"],
                  "max": row[f"max_{c}"], "at": row[f"at_{c}"]}
    return out


def exact_ranks(df: DataFrame, columns: Mapping[str, str | Column], ranks: Mapping[str, Sequence[int]],
                counts: Mapping[str, int], *, accuracy: int = ACCURACY, buckets: int | None = None,
                brackets: Mapping[tuple[str, int], tuple[float, float]] | None = None) -> dict[str, dict[int, float]]:
    """``{name: {k: the k-th smallest value, from 0}}``; NULL and NaN are ignored.

    ``counts`` holds the number of values per name, as the caller's own aggregate
    found it, and ``brackets`` values between which the ranks are expected. One pass
    over ``df`` with brackets, two without. If a bracket misses its rank, it is widened and
    the passes repeated, so the result is always exact.
    """
    todo = {(n, k) for n, ks in ranks.items() for k in ks if 0 <= k < counts.get(n, 0)}
    values = df.select(*[number(c).alias(n) for n, c in columns.items()])
    found: dict[str, dict[int, float]] = {n: {} for n in ranks}
    margin = 2.0 / accuracy
    given = dict(brackets or {})
    while todo:
        if todo <= given.keys():
            bracket = {t: given[t] for t in todo}
        else:
            bracket = _approximate_brackets(values, todo, counts, margin, accuracy)
        given = {}
        distinct = sorted({(n, *b) for (n, _), b in bracket.items()})
        sums = [F.count(F.col(n)).alias(f"all_{n}") for n in sorted({n for n, _, _ in distinct})]
        for i, (n, lo, hi) in enumerate(distinct):
            sums += [F.count(F.when(F.col(n) < lo, 1)).alias(f"lt{i}"), F.count(F.when(F.col(n) <= hi, 1)).alias(f"le{i}")]
        wide = [(i, n, lo, hi) for i, (n, lo, hi) in enumerate(distinct) if lo < hi]
        inside, below = None, None
        if wide:
            each = F.array(*[F.struct(F.lit(i).alias("slice"),
                                      F.when((F.col(n) >= lo) & (F.col(n) <= hi), F.col(n)).alias("v"))
                             for i, n, lo, hi in wide])
            seen = Observation()
            rows = values.observe(seen, *sums).select(F.explode(F.filter(each, lambda s: s["v"].isNotNull())).alias("s")).select("s.*")
            inside = checkpointed(rows.groupBy("slice", "v").agg(F.count(F.lit(1)).alias("n")))
            below = _observed(seen)
        # a task that ran twice may be observed twice; then (and without a slice) an aggregate of its own counts
        if not below or any(below.get(f"all_{n}") != counts[n] for n, _, _ in distinct):
            below = values.agg(*sums).first().asDict()
        targets, missed = [], set()
        for n, k in sorted(todo):
            i = distinct.index((n, *bracket[n, k]))
            lo, hi = bracket[n, k]
            if not below[f"lt{i}"] <= k < below[f"le{i}"]:
                missed.add((n, k))
            elif lo == hi:
                found[n][k] = lo
            else:
                targets.append((n, k, i, k - below[f"lt{i}"]))
        if targets:
            spark = df.sparkSession
            want = spark.createDataFrame(targets, "name string, k long, slice int, at long")
            placed = prefix_sums(inside, "slice", "v", ["n"], buckets).join(F.broadcast(want), "slice")
            for r in placed.where("at >= n_before and at < n_before + n").select("name", "k", "v").collect():
                found[r["name"]][r["k"]] = r["v"]
        todo, margin = missed, margin * 16
    return found


def _observed(seen: Observation) -> dict | None:
    """The observed metrics; None if the adaptive planner dropped them with a part of the plan found to be empty."""
    from py4j.protocol import Py4JJavaError

    try:
        return seen.get
    except Py4JJavaError:
        return None


def _approximate_brackets(values: DataFrame, todo: set, counts: Mapping[str, int], margin: float, accuracy: int) -> dict:
    """``{(name, k): (low, high)}`` from one aggregate; the whole range once ``margin`` is 1."""
    names = sorted({n for n, _ in todo})
    order = {n: sorted(k for m, k in todo if m == n) for n in names}
    cuts = {n: [min(1.0, max(0.0, k / max(counts[n] - 1, 1) + s * margin)) for k in order[n] for s in (-1, 1)] for n in names}
    got = values.agg(*[F.percentile_approx(n, cuts[n], accuracy).alias(n) for n in names]).first()
    out = {}
    for n in names:
        for i, k in enumerate(order[n]):
            out[n, k] = (-math.inf, math.inf) if margin >= 1 else (got[n][2 * i], got[n][2 * i + 1])
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75), *, counts: Mapping[str, int] | None = None,
                    buckets: int | None = None, near: Mapping[str, Sequence[float]] | None = None) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column (NumPy "linear", DuckDB ``quantile_cont``).

    ``near[c]``: values a little below and above each quantile in turn, as sketches give them (saves a pass).
    """
    if counts is None:
        counts = df.agg(*[F.count(number(c)).alias(c) for c in cols]).first().asDict()
    at = {c: [float(p) * (counts[c] - 1) for p in probs] for c in cols}
    ranks = {c: sorted({f(x) for x in at[c] if counts[c] for f in (math.floor, math.ceil)}) for c in cols}
    brackets = None
    if near:
        brackets = {(c, f(x)): (near[c][2 * i], near[c][2 * i + 1])
                    for c in cols if counts[c] for i, x in enumerate(at[c]) for f in (math.floor, math.ceil)}
    values = exact_ranks(df, {c: c for c in cols}, ranks, counts, buckets=buckets, brackets=brackets)

    def between(c: str, x: float) -> float:
        lo, hi = values[c][math.floor(x)], values[c][math.ceil(x)]
        return lo + (hi - lo) * (x - math.floor(x))

    return {c: [between(c, x) if counts[c] else None for x in at[c]] for c in cols}
