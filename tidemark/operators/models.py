"""Per-symbol training, scoring and evaluation with pluggable models.

A model is fitted from samples (see ``sequences.make_windows``) and scored in Arrow batches. No
step gathers a symbol in one place: the built-in ridge model is solved from sums, a custom model is
fitted in parts whose states are merged (``MergeableFit``), and a plain ``fit_fn`` sees bounded shards of a symbol
whose parameters are averaged by sample count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.joins import lookup_join, null_safe_join
from tidemark.operators.metrics import window_errors
from tidemark.session import settle

# ({lane: array[batch, rows, columns]}, params per row, pred) -> forecast[batch, pred, features]
ScoreFn = Callable[[Mapping[str, np.ndarray], Sequence[np.ndarray], int], np.ndarray]
# samples of one shard -> parameter vector
FitFn = Callable[[pd.DataFrame], np.ndarray]

HORIZON = T.ArrayType(T.ArrayType(T.DoubleType()))


def seasonal_naive(x: Column, seq: int, pred: int, period: int = 1) -> Column:
    """Repeat the last ``period`` rows of the input over the horizon."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(pred - 1)),
        lambda k: F.transform(F.element_at(x, (k % period + (seq - period + 1)).cast("int")), _double),
    )


def _double(v: Column) -> Column:
    return v.cast("double")


def predict_naive(samples: DataFrame, seq: int, pred: int, period: int = 1) -> DataFrame:
    """Samples with a ``horizon`` column from the seasonal-naive model; needs no training."""
    return samples.withColumn("horizon", seasonal_naive(F.col("x"), seq, pred, period))


# --- ridge autoregression from sums -----------------------------------------------------------


def _gram_names(lags: int) -> list[tuple[str, int, int]]:
    size = lags + 2  # intercept, lags, target
    return [(f"g_{i}_{j}", i, j) for i in range(size) for j in range(i, size)]


def ridge_sums(samples: DataFrame, keys: Sequence[str], seq: int, lags: int) -> DataFrame:
    """Per key and feature the sums of products of (1, last ``lags`` values, next value), and ``n``: all that a ridge
    model of any penalty needs, in one partial + final aggregate. Sums of parts of the samples may be added up.

    A sample takes part in a feature where all its values are there.
    """
    if lags > seq:
        raise ValueError("lags must not exceed seq")
    recent = F.slice("x", seq - lags + 1, lags)
    cells = samples.select(
        *keys,
        recent.alias("_recent"),
        F.posexplode(F.col("y")[0]).alias("feature", "_target"),
    ).select(
        *keys,
        "feature",
        F.lit(1.0).alias("v0"),
        *[F.col("_recent")[i][F.col("feature")].cast("double").alias(f"v{i + 1}") for i in range(lags)],
        F.col("_target").cast("double").alias(f"v{lags + 1}"),
    )
    whole = reduce(and_, [F.col(f"v{i}").isNotNull() for i in range(1, lags + 2)])
    return cells.withColumn("_whole", whole).groupBy(*keys, "feature").agg(
        F.count_if("_whole").alias("n"),
        *[F.coalesce(F.sum(F.when(F.col("_whole"), F.col(f"v{i}") * F.col(f"v{j}"))), F.lit(0.0)).alias(name)
          for name, i, j in _gram_names(lags)],
    )


def solve_ridge(sums: DataFrame, keys: Sequence[str], lags: int, alpha: float) -> DataFrame:
    """Model table (keys, n, params, error) from ``ridge_sums``: a (lags + 1)-sized system per key and feature, solved
    in batches, one row each."""
    names = _gram_names(lags)
    key_fields = [sums.schema[k] for k in keys]
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("feature", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
            T.StructField("error", T.StringType()),
        ]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            full = np.zeros((len(batch), lags + 2, lags + 2))
            for name, i, j in names:
                full[:, i, j] = full[:, j, i] = batch[name]
            system = full[:, :-1, :-1] + alpha * np.eye(lags + 1)
            solutions = [_solution(a, b, n) for a, b, n in zip(system, full[:, :-1, -1], batch["n"])]
            out = batch[[*keys, "feature", "n"]].copy()
            out["weights"] = [weights for weights, _ in solutions]
            out["error"] = [error for _, error in solutions]
            yield out

    solved = sums.mapInPandas(solve, schema)
    rows = F.sort_array(F.collect_list(F.struct("feature", "weights")))
    return solved.groupBy(*keys).agg(
        F.max("n").alias("n"), rows.alias("_w"), F.max("error").alias("error")
    ).select(*keys, "n", F.when(F.col("error").isNull(), F.flatten("_w.weights")).alias("params"), "error")


def fit_ridge(
    samples: DataFrame, keys: Sequence[str], seq: int, lags: int = 4, alpha: float = 1e-3
) -> DataFrame:
    """Model table (keys, n, params, error): one linear autoregression per key and feature.

    The samples are read once, for ``ridge_sums``. A key with a feature that has no sample with all values, or
    whose system has no solution, has NULL params and the error text.
    """
    return solve_ridge(ridge_sums(samples, keys, seq, lags), keys, lags, alpha)


def _solution(system: np.ndarray, target: np.ndarray, n: int) -> tuple[np.ndarray | None, str | None]:
    if not n:
        return None, "no sample has all values"
    try:
        return np.linalg.solve(system, target), None
    except np.linalg.LinAlgError as failure:
        return None, f"{type(failure).__name__}: {failure}"


def ridge_score(lags: int) -> ScoreFn:
    """Scoring function of ``fit_ridge``: feed each forecast back as the newest value."""

    def score(lanes: Mapping[str, np.ndarray], params: Sequence[np.ndarray], pred: int) -> np.ndarray:
        x = lanes["x"]
        rows, _, features = x.shape
        weights = np.stack([np.asarray(p, dtype=float) for p in params]).reshape(rows, features, lags + 1)
        recent = np.swapaxes(x[:, -lags:, :].astype(float), 1, 2)
        out = np.empty((rows, pred, features))
        for step in range(pred):
            value = weights[:, :, 0] + (weights[:, :, 1:] * recent).sum(axis=2)
            out[:, step, :] = value
            recent = np.concatenate([recent[:, :, 1:], value[:, :, None]], axis=2)
        return out

    return score


# --- pluggable training -----------------------------------------------------------------------


def train_per_symbol(
    samples: DataFrame, fit_fn: FitFn, keys: Sequence[str], shard_samples: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Model table (keys, n, params, error) from a user function.

    ``fit_fn`` gets the samples of one shard: ``shard_samples`` consecutive sample ids of one key,
    to be chosen so that they fit in a worker's memory. ``columns`` names what it reads besides
    the keys and the sample id (default: all); only that is sent to Python.
    The parameter vectors of a key's shards are averaged, weighted by sample count, which is another
    model than one fit over all samples; so the caller says how large a shard is. A key with a failing
    shard has NULL params and the error text, and the other keys are not affected.
    """
    if columns is not None:
        samples = samples.select(*dict.fromkeys([*keys, "sample_id", *columns]))
    given = list(samples.columns)
    key_fields = [samples.schema[k] for k in keys]
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("n", T.LongType()),
            T.StructField("params", T.ArrayType(T.DoubleType())),
            T.StructField("error", T.StringType()),
        ]
    )

    def fit_shard(shard: pd.DataFrame) -> pd.DataFrame:
        out = {k: [shard[k].iloc[0]] for k in keys}
        try:
            params, error = np.asarray(fit_fn(shard[given]), dtype=float).ravel(), None
        except Exception as failure:  # one symbol's failure must not stop the others
            params, error = None, f"{type(failure).__name__}: {failure}"
        return pd.DataFrame({**out, "n": [len(shard)], "params": [params], "error": [error]})

    sharded = samples.withColumn("_shard", F.floor(F.col("sample_id") / F.lit(shard_samples)))
    fitted = sharded.groupBy(*keys, "_shard").applyInPandas(fit_shard, schema)
    values = fitted.select(*keys, "n", "error", F.posexplode_outer("params").alias("_i", "_value"))
    averaged = values.groupBy(*keys, "_i").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum(F.col("_value") * F.col("n")), F.sum("n")).alias("_value"),
        F.min("error").alias("error"),
    )
    entries = F.sort_array(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "_value"))))
    return averaged.groupBy(*keys).agg(
        F.max("n").alias("n"), entries.alias("_entries"), F.min("error").alias("error")
    ).select(
        *keys,
        "n",
        F.when((F.size("_entries") > 0) & F.col("error").isNull(), F.col("_entries._value")).alias("params"),
        "error",
    )


@dataclass(frozen=True)
class MergeableFit:
    """A model that is fitted in parts: ``state`` of a part of a key's samples, ``merge`` of two states, and
    ``finish``, the parameters of a state. States are vectors of one length; merging must not depend on the order."""

    state: Callable[[pd.DataFrame], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray]
    finish: Callable[[np.ndarray], np.ndarray]


def fit_mergeable(
    samples: DataFrame, fit: MergeableFit, keys: Sequence[str], columns: Sequence[str] | None = None, spread: int = 256,
) -> DataFrame:
    """Model table (keys, n, params, error) of a fit whose parts can be merged: the model over all samples of a
    key, however they are cut.

    States are made batch by batch and merged within the task before anything is shuffled, then in
    ``spread`` groups per key, then per key; a key with a third of all samples sends one state per task. A
    failing part or merge leaves NULL params and the error text, and stops no other key.
    """
    if columns is not None:
        samples = samples.select(*dict.fromkeys([*keys, *columns]))
    key_fields = [samples.schema[k] for k in keys]
    part = [T.StructField("n", T.LongType()), T.StructField("state", T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())]
    bare = T.StructType([*key_fields, *part])
    given = list(samples.columns)

    def add(held: tuple | None, n: int, state, error: str | None) -> tuple:
        try:
            if held is None or error or held[2]:
                return (n + (held[0] if held else 0), state if not error else None, (held and held[2]) or error)
            return held[0] + n, fit.merge(held[1], state), None
        except Exception as failure:  # one key's failure must not stop the others
            return held[0] + n, None, f"{type(failure).__name__}: {failure}"

    def table(held: dict) -> pd.DataFrame:
        rows = [(*key, n, None if error else np.asarray(state, dtype=float).ravel(), error) for key, (n, state, error) in held.items()]
        return pd.DataFrame(rows, columns=bare.fieldNames()).astype({"n": "int64"}) if rows else pd.DataFrame(columns=bare.fieldNames())

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, rows in batch.groupby(list(keys), sort=False, dropna=False):
                key = tuple(None if v != v else v for v in key)
                try:
                    state, error = fit.state(rows[given].reset_index(drop=True)), None
                except Exception as failure:
                    state, error = None, f"{type(failure).__name__}: {failure}"
                held[key] = add(held.get(key), len(rows), state, error)
            if len(held) > 10_000:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        held = None
        for n, state, error in zip(rows["n"], rows["state"], rows["error"]):
            held = add(held, int(n), state, error)
        return table({tuple(None if rows[k].iloc[0] != rows[k].iloc[0] else rows[k].iloc[0] for k in keys): held})

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[*keys, "n"]].copy()
            solved = []
            for state, error in zip(batch["state"], batch["error"]):
                try:
                    solved.append((np.asarray(fit.finish(np.asarray(state)), dtype=float).ravel(), None) if error is None else (None, error))
                except Exception as failure:
                    solved.append((None, f"{type(failure).__name__}: {failure}"))
            out["params"], out["error"] = [p for p, _ in solved], [e for _, e in solved]
            yield out

    states = samples.mapInPandas(parts, bare)
    group = F.pmod(F.spark_partition_id(), F.lit(spread)).alias("_group")
    some = states.select("*", group).groupBy(*keys, "_group").applyInPandas(merged, bare)
    params = T.StructType([*key_fields, part[0], T.StructField("params", T.ArrayType(T.DoubleType())), part[2]])
    return some.groupBy(*keys).applyInPandas(merged, bare).mapInPandas(finished, params)


LANES = ("x", "x_mark", "x_dec", "x_mark_dec")


def predict_per_symbol(
    samples: DataFrame,
    models: DataFrame,
    score_fn: ScoreFn,
    keys: Sequence[str],
    pred: int,
    inputs: Sequence[str] = ("x",),
) -> DataFrame:
    """Samples with a ``horizon`` column in place of their input lanes (runs jobs to size the
    model lookup).

    Only the lanes named by ``inputs`` reach Python, flattened to one array per row. Samples of a
    key without usable parameters are left out. Rows whose model raises have a NULL horizon; models
    with parameters of another length are scored apart, so no key stops another.
    """
    kept = [f for f in samples.schema.fields if f.name not in LANES]
    lanes = {name: f"_{name}" for name in inputs}
    flat = samples.select(
        *[f.name for f in kept],
        *[F.flatten(name).alias(column) for name, column in lanes.items()],
        *[F.size(name).alias(f"{column}_rows") for name, column in lanes.items()],
    )
    joined = lookup_join(flat, models.select(*keys, "params"), keys, how="inner")
    usable = joined.filter(F.col("params").isNotNull())
    schema = T.StructType([*kept, T.StructField("horizon", HORIZON)])

    def scored(rows: pd.DataFrame) -> list:
        arrays = {
            name: np.stack(rows[column]).reshape(len(rows), int(rows[f"{column}_rows"].iloc[0]), -1)
            for name, column in lanes.items()
        }
        forecast = np.asarray(score_fn(arrays, rows["params"].tolist(), pred), dtype=float)
        return [list(steps) for steps in forecast]

    def forecasts(rows: pd.DataFrame) -> list:
        try:
            return scored(rows)
        except Exception:  # some model fails: find out which, row by row
            if len(rows) == 1:
                return [None]
            return [h for k in range(len(rows)) for h in forecasts(rows.iloc[k:k + 1])]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            shapes = [batch["params"].map(len), *[batch[c].map(len) for c in lanes.values()]]
            for _, alike in batch.groupby(shapes, sort=False):
                out = alike[[f.name for f in kept]].copy()
                out["horizon"] = forecasts(alike)
                yield out

    return usable.mapInPandas(score, schema)


@dataclass(frozen=True)
class Candidate:
    """A trainable model: ``fit(samples) -> model table`` and its scoring function. Candidates with one ``prepare``
    share its result, made once and written, which ``fit`` then gets in place of the samples."""

    fit: Callable[[DataFrame], DataFrame]
    score: ScoreFn
    prepare: Callable[[DataFrame], DataFrame] | None = None


def ridge_candidates(
    alphas: Mapping[str, float], keys: Sequence[str], seq: int, lags: int = 4
) -> dict[str, Candidate]:
    """Ridge models of several penalties, all solved from one set of sums."""

    def prepare(samples: DataFrame) -> DataFrame:
        return ridge_sums(samples, keys, seq, lags)

    return {
        name: Candidate(lambda sums, a=alpha: solve_ridge(sums, keys, lags, a), ridge_score(lags), prepare)
        for name, alpha in alphas.items()
    }


def evaluate(
    samples: DataFrame, models: DataFrame, score_fn: ScoreFn, keys: Sequence[str], pred: int
) -> DataFrame:
    """Mean squared error per key of the model table over ``samples``; 0.0 without samples."""
    scored = predict_per_symbol(samples, models, score_fn, keys, pred)
    errors = window_errors(scored, keys)
    delta = F.col("pred") - F.col("true")
    losses = errors.groupBy(*keys).agg(F.avg(delta * delta).alias("_loss"))
    return models.join(losses, list(keys), "left").select(
        *models.columns, F.coalesce("_loss", F.lit(0.0)).alias("val_loss")
    )


def _losses(
    samples: DataFrame, tables: DataFrame, scores: Mapping[str, ScoreFn], keys: Sequence[str], pred: int
) -> DataFrame:
    """Per key and model the mean squared error over ``samples``, all models scored in one pass. Cells without a
    value, and rows that a model cannot score, do not count."""
    flat = samples.select(
        *keys, F.flatten("x").alias("_x"), F.size("x").alias("_rows"), F.flatten(F.slice("y", 1, pred)).alias("_y"))
    usable = tables.filter(F.col("params").isNotNull())
    wide = usable.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("model", "params"))).alias("_models"))
    joined = lookup_join(flat, wide, keys, how="inner")
    schema = T.StructType([*[samples.schema[k] for k in keys], T.StructField("model", T.StringType()),
                           T.StructField("_sum", T.DoubleType()), T.StructField("_cells", T.LongType())])

    def squares(rows: pd.DataFrame, name: str) -> list[tuple[float, int]]:
        try:
            x = np.stack(rows["_x"]).reshape(len(rows), int(rows["_rows"].iloc[0]), -1)
            params = [dict(m)[name] for m in rows["_models"]]
            forecast = np.asarray(scores[name]({"x": x}, params, pred), dtype=float).reshape(len(rows), -1)
            delta = forecast - np.stack([np.asarray(y, dtype=float) for y in rows["_y"]])
            known = ~np.isnan(delta)
            return list(zip(np.where(known, delta * delta, 0.0).sum(axis=1), known.sum(axis=1)))
        except Exception:  # some row fails: find out which
            if len(rows) == 1:
                return [(0.0, 0)]
            return [s for k in range(len(rows)) for s in squares(rows.iloc[k:k + 1], name)]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in scores:
                own = batch[[name in dict(m) for m in batch["_models"]]]
                if own.empty:
                    continue
                shapes = [own["_x"].map(len), own["_y"].map(len), own["_models"].map(lambda m: len(dict(m)[name]))]
                for _, alike in own.groupby(shapes, sort=False):
                    out = alike[list(keys)].copy()
                    out["model"] = name
                    found = squares(alike, name)
                    out["_sum"], out["_cells"] = [float(s) for s, _ in found], [int(n) for _, n in found]
                    yield out

    sums = joined.mapInPandas(score, schema).groupBy(*keys, "model").agg(F.sum("_sum").alias("_sum"), F.sum("_cells").alias("_cells"))
    return sums.select(*keys, "model", F.try_divide("_sum", "_cells").alias("val_loss"))


def train_best(
    train: DataFrame, val: DataFrame, candidates: Mapping[str, Candidate], keys: Sequence[str], pred: int
) -> DataFrame:
    """The candidate with the smallest validation loss per key: (keys, model, n, params, error,
    val_loss) (runs jobs). A candidate that failed for a key loses to any that did not; a loss without validation
    samples is 0.0. What candidates share is made once, and the validation samples are read once for all."""
    prepared: dict[Callable, DataFrame] = {}
    tables = None
    for name, candidate in candidates.items():
        if candidate.prepare is not None and candidate.prepare not in prepared:
            prepared[candidate.prepare] = settle(candidate.prepare(train))
        fitted = candidate.fit(prepared[candidate.prepare] if candidate.prepare else train).withColumn("model", F.lit(name))
        tables = fitted if tables is None else tables.unionByName(fitted)
    tables = settle(tables)
    losses = _losses(val, tables, {name: c.score for name, c in candidates.items()}, keys, pred)
    known = null_safe_join(tables, losses, [*keys, "model"], "left").withColumn("val_loss", F.coalesce("val_loss", F.lit(0.0)))
    rank = F.struct(F.col("params").isNull(), "val_loss", "model")
    row = F.struct("model", "n", "params", "error", "val_loss")
    return known.groupBy(*keys).agg(F.min_by(row, rank).alias("_best")).select(*keys, "_best.*")
