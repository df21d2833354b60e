from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import metrics as met, models as mod, positions as pos, scaling as sc, sequences as seqs
from tidemark.operators.selection import dedup
from tidemark.plans import forecasting as fc
from tidemark.schemas import FeatureSpec
from tidemark.session import settle

T0 = datetime(2024, 2, 27, 23, 59, 50)


@pytest.fixture(scope="module")
def series(spark):
    """One long series and two short ones, values unlike their positions."""
    rows = [(s, T0 + timedelta(seconds=i), float((i * 37) % 101), float(i))
            for s, n in (("long", 400), ("short", 30), ("tiny", 5)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, event_time timestamp, v double, i double").orderBy(F.rand(1))


@pytest.fixture(scope="module")
def placed(series):
    return pos.with_position(series, ["symbol"], ["event_time"], length="series_length", partitions=7)


def brute(n, seq, pred):
    return {i: ([float((j * 37) % 101) for j in range(i, i + seq)],
                [float((j * 37) % 101) for j in range(i + seq, i + seq + pred)]) for i in range(n - seq - pred + 1)}


def test_positions(placed):
    rows = placed.collect()
    assert all(r.position == r.i for r in rows)
    assert {(r.symbol, r.series_length) for r in rows} == {("long", 400), ("short", 30), ("tiny", 5)}


def test_positions_with_null_key_and_equal_times(spark):
    rows = spark.createDataFrame([(None, T0, k) for k in range(20)] + [("a", T0, k) for k in range(20)],
                                 "symbol string, event_time timestamp, tie int")
    placed = pos.with_position(rows, ["symbol"], ["event_time", "tie"], partitions=6)
    assert placed.count() == 40 and placed.filter("position <> tie").count() == 0


def repeated(spark):
    rows = [(s, None if i == 3 else T0 + timedelta(seconds=i), None if c == 1 else float(c), i * 10 + c)
            for s in ("a", None) for i in range(40) for c in (3, 1, 2, 2)]
    return spark.createDataFrame(rows, "symbol string, event_time timestamp, v double, i long").orderBy(F.rand(3))


def test_positions_without_copies(spark):
    rows, by = repeated(spark), ["symbol", "event_time"]
    one = pos.with_position(rows, ["symbol"], ["event_time"], length="n", partitions=5, unique=True)
    two = pos.with_position(dedup(rows, by), ["symbol"], ["event_time"], length="n", partitions=3)
    key = lambda r: str(tuple(r))
    assert sorted(one.collect(), key=key) == sorted(two.collect(), key=key)
    assert {r.n for r in one.collect()} == {40} and one.count() == 80


def test_copies_fall_out_in_the_range_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(pos, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    rows, spec = repeated(spark), FeatureSpec(keys=("symbol",), time_column="event_time", features=("v", "i"))
    placed = fc.placed_features(rows, spec)
    assert plans[0].count("Exchange rangepartitioning") == 1 and plans[0].count("Exchange ") == 1
    assert plans[0].count("Sort [") == 1 and "Aggregate" not in plans[0]
    monkeypatch.setattr(fc, "HOT_COPIES", 1)
    combined = fc.placed_features(rows, spec)
    assert "SortAggregate" in plans[1] or "HashAggregate" in plans[1]
    key = lambda r: str(tuple(r))
    assert sorted(placed.collect(), key=key) == sorted(combined.collect(), key=key)


def test_position_totals(series):
    placed = pos.with_position(series, ["symbol"], ["event_time"], totals={"hi": ("v", "max"), "s": ("i", "sum")})
    assert {(r.symbol, r.s) for r in placed.select("symbol", "s").distinct().collect()} == {
        ("long", 79800.0), ("short", 435.0), ("tiny", 10.0)}


def test_tasks_are_sized_by_their_windows(spark):
    """Span 720 over one long and two short series: no task writes more than the stated size."""
    rows = spark.range(9_000).select(
        F.when(F.col("id") < 6_000, "hot").when(F.col("id") < 8_000, "b").otherwise("c").alias("symbol"),
        (F.col("id") - F.when(F.col("id") < 6_000, 0).when(F.col("id") < 8_000, 6_000).otherwise(8_000)).alias("position"),
        F.col("id").cast("double").alias("v"))
    samples = seqs.make_windows(rows, ["symbol"], ["v"], ["v"], 600, 120, task_bytes=32 << 20)
    size = 4 * ((600 + 480 + 240) + (600 + 480 + 120))
    assert seqs.window_tasks(rows, size, 1, 32 << 20) == -(-9_000 * size // (8 << 20)) > 4
    one = samples.select(sum(F.size(F.flatten(c) if c != "y" else F.flatten("y")) for c in ("x", "x_mark", "x_dec", "x_mark_dec", "y")))
    assert one.distinct().collect() == [(size // 4,)]
    held = samples.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 5_281 + 1_281 + 281
    assert max(r["count"] for r in held) * size <= 32 << 20
    assert seqs.window_tasks(rows, size, 10**6) == 4  # not fewer than the session's
    assert seqs.block_size(720, size) == 4_096 and seqs.block_size(720, 10**6) == 720


@pytest.mark.parametrize("block", [None, 14, 13, 50])
@pytest.mark.parametrize("stride", [1, 4])
def test_windows_against_brute_force(placed, block, stride):
    samples = seqs.make_windows(placed, ["symbol"], ["v"], ["i"], 10, 4, 6, stride=stride, block=block)
    got = {}
    for r in samples.collect():
        assert r.sample_id * stride == r.start_pos
        assert (r.symbol, r.start_pos) not in got
        got[r.symbol, r.start_pos] = r
    expected = {(s, i): xy for s, n in (("long", 400), ("short", 30)) for i, xy in brute(n, 10, 4).items()
                if i % stride == 0}
    assert got.keys() == expected.keys()
    for key, (x, y) in expected.items():
        r = got[key]
        assert [a[0] for a in r.x] == x and [a[0] for a in r.y] == y
        assert [a[0] for a in r.x_dec] == x[4:] + [0.0] * 4
        assert [a[0] for a in r.x_mark] == [float(j) for j in range(key[1], key[1] + 10)]
        assert [a[0] for a in r.x_mark_dec] == [float(j) for j in range(key[1] + 4, key[1] + 14)]
    index = seqs.windows_index(placed, ["symbol"], 10, 4, stride=stride)
    assert {(r.symbol, r.start_pos) for r in index.collect()} == set(expected)


def test_window_block_too_small(placed):
    with pytest.raises(ValueError):
        seqs.make_windows(placed, ["symbol"], ["v"], ["i"], 10, 4, block=5)


def test_ratio_split_covers_each_series(placed):
    rows = pos.split_ratio(placed).collect()
    sizes = {}
    for r in rows:
        sizes.setdefault((r.symbol, r.split), []).append(r.split_position)
    assert len(sizes[("long", "train")]) == int(400 * 0.7) and len(sizes[("short", "val")]) == int(30 * 0.2)
    assert all(sorted(p) == list(range(len(p))) for p in sizes.values())
    assert sum(len(p) for p in sizes.values()) == 435


def test_calendar_split_repeats_context_rows(placed):
    long = placed.filter("symbol = 'long'")
    rows = pos.split_calendar(long, 1, months=(6, 2, 2), lookback=24).groupBy("split").count().collect()
    assert {(r.split, r["count"]) for r in rows} == {("train", 180), ("val", 84), ("test", 84)}
    rows = pos.split_custom(long, lookback=24).groupBy("split").agg(F.min("position").alias("lo"), F.max(
        "position").alias("hi"), F.min("split_position").alias("p")).collect()
    assert {tuple(r) for r in rows} == {("train", 0, 279, 0), ("val", 256, 319, 0), ("test", 296, 399, 0)}


def test_profile(placed):
    rows = {r.symbol: r for r in pos.series_profile(placed, ["symbol"], 10, 4).collect()}
    assert (rows["short"].samples, rows["short"].enough) == (17, True)
    assert (rows["tiny"].samples, rows["tiny"].enough) == (0, False)


def test_minmax_edge_cases_and_inverse(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 5.0), ("a", 3.0, 5.0), ("a", None, 5.0), ("b", None, 1.0)], "symbol string, x double, c double")
    stats = sc.fit_minmax(rows, ["symbol"], ["x", "c"])
    scaled = [tuple(r) for r in sc.minmax_transform(rows, stats, ["symbol"], ["x", "c"]).collect()]
    assert sorted(scaled, key=str) == sorted(
        [("a", 0.0, 0.0), ("a", 1.0, 0.0), ("a", None, 0.0), ("b", 0.0, 0.0)], key=str)
    back = sc.minmax_inverse(sc.minmax_transform(rows, stats, ["symbol"], ["x"]), stats, ["symbol"], ["x"])
    assert sorted(r.x for r in back.filter("symbol = 'a' and x is not null").collect()) == [1.0, 3.0]


def test_standard_scaler_uses_population_deviation(spark):
    rows = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, c double")
    stats = sc.fit_standard(rows, ["x", "c"])
    assert stats.first().x_std == pytest.approx(np.std([1, 2, 4]))
    scaled = sc.standard_transform(rows, stats, ["x", "c"])
    assert {r.c for r in scaled.collect()} == {None}
    back = sc.standard_inverse(scaled, stats, ["x"])
    assert sorted(r.x for r in back.collect()) == pytest.approx([1.0, 2.0, 4.0])


def test_fit_on_training_rows_only(spark):
    rows = [("a", T0 + timedelta(seconds=i), float(i), float(i), float(i), i) for i in range(10)]
    ticker = spark.createDataFrame(
        rows, "symbol string, event_time timestamp, last_price double, best_bid_price double, "
        "best_ask_price double, trade_count long")
    scaled = {r.position: r.last_price for r in fc.feature_frame(ticker, fit_on="train").collect()}
    assert scaled[6] == 1.0 and scaled[9] == pytest.approx(1.5)
    assert max(r.last_price for r in fc.feature_frame(ticker).collect()) == 1.0
    with pytest.raises(ValueError):
        fc.feature_frame(ticker, fit_on="test")


def test_leap_rule(spark):
    rows = spark.createDataFrame([(datetime(y, 2, 1),) for y in (2023, 2024, 2100)], "t timestamp")
    assert [r[0] for r in rows.select(cal.days_in_month(F.col("t"))).collect()] == [28, 29, 29]


@pytest.mark.parametrize("freq,alias", [("h", "h"), ("15min", "15min"), ("2d", "2D"), ("s", "s"), ("b", "B"),
                                        ("w", "W"), ("m", "ME"), ("q", "QE"), ("y", "YE")])
def test_future_times_match_pandas(spark, freq, alias):
    starts = [datetime(2024, 1, 25, 10, 30) + timedelta(days=d) for d in range(9)]
    frame = spark.createDataFrame([(s, k) for s in starts for k in range(1, 8)], "t timestamp, k int")
    rows = frame.select("t", "k", cal.future_time(F.col("t"), F.col("k"), freq).alias("f")).collect()
    for r in rows:
        assert r.f == pd.date_range(r.t, periods=9, freq=alias)[r.k].to_pydatetime(), (r.t, r.k)


def test_frequencies():
    assert cal.features_for_freq("15min")[0] == "minute_of_hour"
    assert cal.features_for_freq("A") == ()
    for bad in ("n", "fortnight", ""):
        with pytest.raises(ValueError):
            cal.features_for_freq(bad)
    with pytest.raises(ValueError):
        cal.time_marks(F.lit("2024-01-01").cast("timestamp"), "s")


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    p, t = rng.normal(size=(60, 3)), rng.normal(size=(60, 3))
    rows = spark.createDataFrame(
        [(c, float(p[i, c]), float(t[i, c])) for i in range(60) for c in range(3)], "c int, pred double, true double")
    m = met.forecast_metrics(rows).first()
    assert m.mae == pytest.approx(np.abs(p - t).mean()) and m.rmse == pytest.approx(np.sqrt(((p - t) ** 2).mean()))
    assert m.mape == pytest.approx(np.abs((p - t) / t).mean()) and m.mspe == pytest.approx((((p - t) / t) ** 2).mean())
    rse = np.sqrt(((t - p) ** 2).sum()) / np.sqrt(((t - t.mean()) ** 2).sum())
    assert met.metric_rse(rows).first().rse == pytest.approx(rse)
    product = (t - t.mean(0)) * (p - p.mean(0))
    corr = (product.sum(0) / np.sqrt((product ** 2).sum(0))).mean()
    assert met.metric_corr(rows, ["c"]).first()["corr"] == pytest.approx(corr)
    zero = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "pred double, true double")
    assert met.forecast_metrics(zero).first().mape == 0.5


@pytest.fixture(scope="module")
def linear(spark):
    """Two symbols following x[t] = 0.5 x[t-1] + 0.3 x[t-2] + 1, plus two features."""
    rows = []
    for s, start in (("a", 10.0), ("b", -4.0)):
        x = [start, start / 2]
        while len(x) < 60:
            x.append(0.5 * x[-1] + 0.3 * x[-2] + 1)
        rows += [(s, T0 + timedelta(seconds=i), x[i], 2 * x[i]) for i in range(60)]
    frame = spark.createDataFrame(rows, "symbol string, event_time timestamp, f double, g double")
    placed = pos.with_position(frame, ["symbol"], ["event_time"], length="series_length")
    return seqs.make_windows(placed, ["symbol"], ["f", "g"], ["f"], 6, 3, block=16)


def test_ridge_learns_the_recurrence(linear):
    model = mod.fit_ridge(linear, ["symbol"], 6, lags=2, alpha=1e-9)
    for row in model.collect():
        assert row.params == pytest.approx([1, 0.3, 0.5, 2, 0.3, 0.5], abs=1e-3)
    result = fc.backtest(linear, model, mod.ridge_score(2), ["symbol"], 3)
    assert result.first().mae < 1e-4


def test_pluggable_model_shards_and_failures(linear):
    def fit(shard):
        if shard["symbol"].iloc[0] == "b":
            raise ZeroDivisionError("no luck")
        return [float(len(shard)), 1.0]

    models = {r.symbol: r for r in mod.train_per_symbol(linear, fit, ["symbol"], shard_samples=20).collect()}
    assert models["a"].params == pytest.approx([(20 * 20 + 20 * 20 + 12 * 12) / 52, 1.0]) and models["a"].n == 52
    assert models["b"].params is None and "no luck" in models["b"].error

    table = mod.train_per_symbol(linear, fit, ["symbol"], shard_samples=2_000)
    losses = mod.evaluate(linear, table, lambda lanes, params, pred: lanes["x"][:, -pred:, :], ["symbol"], 3)
    by = {r.symbol: r.val_loss for r in losses.collect()}
    assert by["a"] > 0 and by["b"] == 0.0


def test_a_failing_shard_fails_its_key(linear):
    def fit(shard):
        if shard["symbol"].iloc[0] == "a" and shard["sample_id"].min() > 0:
            raise ValueError("second shard")
        return [1.0]

    models = {r.symbol: r for r in mod.train_per_symbol(linear, fit, ["symbol"], shard_samples=20).collect()}
    assert models["a"].params is None and "second shard" in models["a"].error
    assert models["b"].params == [1.0] and models["b"].error is None


def test_ridge_leaves_incomplete_samples_out(spark):
    rows = [(s, k, [[None if k % 3 == 0 and s == "a" else float(k)]], [[float(k + 1)]]) for s in "ab" for k in range(30)]
    rows += [("none", k, [[None]], [[1.0]]) for k in range(3)] + [("one", k, [[2.0]], [[3.0]]) for k in range(5)]
    samples = spark.createDataFrame(rows, "symbol string, sample_id long, x array<array<double>>, y array<array<double>>")
    found = {r.symbol: r for r in mod.fit_ridge(samples, ["symbol"], 1, lags=1, alpha=0.0).collect()}
    for symbol, n in (("a", 20), ("b", 30)):
        assert found[symbol].params == pytest.approx([1.0, 1.0]) and found[symbol].n == n and found[symbol].error is None
    assert found["none"].params is None and "all values" in found["none"].error
    assert found["one"].params is None and "Singular" in found["one"].error


def test_one_model_does_not_stop_another(spark):
    rows = [(s, k, [[float(k)]]) for s in "abc" for k in range(4)]
    samples = spark.createDataFrame(rows, "symbol string, sample_id long, x array<array<double>>")
    models = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0]), ("c", [-1.0])], "symbol string, params array<double>")

    def score(lanes, params, pred):
        assert len({len(p) for p in params}) == 1
        if any(p[0] < 0 for p in params):
            raise ValueError("negative")
        return lanes["x"] * np.array([len(p) for p in params])[:, None, None]

    found = mod.predict_per_symbol(samples, models, score, ["symbol"], 1).collect()
    by = {(r.symbol, r.sample_id): r.horizon for r in found}
    assert len(by) == 12 and by["a", 3] == [[3.0]] and by["b", 3] == [[6.0]] and by["c", 3] is None


def test_best_candidate_wins(linear):
    candidates = {
        "good": mod.Candidate(lambda s: mod.fit_ridge(s, ["symbol"], 6, 2, 1e-9), mod.ridge_score(2)),
        "heavy": mod.Candidate(lambda s: mod.fit_ridge(s, ["symbol"], 6, 2, 1e4), mod.ridge_score(2)),
    }
    best = mod.train_best(linear, linear, candidates, ["symbol"], 3).collect()
    assert {r.model for r in best} == {"good"} and len(best) == 2


def test_seasonal_naive(linear):
    row = mod.predict_naive(linear, 6, 3, period=2).filter("symbol = 'a' and sample_id = 0").first()
    assert [h[0] for h in row.horizon] == pytest.approx([row.x[4][0], row.x[5][0], row.x[4][0]])


def test_all_lanes_reach_the_model(linear):
    model = mod.train_per_symbol(linear, lambda shard: [0.0], ["symbol"], shard_samples=2_000)
    shapes = {"x": (6, 2), "x_mark": (6, 1), "x_dec": (6, 2), "x_mark_dec": (6, 1)}

    def score(lanes, params, pred):
        assert {k: v.shape[1:] for k, v in lanes.items()} == shapes
        return lanes["x"][:, :pred, :]

    assert mod.predict_per_symbol(linear, model, score, ["symbol"], 3, inputs=mod.LANES).count() == 104


def test_shuffle_is_a_permutation_and_batches_drop_the_rest(linear):
    index = linear.select("symbol", "sample_id", "start_pos")
    shuffled = seqs.shuffle_samples(index, ["symbol"], 3)
    ids = [r.sample_id for r in shuffled.filter("symbol = 'a'").orderBy("start_pos").collect()]
    assert sorted(ids) == list(range(52)) and ids != list(range(52))
    assert ids == [r.sample_id for r in seqs.shuffle_samples(index, ["symbol"], 3).filter("symbol = 'a'").orderBy(
        "start_pos").collect()]
    assert seqs.with_batch_id(index, ["symbol"], 10).count() == 100
    assert seqs.with_batch_id(index, ["symbol"], 10, drop_last=False).count() == 104


def test_feature_modes(spark):
    rows = spark.createDataFrame([(T0, 1.0, 2.0, 3.0)], "date timestamp, target double, a double, b double")
    assert seqs.feature_mode(rows, "M", "target").columns == ["date", "a", "b", "target"]
    assert seqs.feature_mode(rows, "MS", "target", ["b"]).columns == ["date", "b", "target"]
    assert seqs.feature_mode(rows, "S", "target").columns == ["date", "target"]
    assert seqs.target_columns("MS", ["a", "target"]) == ["target"]
    with pytest.raises(ValueError):
        seqs.feature_mode(rows, "Q", "target")


def _sample_rows(n, symbol):
    import random

    rng = random.Random(symbol)
    return [(symbol, k, [[float(rng.random()), 2.0]] * 3, [[float(rng.random()), 1.0]]) for k in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_merged_fits_do_not_depend_on_how_samples_are_cut(spark, parts):
    import numpy as np
    from tidemark.operators import models as mod

    rows = _sample_rows(300, "hot") + _sample_rows(3, "b") + _sample_rows(2, None)
    samples = spark.createDataFrame(rows, "symbol string, sample_id long, x array<array<double>>, y array<array<double>>").repartition(parts)
    fit = mod.MergeableFit(
        lambda rows: np.array([len(rows), sum(y[0][0] for y in rows["y"]), max(y[0][0] for y in rows["y"])]),
        lambda a, b: np.array([a[0] + b[0], a[1] + b[1], max(a[2], b[2])]),
        lambda s: [s[1] / s[0], s[2]])
    found = {r.symbol: r for r in mod.fit_mergeable(samples, fit, ["symbol"], ["y"], spread=3).collect()}
    assert set(found) == {"hot", "b", None}
    for symbol in found:
        targets = [r[3][0][0] for r in rows if r[0] == symbol]
        assert found[symbol].n == len(targets) and found[symbol].error is None
        assert found[symbol].params == pytest.approx([sum(targets) / len(targets), max(targets)])

    def picky(rows):
        if (rows["symbol"] == "b").any():
            raise ArithmeticError("no")
        return np.zeros(1)

    failing = {r.symbol: r for r in mod.fit_mergeable(samples, mod.MergeableFit(picky, lambda a, b: a, lambda s: s), ["symbol"]).collect()}
    assert failing["b"].params is None and "no" in failing["b"].error and failing["hot"].params == [0.0]
    assert mod.fit_mergeable(samples.limit(0), fit, ["symbol"], ["y"]).count() == 0


def test_penalties_share_their_sums(spark):
    from tidemark.operators import models as mod

    rows = _sample_rows(60, "a") + _sample_rows(40, "b")
    samples = spark.createDataFrame(rows, "symbol string, sample_id long, x array<array<double>>, y array<array<double>>")
    read = []
    candidates = mod.ridge_candidates({"one": 0.01, "two": 5.0}, ["symbol"], 3, lags=2)
    prepare = candidates["one"].prepare
    assert prepare is candidates["two"].prepare
    counted = {n: mod.Candidate(c.fit, c.score, lambda s: read.append(n) or prepare(s)) for n, c in [("one", candidates["one"])]}
    best = {r.symbol: r for r in mod.train_best(samples, samples, candidates, ["symbol"], 1).collect()}
    for symbol in ("a", "b"):
        own = {}
        for name, alpha in (("one", 0.01), ("two", 5.0)):
            model = mod.fit_ridge(samples, ["symbol"], 3, lags=2, alpha=alpha)
            own[name] = {r.symbol: r.val_loss for r in mod.evaluate(samples, model, mod.ridge_score(2), ["symbol"], 1).collect()}[symbol]
        assert best[symbol].model == min(own, key=own.get) and best[symbol].val_loss == pytest.approx(min(own.values()))
    mod.train_best(samples, samples, counted, ["symbol"], 1)
    assert read == ["one"]
