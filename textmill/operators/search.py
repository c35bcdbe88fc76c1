"""Cross-validation, parameter search, learning curves and the score tables they produce.

A study is a function ``run(train, test, params) -> (test_score, train_score)`` whose body is Spark jobs. Several studies
run at once on one session through a small thread pool; the threads only wait for Spark. All of them read the same
staged input, so the text is tokenised once. A study with a method ``together(df, tasks, fold)`` is given all (fold, limit of the
level, params) at once and returns a pair of scores or an InvalidPoint for each, so that it can share its readings.
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.errors import InvalidPoint
from textmill.functions.numeric import fingerprint_bucket
from textmill.operators.aggregates import in_ranges
from textmill.operators.splits import dedupe, hash_sample

Study = Callable[[DataFrame, DataFrame, dict], tuple[float, float]]


def expand_grid(grid: dict[str, Sequence]) -> list[dict]:
    """Every combination of a parameter grid."""
    names = list(grid)
    return [dict(zip(names, values, strict=True)) for values in itertools.product(*grid.values())]


def draw_grid(grid: dict[str, Sequence], n_iter: int, seed: int = 30) -> list[dict]:
    """``n_iter`` different combinations of a grid, all of them when there are fewer."""
    combos = expand_grid(grid)
    return combos if n_iter >= len(combos) else random.Random(seed).sample(combos, n_iter)


def draw_space(space: dict[str, tuple[float, float] | Sequence], trials: int, seed: int = 30, is_int: Sequence[str] = ()) -> list[dict]:
    """Uniform draws: a tuple is a closed range, a list a set of choices; names in ``is_int`` are rounded."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        point = {}
        for name, domain in space.items():
            if isinstance(domain, tuple):
                value = rng.uniform(*domain)
                point[name] = int(round(value)) if name in is_int else value
            else:
                point[name] = rng.choice(list(domain))
        drawn.append(point)
    return drawn


def _text(value) -> str | float | int:
    return value if isinstance(value, int | float) and not isinstance(value, bool) else str(value)


def run_studies(
    df: DataFrame, points: Sequence[dict], run: Study, folds: int, fold: str = "fold", parallel: int = 5, failed_score: float = 0.0,
    max_failed: int | None = None,
) -> DataFrame:
    """(run_id, fold, params..., test_score, train_score, fit_time): one row per point and fold.

    A study that raises InvalidPoint scores ``failed_score``, unless more than ``max_failed`` points fail or all do. Folds
    are numbered from 0; rows of a fold beyond ``folds`` are refused, as they would never be tested.
    """
    spark = df.sparkSession
    last = df.agg(F.max(fold)).first()[0]
    if last is not None and last >= folds:
        raise ValueError(f"the data has {last + 1} folds, the search {folds}")
    tasks = [(i, f, p) for i, p in enumerate(points) for f in range(folds)]

    def scored(task: tuple[int, int, dict], scores: tuple[float, float], spent: float, error: Exception | None) -> tuple[dict, Exception | None]:
        run_id, number, params = task
        row = {"run_id": run_id, "fold": number, **{k: _text(v) for k, v in params.items()}}
        return row | {"test_score": float(scores[0]), "train_score": float(scores[1]), "fit_time": spent}, error

    def one(task: tuple[int, int, dict]) -> tuple[dict, Exception | None]:
        _, number, params = task
        start, error = time.time(), None
        try:
            scores = run(df.filter(F.col(fold) != number), df.filter(F.col(fold) == number), params)
        except InvalidPoint as exc:  # a result of the search; any other error ends the job
            scores, error = (failed_score, failed_score), exc
        return scored(task, scores, time.time() - start, error)

    if hasattr(run, "together"):
        start = time.time()
        found = run.together(df, [(number, None, params) for _, number, params in tasks], fold)
        spent = (time.time() - start) / max(len(tasks), 1)
        results = [scored(task, x if isinstance(x, tuple) else (failed_score, failed_score), spent, None if isinstance(x, tuple) else x) for task, x in zip(tasks, found, strict=True)]
    else:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(one, tasks))
    failed = {row["run_id"]: error for row, error in results if error is not None}
    if (max_failed is not None and len(failed) > max_failed) or (points and len(failed) == len(points)):
        raise RuntimeError(f"{len(failed)} of {len(points)} points failed") from next(iter(failed.values()))
    return _rows_to_frame(spark, [row for row, _ in results])


def _rows_to_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    kinds = {int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"`{name}` {kinds[type(value)]}" for name, value in rows[0].items())
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def cv_summary(
    runs: DataFrame, params: Sequence[str], folds: int, now: datetime | None = None, steps: dict[str, str] | None = None
) -> DataFrame:
    """(test_score, std, train_score, cv_folds, params..., date, steps...): one row per attempt."""
    stamp = (now or datetime.now()).strftime("%Y.%m.%d %H:%M")
    grouped = runs.groupBy(*params).agg(
        F.avg("test_score").alias("test_score"),
        F.stddev_pop("test_score").alias("std"),
        F.avg("train_score").alias("train_score"),
    )
    extra = [F.lit(text).alias(name) for name, text in (steps or {}).items()]
    return grouped.select(
        "test_score", "std", "train_score", F.lit(float(folds)).alias("cv_folds"), *params, F.lit(stamp).alias("date"), *extra
    )


def best_params(summary: DataFrame, params: Sequence[str]) -> dict:
    """Parameters of the best mean test score; among equals the first in parameter order."""
    row = summary.orderBy(F.desc(F.round("test_score", 12)), *params).first()
    return {p: row[p] for p in params}


def grid_search(df: DataFrame, grid: dict[str, Sequence], run: Study, folds: int = 3, parallel: int = 5) -> tuple[DataFrame, dict]:
    """(summary, best parameters) over the full grid."""
    runs = run_studies(df, expand_grid(grid), run, folds, parallel=parallel)
    summary = cv_summary(runs, list(grid), folds)
    return summary, best_params(summary, list(grid))


def random_search(
    df: DataFrame, grid: dict[str, Sequence], run: Study, n_iter: int, folds: int = 3, seed: int = 30, parallel: int = 5
) -> tuple[DataFrame, dict]:
    """As :func:`grid_search` on ``n_iter`` random combinations."""
    runs = run_studies(df, draw_grid(grid, n_iter, seed), run, folds, parallel=parallel)
    summary = cv_summary(runs, list(grid), folds)
    return summary, best_params(summary, list(grid))


def tune(
    df: DataFrame, space: dict, run: Study, trials: int = 50, parallel: int = 5, folds: int = 5, seed: int = 30,
    is_int: Sequence[str] = (), max_failed: int | None = 1,
) -> tuple[DataFrame, dict]:
    """Uniform draws from ranges and choices, mean score over the folds, ``parallel`` trials at a time."""
    points = draw_space(space, trials, seed, is_int)
    runs = run_studies(df, points, run, folds, parallel=parallel, max_failed=max_failed)
    summary = cv_summary(runs, list(space), folds)
    return summary, best_params(summary, list(space))


def progress(runs: DataFrame, params: Sequence[str]) -> DataFrame:
    """(run_id, mean_test_score, std_test_score, mean_fit_time, params...): results joined with their parameters."""
    results = runs.groupBy("run_id").agg(
        F.avg("test_score").alias("mean_test_score"),
        F.stddev_pop("test_score").alias("std_test_score"),
        F.avg("fit_time").alias("mean_fit_time"),
    )
    return join_runs(results, runs.select("run_id", *params).distinct())


def join_runs(results: DataFrame, params: DataFrame, key: str = "run_id") -> DataFrame:
    """Inner join of two result frames on the row number of the run."""
    return results.join(params, key)


def warm_start(scores: DataFrame, ranges: dict[str, tuple[float, float]], cv: int, order_by: str = "run_id") -> DataFrame:
    """(params..., target): earlier scores with the wanted folds, first row per parameter setting, inside the ranges."""
    names = list(ranges)
    first = dedupe(scores.filter(F.col("cv_folds") == cv), names, order_by)
    return in_ranges(first, ranges).select(*names, F.col("test_score").alias("target"))


def param_slices(scores: DataFrame, params: Sequence[str]) -> DataFrame:
    """(param, value, others, test_score, std): for each parameter its score curve for every setting of the others."""
    views = []
    for name in params:
        others = [F.concat(F.lit(f"{o} = "), F.col(o).cast("string")) for o in params if o != name]
        views.append(
            F.struct(
                F.lit(name).alias("param"),
                F.col(name).cast("string").alias("value"),
                F.concat_ws(" ", *others).alias("others"),
            )
        )
    exploded = scores.select(F.explode(F.array(*views)).alias("v"), "test_score", "std")
    return exploded.select("v.*", "test_score", "std")


def learning_curve(
    df: DataFrame, run: Study, params: dict, folds: int = 3, sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), key: str = "id",
    parallel: int = 5,
) -> DataFrame:
    """(size, train_mean, train_std, test_mean, test_std) at growing shares of the training folds.

    The samples are nested: a row in the 10 % sample is also in every larger one.
    """

    def at_size(train: DataFrame, test: DataFrame, point: dict) -> tuple[float, float]:
        return run(hash_sample(train, point["size"], key, "curve"), test, params)

    if hasattr(run, "together"):
        # the level of a row is the smallest sample that holds it
        limits = sorted({round(s * 10000) for s in sizes if 0 < s < 1})

        def levelled(rows: DataFrame, tasks: list, fold: str) -> list:
            level = F.lit(len(limits))
            for i, limit in reversed(list(enumerate(limits))):
                level = F.when(fingerprint_bucket(F.col(key), 10000, "curve") < limit, i).otherwise(level)
            sized = [(number, limits.index(round(p["size"] * 10000)) if 0 < p["size"] < 1 else None, params) for number, _, p in tasks]
            return run.together(rows.withColumn("_level", level), sized, fold)

        at_size.together = levelled

    runs = run_studies(df, [{"size": float(s)} for s in sizes], at_size, folds, parallel=parallel)
    return runs.groupBy("size").agg(
        F.avg("train_score").alias("train_mean"),
        F.stddev_pop("train_score").alias("train_std"),
        F.avg("test_score").alias("test_mean"),
        F.stddev_pop("test_score").alias("test_std"),
    )
