"""k-means with many starts that share every scan of the rows."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .lineage import written_once


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from the hash of a row and a salt, the same on every run."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64(salt % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0**-54


def _drawn(vectors: DataFrame, columns: Sequence[str], centres: list[list], round_no: int, seed: int) -> dict[int, list[float]]:
    """For every start one row, drawn with a chance in proportion to its squared distance from the centres so far."""
    n = len(centres)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, ids = batch[list(columns)].to_numpy(float), batch["_id"].to_numpy()
            if not len(x):
                continue
            out = []
            for start, chosen in enumerate(centres):
                weight = _squared(x, np.array(chosen)).min(axis=1) if chosen else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    key = -np.log(_uniform(ids, (seed * 1_000_003 + start) * 64 + round_no)) / weight
                best = int(key.argmin())
                out.append((start, float(key[best]), *x[best].tolist()))
            yield pd.DataFrame(out, columns=["start", "key", *columns])

    schema = ", ".join(["start int", "key double", *[f"`{c}` double" for c in columns]])
    first = vectors.mapInPandas(draw, schema).groupBy("start").agg(F.min(F.struct("key", *columns)).alias("best"))
    found = {r["start"]: [float(r["best"][c]) for c in columns] for r in first.collect()}  # one row for each start
    return found if len(found) == n else {}


def _moved(vectors: DataFrame, columns: Sequence[str], centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, float]]:
    """The means of the rows nearest to each centre and the summed squared distances to the centres, for every start in one scan."""
    sums = [f"s{i}" for i in range(len(columns))]

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, many = batch[list(columns)].to_numpy(float), batch["_n"].to_numpy(float)
            if not len(x):
                continue
            out = []
            for start, of in centres.items():
                far = _squared(x, of)
                near = far.argmin(axis=1)
                n = np.bincount(near, weights=many, minlength=len(of))
                cost = np.bincount(near, weights=far.min(axis=1) * many, minlength=len(of))
                total = np.stack([np.bincount(near, weights=x[:, j] * many, minlength=len(of)) for j in range(x.shape[1])], axis=1)
                out += [(start, c, int(n[c]), float(cost[c]), *total[c].tolist()) for c in range(len(of)) if n[c]]
            yield pd.DataFrame(out, columns=["start", "cluster", "n", "cost", *sums])

    schema = ", ".join(["start int", "cluster int", "n long", "cost double", *[f"{s} double" for s in sums]])
    total = vectors.mapInPandas(step, schema).groupBy("start", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *sums)])
    found = {start: (of.copy(), 0.0) for start, of in centres.items()}
    for r in total.collect():  # one row for each start and cluster
        of, cost = found[r["start"]]
        of[r["cluster"]] = [r[s] / r["n"] for s in sums]
        found[r["start"]] = (of, cost + r["cost"])
    return found


def k_means_starts(vectors: DataFrame, columns: Sequence[str], k: int, starts: int = 50, seed: int = 1, most_steps: int = 500, tol: float = 1e-4) -> list[dict]:
    """One entry per start, best first: ``centres`` (sorted), ``cost``, ``steps`` and ``converged``.

    First centres are drawn from the distinct rows by squared distance. Every step is one scan for all
    starts that still move; a task gives out one row for each batch, start and cluster, and the driver
    holds the centres only. A start has converged when its centres move by at most ``tol`` in all. A cluster
    that loses its rows keeps its centre. Without rows the list is empty.
    """
    vectors = vectors.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    vectors = vectors.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))  # equal rows move together
    vectors = written_once(vectors.withColumn("_id", F.xxhash64(*columns)))  # every step reads the rows again
    chosen: list[list] = [[] for _ in range(starts)]
    for i in range(k):
        drawn = _drawn(vectors, columns, chosen, i, seed)
        if not drawn:
            return []
        chosen = [[*have, drawn[start]] for start, have in enumerate(chosen)]
    moving = {start: np.array(of) for start, of in enumerate(chosen)}
    done: list[dict] = []
    for step in range(1, most_steps + 1):
        for start, (of, cost) in _moved(vectors, columns, moving).items():
            still = bool(((of - moving[start]) ** 2).sum() > tol**2)
            moving[start] = of
            if not still or step == most_steps:
                done.append({"centres": sorted(moving.pop(start).tolist()), "cost": cost, "steps": step, "converged": not still})
        if not moving:
            break
    return sorted(done, key=lambda e: (e["cost"], e["centres"]))


def nearest_centre(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """The number of the nearest centre, the smaller on ties."""
    far = [sum(((F.col(f"`{c}`") - F.lit(float(v))) * (F.col(f"`{c}`") - F.lit(float(v))) for c, v in zip(columns, of)), F.lit(0.0)) for of in centres]
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(far)]))["i"]


def with_clusters(df: DataFrame, columns: Sequence[str], k: int, label: str, **options) -> DataFrame:
    """Add ``label``, the k-means cluster of the columns by the best start; rows with a missing value or NaN get -1.

    Clusters are numbered by their centres in ascending order, so labels do not depend on the start. A warning
    says when the best start has not converged.
    """
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))
    fits = k_means_starts(df.where(~missing), columns, k, **options)
    if not fits:
        return df.withColumn(label, F.lit(-1))
    if not fits[0]["converged"]:
        warnings.warn(f"k-means for {label} stopped after {fits[0]['steps']} steps before its centres came to rest", stacklevel=2)
    return df.withColumn(label, F.when(missing, F.lit(-1)).otherwise(nearest_centre(columns, fits[0]["centres"])))
