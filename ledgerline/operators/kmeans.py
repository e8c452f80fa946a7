"""Many k-means models at once: all of them advance in the same pass over the rows.

A model is one start of one K.  Every pass reads the rows once, takes the distances to the centres of all open models by
matrix products per Arrow batch, and adds up rows, sums and costs per centre; one small aggregate goes back to the driver.
Models whose centres stop moving leave.  Seeding draws candidates with probability by squared distance, a few rounds for all
models together, and thins them out to K by weighted draws among the candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialised

#: Rows per matrix product, rounds of seeding, candidates per round and centre.
CHUNK, ROUNDS, OVERSAMPLE = 256, 4, 2
#: Centres in one matrix product, so that it stays in a core's cache.
TOGETHER = 128


@dataclass
class Model:
    """One start: its centres, the cost of the rows under them and how often they moved."""

    k: int
    seed: int
    centers: np.ndarray = field(repr=False)
    cost: float = float("nan")
    sizes: np.ndarray | None = None
    sweeps: int = 0
    converged: bool = False


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(1)[None, :], 0.0)


def stacked_runs(centers: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """Neighbouring models with as many centres each, stacked: (centres per model, their centres one below the other)."""
    runs: list[list[np.ndarray]] = []
    for c in centers:
        if runs and len(runs[-1][0]) == len(c) and (len(runs[-1]) + 1) * len(c) <= TOGETHER:
            runs[-1].append(c)
        else:
            runs.append([c])
    return [(len(run[0]), np.vstack(run)) for run in runs]


def nearer(x: np.ndarray, k: int, stacked: np.ndarray) -> np.ndarray:
    """Squared distances less the row's own square, as models x centres x rows; one matrix product."""
    far = stacked @ (-2.0 * x.T)
    far += (stacked * stacked).sum(1)[:, None]
    return far.reshape(-1, k, len(x))


def uniform(h: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit row hashes and a salt (the splitmix finisher); a row of numbers per salt for a column of them."""
    with np.errstate(over="ignore"):
        salt = np.asarray(salt).astype(np.uint64)
        z = h.view(np.uint64) + (salt * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2**53


class Rows:
    """Numeric columns of a frame with a hash per row, read pass by pass.  Rows with a NULL feature are left out."""

    def __init__(self, df: DataFrame, features: list[str]) -> None:
        ident = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        rows = df.select(ident.alias("h"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).dropna()
        # Every pass takes as long as its largest task: rows in fewer parts than there are cores are dealt out once.
        cores = df.sparkSession.sparkContext.defaultParallelism
        self.source = rows if df.rdd.getNumPartitions() >= cores else materialised(rows.repartition(cores, "h"))
        self.d, self.passes = len(features), 0

    def each(self, work: Callable, done: Callable, schema: str, fresh: Callable) -> DataFrame:
        self.passes += 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = fresh()
            for batch in batches:
                if not batch.num_rows:
                    continue
                h = batch.column(0).to_numpy()
                x = np.column_stack([batch.column(i + 1).to_numpy() for i in range(batch.num_columns - 1)])
                for at in range(0, len(h), CHUNK):
                    work(state, h[at : at + CHUNK], x[at : at + CHUNK])
            yield done(state)

        return self.source.mapInArrow(run, schema)

    def sums(self, centers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows, cost, squares, sums) per centre of all models, in their order; a row counts for its nearest centre of each."""
        runs, d = stacked_runs(centers), self.d
        total = sum(len(c) for c in centers)

        def add(state: np.ndarray, _h: np.ndarray, x: np.ndarray) -> None:
            norm = (x * x).sum(1)
            counted = np.column_stack([np.ones(len(x)), norm, x])
            at = 0
            for k, stacked in runs:
                far = nearer(x, k, stacked)
                best = far.min(axis=1)
                own = far == best[:, None, :]
                if int(np.count_nonzero(own)) > best.size:
                    # Equally near centres: the first one has the row.
                    own &= own.cumsum(axis=1) == 1
                own = own.astype(float)
                here = state[at : at + len(stacked)]
                found = own.reshape(len(stacked), len(x)) @ counted
                here[:, 0] += found[:, 0]
                here[:, 1] += (own @ np.maximum(best + norm, 0.0)[:, :, None]).ravel()
                here[:, 2:] += found[:, 1:]
                at += len(stacked)

        names = ["n", "cost", "squares", *[f"s{j}" for j in range(d)]]

        def done(state: np.ndarray) -> pa.RecordBatch:
            used = np.flatnonzero(state[:, 0])
            return pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(state[used, i]) for i in range(len(names))]], names=["slot", *names])

        schema = "slot long, " + ", ".join(f"{c} double" for c in names)
        parts = self.each(add, done, schema, lambda: np.zeros((total, 3 + d)))
        out = np.zeros((total, 3 + d))
        for row in parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in names]).collect():
            out[row["slot"]] = [row[c] for c in names]
        return out[:, 0], out[:, 1], out[:, 2], out[:, 3:]

    def drawn(self, centers: list[np.ndarray | None], wanted: list[int], salts: list[int]) -> list[np.ndarray]:
        """Per model about ``wanted`` rows, each the likelier the farther it lies from the model's centres (none yet: evenly).

        An exponential race: the smallest -ln(u) / weight win.  Each task keeps its own best, the rest meet per model.
        """
        d = self.d

        salt = np.array(salts)[:, None]
        runs = None if centers[0] is None else stacked_runs(centers)

        def race(state: list, h: np.ndarray, x: np.ndarray) -> None:
            weight = np.ones((len(wanted), len(x)))
            if runs is not None:
                norm, at = (x * x).sum(1), 0
                for k, stacked in runs:
                    least = nearer(x, k, stacked).min(axis=1)
                    weight[at : at + len(least)] = np.maximum(least + norm, 0.0)
                    at += len(least)
            # What rounding leaves of a distance to a row already taken is no distance.
            open_rows = weight > 1e-9
            time = np.where(open_rows, -np.log(uniform(h, salt)) / np.where(open_rows, weight, 1.0), np.inf)
            # Only rows that beat the last of a model's best so far are looked at.
            bar = np.array([s[-1, 0] if len(s) >= n else np.inf for s, n in zip(state, wanted, strict=True)])
            for m in np.flatnonzero((time < bar[:, None]).any(axis=1)):
                n, own = wanted[m], time[m]
                first = np.flatnonzero(own < bar[m])
                if len(first) > n:
                    first = first[np.argpartition(own[first], n - 1)[:n]]
                kept = np.vstack([state[m], np.column_stack([own[first], x[first]])])
                state[m] = kept[np.argsort(kept[:, 0], kind="stable")[:n]]

        names = ["time", *[f"x{j}" for j in range(d)]]

        def done(state: list) -> pa.RecordBatch:
            rows = np.vstack(state)
            model = np.repeat(np.arange(len(state)), [len(s) for s in state])
            return pa.RecordBatch.from_arrays([pa.array(model), *[pa.array(rows[:, i]) for i in range(d + 1)]], names=["model", *names])

        schema = "model long, " + ", ".join(f"{c} double" for c in names)
        found = self.each(race, done, schema, lambda: [np.zeros((0, d + 1)) for _ in centers])
        place = F.row_number().over(Window.partitionBy("model").orderBy(*names))
        best = found.withColumn("place", place).filter(F.col("place") <= max(wanted)).collect()
        out: list[list] = [[] for _ in centers]
        for row in sorted(best, key=lambda r: (r["model"], r["place"])):
            if row["place"] <= wanted[row["model"]]:
                out[row["model"]].append([row[f"x{j}"] for j in range(d)])
        return [np.array(rows, dtype=float).reshape(-1, d) for rows in out]

    def silhouettes(self, models: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[float]:
        """Mean silhouette of each model by squared distances, from (centres, rows, squares, sums) per model."""

        def add(state: np.ndarray, _h: np.ndarray, x: np.ndarray) -> None:
            everyone = np.arange(len(x))
            for m, (centers, n, squares, sums) in enumerate(models):
                state[m] += silhouette_values(x, squared_distances(x, centers).argmin(1), n, squares, sums, everyone).sum()
            state[-1] += len(x)

        def done(state: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(state))), pa.array(state)], names=["model", "total"])

        parts = self.each(add, done, "model long, total double", lambda: np.zeros(len(models) + 1))
        got = {r["model"]: r["total"] for r in parts.groupBy("model").agg(F.sum("total").alias("total")).collect()}
        return [got[m] / got[len(models)] if got.get(len(models)) else float("nan") for m in range(len(models))]


def silhouette_values(x: np.ndarray, own: np.ndarray, n: np.ndarray, squares: np.ndarray, sums: np.ndarray, everyone: np.ndarray) -> np.ndarray:
    """Silhouette of each row from rows, squares and sums per cluster; 0 in a cluster of one, or with a single cluster."""
    held = n > 0
    size = np.where(held, n, 1.0)
    mean = (x * x).sum(1)[:, None] + (squares / size)[None, :] - 2 * (x @ (sums / size[:, None]).T)
    mean = np.where(held[None, :], np.maximum(mean, 0.0), np.inf)
    inside = mean[everyone, own] * size[own] / np.maximum(size[own] - 1, 1)
    mean[everyone, own] = np.inf
    outside = mean.min(axis=1)
    most = np.maximum(inside, outside)
    fine = (size[own] > 1) & np.isfinite(outside) & (most > 0)
    return np.where(fine, (outside - inside) / np.where(fine, most, 1.0), 0.0)


def thinned(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the weighted candidates by distance-weighted draws; fewer where fewer differ."""
    chosen, left = [], weight.astype(float).copy()
    near = np.full(len(points), np.inf)
    while len(chosen) < k and left.sum() > 0:
        at = int(rng.choice(len(points), p=left / left.sum()))
        chosen.append(at)
        near = np.minimum(near, ((points - points[at]) ** 2).sum(1))
        left = np.where(near > 1e-12, weight * near, 0.0)
    return points[chosen]


def seeded(rows: Rows, tasks: list[tuple[int, int]]) -> list[np.ndarray]:
    """Starting centres for all (k, seed), in ``ROUNDS`` + 2 passes."""
    found = rows.drawn([None] * len(tasks), [1] * len(tasks), [seed * 1009 for _, seed in tasks])
    for r in range(1, ROUNDS + 1):
        more = rows.drawn(found, [OVERSAMPLE * k for k, _ in tasks], [seed * 1009 + r for _, seed in tasks])
        found = [np.vstack([a, b]) for a, b in zip(found, more, strict=True)]
    if not len(found[0]):
        raise ValueError("no rows to cluster")
    n = rows.sums(found)[0]
    cuts = np.cumsum([0, *[len(c) for c in found]])
    return [thinned(c, n[a : a + len(c)], k, np.random.default_rng([seed, k])) for c, a, (k, seed) in zip(found, cuts, tasks, strict=False)]


def lloyd(rows: Rows, models: list[Model], sweeps: int, tol: float) -> None:
    """Moves the centres of all models until they rest or have moved ``sweeps`` times; one pass for all of them."""
    for _ in range(sweeps):
        active = [m for m in models if not m.converged]
        if not active:
            return
        n, _, _, sums = rows.sums([m.centers for m in active])
        at = 0
        for m in active:
            own = slice(at, at + len(m.centers))
            at += len(m.centers)
            held = n[own] > 0
            moved = np.where(held[:, None], sums[own] / np.maximum(n[own], 1)[:, None], m.centers)
            m.converged = bool(((moved - m.centers) ** 2).sum(1).max() <= tol * tol)
            m.centers, m.sweeps = moved, m.sweeps + 1


def judged(rows: Rows, models: list[Model]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Cost and sizes of all models under their final centres, in one pass; what ``silhouettes`` takes of each."""
    n, cost, squares, sums = rows.sums([m.centers for m in models])
    out, at = [], 0
    for m in models:
        own = slice(at, at + len(m.centers))
        at += len(m.centers)
        m.cost, m.sizes = float(cost[own].sum()), n[own]
        out.append((m.centers, n[own], squares[own], sums[own]))
    return out


def fit_many(rows: Rows, tasks: list[tuple[int, int]], sweeps: int = 50, tol: float = 1e-4) -> list[Model]:
    """A model for every (k, seed), at most ``ROUNDS`` + 3 + ``sweeps`` passes in all; costs are not taken yet."""
    models = [Model(k, seed, centers) for (k, seed), centers in zip(tasks, seeded(rows, tasks), strict=True)]
    lloyd(rows, models, sweeps, tol)
    return models


def best_of(df: DataFrame, features: list[str], k: int, starts: int, seed: int = 42, sweeps: int = 50) -> Model:
    """The start with the least cost; ties go to the first."""
    rows = Rows(df, features)
    models = fit_many(rows, [(k, seed + s) for s in range(starts)], sweeps)
    judged(rows, models)
    return min(models, key=lambda m: m.cost)


def labelled(df: DataFrame, features: list[str], centers: np.ndarray, name: str) -> DataFrame:
    """``df`` with the number of the nearest centre; NULL where a feature is."""

    @F.pandas_udf("int")
    def label(values):
        x = np.vstack(values.to_numpy())
        return type(values)(squared_distances(x, centers).argmin(1).astype("int32"), index=values.index)

    complete = ~F.exists(F.array(*features), lambda v: v.isNull())
    return df.withColumn(name, F.when(complete, label(F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]))))


def silhouette(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One row ``silhouette``: mean over all rows for given labels, by squared distances, without pairs.

    Sums per cluster are one row each, so there may be as many clusters as the driver holds rows of ``features``.
    """
    x = [F.col(f).cast("double") for f in features]
    norm = sum(v * v for v in x)
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(norm).alias("squares"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]).collect()
    place = {row[label]: i for i, row in enumerate(stats)}
    n, squares = np.array([float(r["n"]) for r in stats]), np.array([float(r["squares"]) for r in stats])
    sums = np.array([[r[f"s{i}"] for i in range(len(features))] for r in stats]).reshape(len(stats), len(features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = np.array([place[v] for v in batch.column(0).to_pylist()])
                values = np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(features))])
                total = silhouette_values(values, own, n, squares, sums, np.arange(len(own))).sum()
                yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([len(own)])], names=["total", "n"])

    parts = df.select(label, *[v.alias(f"x{i}") for i, v in enumerate(x)]).mapInArrow(run, "total double, n long")
    return parts.agg(F.try_divide(F.sum("total"), F.sum("n")).alias("silhouette"))
