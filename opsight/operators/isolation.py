"""Isolation forest.

Trees are grown on small samples, one group per tree, and scored by every task on its own
batches. Splits are on single features, so scaling them would not change any score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from opsight.operators.quantiles import exact_quantiles
from opsight.session import materialise

TREE = "tree int, node int, feature int, split double, left int, right int, depth double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _grow(features: Sequence[str], seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        # Sample order depends on the shuffle; the id order does not.
        x = pdf.sort_values("_id")[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng((seed, tree))
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        taken = 1
        while todo:
            node, rows, depth = todo.pop()
            span = np.ptp(x[rows], axis=0) if len(rows) else np.zeros(x.shape[1])
            usable = np.flatnonzero(span > 0)
            if depth >= limit or len(rows) <= 1 or not len(usable):
                nodes.append((tree, node, -1, 0.0, -1, -1, depth + average_path(len(rows))))
                continue
            f = int(rng.choice(usable))
            lo, hi = x[rows, f].min(), x[rows, f].max()
            split = float(rng.uniform(lo, hi))
            low = x[rows, f] <= split
            left, right = taken, taken + 1
            taken += 2
            nodes.append((tree, node, f, split, left, right, 0.0))
            todo += [(left, rows[low], depth + 1), (right, rows[~low], depth + 1)]
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in TREE.split(", ")])

    return grow


@dataclass(frozen=True)
class Forest:
    """Fitted trees as flat node tables; at most 511 nodes per tree."""

    features: tuple[str, ...]
    trees: tuple[dict, ...]
    sample: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1); higher is rarer."""
        depth = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in self.trees:
            at = np.zeros(len(x), dtype=int)
            inner = t["feature"][at] >= 0
            while inner.any():
                i = rows[inner]
                f, s = t["feature"][at[i]], t["split"][at[i]]
                at[i] = np.where(x[i, f] <= s, t["left"][at[i]], t["right"][at[i]])
                inner[i] = t["feature"][at[i]] >= 0
            depth += t["depth"][at]
        return np.power(2.0, -(depth / len(self.trees)) / average_path(self.sample))


def fit_forest(
    df: DataFrame, features: Sequence[str], row_id: str, trees: int = 200, sample: int = 256, seed: int = 42
) -> Forest:
    """Grow the trees on hashed samples.

    A first pass keeps a few hundred thousand rows at most, by hash and whatever the input
    size; each tree then takes its own ``sample`` of those. Only node tables reach the driver.
    """
    rows = df.select(F.col(row_id).alias("_id"), *[F.col(f).cast("double").alias(f) for f in features]).na.drop()
    total = rows.count()
    if total == 0:
        raise ValueError("no complete rows to grow trees on")
    unit = lambda *c: (F.xxhash64(*c) / F.lit(2.0**64)) + 0.5
    pool_share = min(1.0, 4.0 * trees * sample / total)
    pool = rows.filter(unit("_id", F.lit(seed)) < pool_share)
    tree_share = min(1.0, 1.5 * sample / (total * pool_share))
    if tree_share > 0.25:  # a pool of at most 6 samples: every row is asked about every tree
        numbers = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: unit("_id", t, F.lit(seed + 1)) < tree_share)
    else:
        # A row draws as many trees as it is expected to be in, the fraction by chance, so that few rows come of it.
        count = F.floor(F.lit(trees * tree_share) + unit("_id", F.lit(seed + 2))).cast("int")
        numbers = F.when(count > 0, F.array_distinct(F.transform(
            F.sequence(F.lit(1), count), lambda i: F.pmod(F.xxhash64("_id", i, F.lit(seed + 1)), F.lit(trees)).cast("int"))))
    drawn = pool.select("*", F.explode(numbers).alias("tree")).withColumn("_u", unit("_id", "tree", F.lit(seed + 3)))
    w = Window.partitionBy("tree").orderBy("_u", "_id")
    picked = drawn.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= sample).drop("_u", "_rn")
    nodes = picked.groupBy("tree").applyInPandas(_grow(features, seed), TREE).toPandas()
    built = []
    for _, t in nodes.groupby("tree", sort=True):
        t = t.sort_values("node")
        built.append({c: t[c].to_numpy() for c in ("feature", "split", "left", "right", "depth")})
    return Forest(tuple(features), tuple(built), min(sample, total))


def isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    row_id: str,
    trees: int = 200,
    sample: int = 256,
    contamination: float = 0.06,
    seed: int = 42,
) -> DataFrame:
    """``anomaly_score`` (higher is rarer, positive beyond the cut) and ``is_anomaly``."""
    forest = fit_forest(df, features, row_id, trees, sample, seed)

    @F.pandas_udf("double")
    def rarity(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            known = ~np.isnan(x).any(axis=1)
            out = np.full(len(x), np.nan)
            out[known] = forest.score(x[known])
            yield pd.Series(out)

    # The cut reads all scores, so they are computed once and written.
    scored = materialise(df.withColumn("_s", rarity(*[F.col(f).cast("double") for f in features])))
    cut = exact_quantiles(scored, [], "_s", [1 - contamination]).select(F.col("quantiles")[0].alias("c")).scalar()
    return scored.withColumns(
        {"anomaly_score": F.col("_s") - cut, "is_anomaly": F.coalesce(F.col("_s") > cut, F.lit(False)) & ~F.isnan("_s")}
    ).drop("_s")
