"""Random forests grown level by level with aggregations, the same for every layout of the rows.

A row's weight in a tree comes from a hash of (tree, row key), and so does the choice of features
at a node; sums are decimals, which no order of adding changes.  One forest of the same seed is therefore
the same out of 2 partitions or 200.  A level of all trees and targets is one round of jobs: rows are summed
by (target, tree, node, feature, value), the best split of each node is found in these sums, and rows
move to the children.  Each level is checkpointed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Sums are kept to this many decimal places.
_AMOUNT = "decimal(28,4)"
# Cumulative probabilities of a Poisson variable of mean 1, as far as a double tells them apart.
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) for n in range(18)]

_NODE = ["target", "tree", "node"]


def bootstrap_weight(seed: int, tree: Column, key: Column) -> Column:
    """How often a row is in a tree's sample: Poisson of mean 1, from a hash."""
    share = F.pmod(F.xxhash64(F.lit(seed), tree, key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    weight = F.lit(len(_POISSON))
    for count in reversed(range(len(_POISSON))):
        weight = F.when(share < _POISSON[count], F.lit(count)).otherwise(weight)
    return weight


def _subset(features: int, feature_subset: str) -> int:
    if feature_subset == "all":
        return features
    if feature_subset == "auto":
        return max(1, math.ceil(features / 3))
    raise ValueError(f"unknown subset {feature_subset!r}")


def _splits(rows: DataFrame, features: Sequence[str], wanted: int, seed: int) -> DataFrame:
    """Per node ``feature, threshold`` of its best split (NULL if none gains) and its ``mean``.

    Sums by value are one row per distinct value of a feature and node, whatever the rows are; among
    splits of equal gain the first feature and smallest threshold wins.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"`{name}`").cast("double").alias("value")) for i, name in enumerate(features)])
    )
    sums = rows.select(*_NODE, "weight", "amount", cells.alias("cell")).groupBy(*_NODE, "cell.feature", "cell.value")
    sums = sums.agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("amount")).alias("s"))
    by_value = Window.partitionBy(*_NODE, "feature").orderBy("value")
    so_far, whole = by_value.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*_NODE, "feature")
    sums = sums.select(
        *_NODE, "feature", "value",
        F.lead("value").over(by_value).alias("next"),
        F.sum("w").over(so_far).alias("w_low"), F.sum("s").over(so_far).cast("double").alias("s_low"),
        F.sum("w").over(whole).alias("w"), F.sum("s").over(whole).cast("double").alias("s"),
    )
    w_high, s_high = F.col("w") - F.col("w_low"), F.col("s") - F.col("s_low")
    gain = (
        F.col("s_low") * F.col("s_low") / F.col("w_low")
        + s_high * s_high / F.when(w_high > 0, w_high)
        - F.col("s") * F.col("s") / F.col("w")
    )
    # The features a node may use: those with the smallest hashes.
    dealt = [F.struct(F.xxhash64(F.lit(seed), F.lit("feature"), *_NODE, F.lit(i)).alias("hash"), F.lit(i).alias("i")) for i in range(len(features))]
    allowed = F.transform(F.slice(F.array_sort(F.array(*dealt)), 1, wanted), lambda one: one["i"])
    # A gain below what doubles can tell is none.
    real = F.col("next").isNotNull() & (gain > F.abs(F.col("s") * F.col("s") / F.col("w")) * 1e-12)
    usable = real & F.array_contains(allowed, F.col("feature"))
    best = F.struct(gain.alias("gain"), (-F.col("feature")).alias("down"), (-F.col("value")).alias("low"), ((F.col("value") + F.col("next")) / 2).alias("at"))
    found = sums.groupBy(*_NODE).agg(
        F.max(F.when(usable, best)).alias("best"), F.first(F.col("s") / F.col("w")).alias("mean")
    )
    return found.select(*_NODE, (-F.col("best.down")).alias("feature"), F.col("best.at").alias("threshold"), "mean")


def _side(features: Sequence[str]) -> Column:
    """The child of a row's node: 2 n at or below the threshold, else 2 n + 1; NULL at a leaf."""
    value = F.get(F.array(*[F.col(f"`{name}`").cast("double") for name in features]), F.col("feature"))
    return F.when(F.col("feature").isNotNull(), F.col("node") * 2 + (value > F.col("threshold")).cast("int"))


def grow_forests(
    series: DataFrame,
    targets: Mapping[str, str],
    *,
    key: str,
    features: Sequence[str],
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    bootstrap: bool = True,
    feature_subset: str = "auto",
) -> DataFrame:
    """One forest per target: ``target, tree, node, feature, threshold, mean`` for every node.

    ``targets`` maps a column to the name of its prediction; a row without a target is not in that
    forest.  ``key`` names a row, whatever partition it is in.  A node is a leaf where ``feature`` is NULL.
    """
    ensure_checkpoint_dir(series.sparkSession)
    wanted = _subset(len(features), feature_subset)
    amounts = [F.struct(F.lit(name).alias("target"), F.col(column).cast(_AMOUNT).alias("amount")) for column, name in targets.items()]
    trees = F.explode(F.sequence(F.lit(0), F.lit(num_trees - 1)))
    rows = series.select(F.col(key).cast("string").alias("__key"), *features, F.explode(F.array(*amounts)).alias("__one"))
    rows = rows.select("__key", *features, "__one.*", trees.alias("tree")).where(F.col("amount").isNotNull())
    weight = bootstrap_weight(seed, F.col("tree"), F.col("__key")) if bootstrap else F.lit(1)
    rows = rows.withColumn("weight", weight).where("weight > 0").withColumn("node", F.lit(1).cast("bigint"))
    rows = rows.checkpoint()
    levels = []
    for depth in range(max_depth + 1):
        found = _splits(rows, features, wanted, seed)
        if depth == max_depth:
            found = found.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")})
        found = found.checkpoint()
        levels.append(found)
        inner = found.where(F.col("feature").isNotNull()).drop("mean")
        if depth == max_depth or inner.isEmpty():
            break
        rows = rows.join(inner, _NODE).withColumn("node", _side(features)).drop("feature", "threshold").checkpoint()
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole.checkpoint()


def apply_forests(
    nodes: DataFrame,
    frame: DataFrame,
    targets: Mapping[str, str],
    *,
    key: str,
    features: Sequence[str],
    num_trees: int = 100,
    max_depth: int = 10,
) -> DataFrame:
    """``key`` and a column per target: the mean of the leaves that a row falls into, over the trees.

    Rows walk down all trees at once, a join by node for each level.
    """
    places = [F.explode(F.sequence(F.lit(0), F.lit(num_trees - 1))).alias("tree"), F.lit(1).cast("bigint").alias("node")]
    rows = frame.select(F.col(key).alias("__key"), *features, F.explode(F.array(*map(F.lit, targets.values()))).alias("target"))
    rows = rows.select("*", *places).join(nodes, _NODE)
    leaves = rows.where(F.col("feature").isNull()).select("__key", "target", "tree", "mean")
    for _ in range(max_depth):
        moved = rows.where(F.col("feature").isNotNull()).withColumn("node", _side(features))
        rows = moved.select("__key", *features, *_NODE).join(nodes, _NODE)
        leaves = leaves.unionByName(rows.where(F.col("feature").isNull()).select(*leaves.columns))

    def mean(name: str) -> Column:
        # Rounded, so that the sum does not depend on its order.
        of_target = F.when(F.col("target") == name, F.col("mean").cast(_AMOUNT))
        return (F.sum(of_target).cast("double") / F.count(of_target)).alias(name)

    predicted = leaves.groupBy("__key").agg(*[mean(name) for name in targets.values()])
    return predicted.select(F.col("__key").alias(key), *targets.values())
