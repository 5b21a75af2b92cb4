"""Mixing sources to target weights by budgets over a tree.

The tree's levels are columns, from the root down (domain, language, source). The token budget is divided at each node
among its children by weight, none getting more than its supply (its tokens times EPOCHS): what a child cannot take goes
to its siblings by their weights, and only what all of them cannot take stays with the ancestors, whose other children
got it by the same rule. A leaf takes its documents in seeded order, a new order for each epoch: whole epochs first, then
the documents that begin before the rest of the budget is used up.

A child's weight is `weights[path]` where the parameter names its path, else its supply to the power ALPHA.

Cut points of hot leaves are found from sums over ranges of the order's hash; only the range with the cut is sorted, so
no task holds a leaf.

Defined cases: a NULL level is a child of its own, named as the empty string; a NULL or empty text has no tokens and is
taken with its epoch; a budget of 0 takes nothing, one beyond all supply takes every document EPOCHS times; rows that
repeat a document are taken one by one, equal rows together; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.session import materialise

EPOCHS, ALPHA, SEED = 2, 0.7, 17
#: Documents in a range of the hash order, and leaves up to which their table (fixed-width rows) is broadcast.
RANGE_ROWS, BROADCAST_LEAVES = 4096, 50_000
WORDS = r"[^\x20\x09-\x0D]+"


def budgets(leaves: DataFrame, levels: tuple[str, ...], total: float, weights: dict[tuple[str, ...], float] | None = None,
            epochs: int = EPOCHS, alpha: float = ALPHA) -> DataFrame:
    """Leaves (levels, supply) with the column budget."""
    known = weights or {}
    parents = leaves.agg(F.least(F.lit(float(total)), F.coalesce(F.sum("supply"), F.lit(0)) * float(epochs)).alias("budget"))
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        own = F.pow(F.col("supply").cast("double"), F.lit(alpha))
        for name, value in sorted(known.items()):
            if len(name) == depth:
                same = F.lit(True)
                for column, part in zip(path, name):
                    same = same & (F.col(column) == part)
                own = F.when(same, F.lit(float(value))).otherwise(own)
        nodes = leaves.groupBy(*path).agg(F.sum("supply").alias("supply")) \
            .withColumn("cap", F.col("supply") * float(epochs)).withColumn("w", own)
        nodes = nodes.join(parents, path[:-1]) if path[:-1] else nodes.crossJoin(F.broadcast(parents))  # one row
        # Children in the order in which they fill up; the rate of the first that does not is the highest of all.
        up = Window.partitionBy(*path[:-1]).orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).asc_nulls_last(), *path)
        before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
        rate = F.when(rest > 0, (F.col("budget") - before) / rest)
        nodes = nodes.withColumn("rate", rate) \
            .withColumn("rate", F.max("rate").over(Window.partitionBy(*path[:-1])))
        parents = nodes.select(*path, F.greatest(F.lit(0.0), F.least("cap", F.coalesce(F.col("w") * F.col("rate"), F.lit(0.0))))
                               .alias("budget"))
    return leaves.join(parents, list(levels))


def mix(docs: DataFrame, levels: dict[str, Column], total: float | None = None,
        weights: dict[tuple[str, ...], float] | None = None, epochs: int = EPOCHS, alpha: float = ALPHA, seed: int = SEED,
        key: str = "doc_id", text: str = "text", report: bool = True) -> DataFrame:
    """The documents taken, one row for each epoch that takes them; `total` defaults to all tokens there are.

    With `report`: key, the levels (named mix_<level>), n_tokens and epoch; without: the columns of `docs`.
    """
    names = tuple(f"mix_{n}" for n in levels)
    n_tokens = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("long")
    # The caller's columns travel inside one, so that no name of theirs can meet one used here.
    marked = docs.select(
        F.struct(*docs.columns).alias("row"), *(F.coalesce(c.cast("string"), F.lit("")).alias(f"mix_{n}") for n, c in levels.items()),
        F.xxhash64(F.col(text)).alias("mix_text"), F.col(key).alias("mix_key"), n_tokens.alias("tokens"))
    narrow = materialise(marked.select(*names, "mix_key", "mix_text", "tokens"))
    leaves = materialise(narrow.groupBy(*names).agg(F.sum("tokens").alias("supply"), F.count("*").alias("rows")))
    size = leaves.agg(F.count("*").alias("n"), F.max("rows").alias("most"), F.sum("supply").alias("supply")).first()
    total = float(size["supply"] or 0) if total is None else float(total)
    near = F.broadcast if size["n"] <= BROADCAST_LEAVES else (lambda df: df)
    shares = budgets(leaves.select(*names, "supply"), names, total, weights, epochs, alpha)
    whole = F.when(F.col("supply") > 0, F.floor(F.round(F.col("budget"), 6) / F.col("supply"))) \
        .otherwise(F.lit(epochs if total > 0 else 0))
    shares = materialise(shares.withColumn("full", whole.cast("int")).withColumn(
        "left", F.greatest(F.lit(0.0), F.round(F.col("budget"), 6) - F.col("full") * F.col("supply"))))
    place = F.xxhash64(F.lit(seed), F.col("full"), F.col("mix_key"), F.col("mix_text"))
    bits = max(0, ((size["most"] or 0) // RANGE_ROWS).bit_length())
    part = F.shiftrightunsigned(F.col("h"), 64 - bits) if bits else F.lit(0).cast("long")
    # Unsigned order of the hash throughout: by range first, by what is left of it next.
    placed = narrow.join(near(shares.select(*names, "full", "left")), list(names)).filter("left > 0") \
        .withColumn("h", place).withColumn("part", part).withColumn("h", F.col("h").bitwiseXOR(-(1 << 63)))
    sums = placed.groupBy(*names, "part").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("part"))
    cut = sums.withColumn("base", upto - F.col("tokens")).filter("base < left AND base + tokens >= left") \
        .select(*names, "part", "base")
    order = Window.partitionBy(*names, "part").orderBy("h", "mix_key", "mix_text") \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.join(near(cut), [*names, "part"]).withColumn("begin", F.col("base") + F.sum("tokens").over(order) - F.col("tokens"))
    last = F.struct("h", F.col("mix_key").alias("k"), F.col("mix_text").alias("t"))
    ends = inside.filter("begin < left").groupBy(*names).agg(F.max(last).alias("mix_end"))
    plan = materialise(shares.join(ends, list(names), "left").select(
        *names, F.col("full").alias("mix_full"), F.col("left").alias("mix_left"), "mix_end"))
    mine = F.xxhash64(F.lit(seed), F.col("mix_full"), F.col("mix_key"), F.col("mix_text")).bitwiseXOR(-(1 << 63))
    more = (F.col("mix_left") > 0) & (F.struct(mine.alias("h"), F.col("mix_key").alias("k"), F.col("mix_text").alias("t"))
                                      <= F.col("mix_end"))
    source = marked if not report else narrow
    taken = source.join(near(plan), list(names)).withColumn(
        "mix_times", F.col("mix_full") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)).filter("mix_times > 0") \
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("mix_times") - 1)))
    if not report:
        return taken.select("row.*")
    return taken.select(F.col("mix_key").alias(key), *names, F.col("tokens").alias("n_tokens"),
                        F.col("mix_epoch").cast("int").alias("epoch"))
