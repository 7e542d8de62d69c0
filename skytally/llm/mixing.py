"""Mixing sources to target weights: a budget of tokens handed down a tree of groups.

A node's budget goes to its children by weight.  A child that can't use its share (its texts, read
``max_epochs`` times, hold fewer tokens) takes what it can, and the rest goes to its siblings by
weight; a node's capacity is the sum of its children's, so only what all siblings together can't use
goes back to the level above.  Sorted by capacity per weight, the children that are filled come
first, so sums over a sorted window settle a whole level at once, in integers.

A leaf reads its texts in epochs, each in an own seeded order.  Whole epochs that the budget covers
are taken whole; of the next, the longest prefix of texts that fits.

Null group names are ''.  Null and empty texts have 0 tokens; they come with every epoch that is
taken.  Repeated rows are texts of their own that share one place in the order and enter together.
Weights not given are 1, a weight of 0 shuts a group out.  A zero budget or an empty table gives no
repeats.  Other columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import fresh, stored, word_count

TOKENS = "decimal(20,0)"


def _weight(weights: Mapping[str, int], name: str) -> Column:
    """A node's weight by its own name: ``weights`` is small, as it is written by hand."""
    found = F.lit(1)
    for value, weight in weights.items():
        found = F.when(F.col(name) == value, weight).otherwise(found)
    return found.cast("decimal(10,0)")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, int]], budget: Column) -> DataFrame:
    """The tokens of each leaf: ``leaves`` has the levels and ``capacity``; adds ``quota``.

    ``budget`` is a number, or a column that is the same in all rows.
    """
    nodes = leaves.withColumn("capacity", F.col("capacity").cast(TOKENS))
    for level, given in zip(levels, weights):
        nodes = nodes.withColumn("capacity", F.when(_weight(given, level) > 0, F.col("capacity")).otherwise(0).cast(TOKENS))
    nodes = nodes.withColumn("quota", budget.cast(TOKENS))
    for depth, level in enumerate(levels):
        above = [F.col(c) for c in levels[:depth]] or [F.lit(0)]
        own = [*levels[: depth + 1]]
        level_nodes = nodes.groupBy(*own).agg(
            F.sum("capacity").cast(TOKENS).alias("cap"), F.first("quota").alias("given")
        )
        level_nodes = level_nodes.withColumn("w", _weight(weights[depth], level)).filter("w > 0")
        order = Window.partitionBy(*above).orderBy(F.col("cap") / F.col("w"), level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        onward = order.rowsBetween(0, Window.unboundedFollowing)
        level_nodes = level_nodes.select(
            *own, "cap", "w", "given",
            F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(TOKENS).alias("used"),
            F.sum("w").over(onward).cast(TOKENS).alias("w_left"),
        )
        level_nodes = level_nodes.withColumn(
            "filled", F.expr("cap * cast(w_left as decimal(18,0)) <= (given - used) * w")
        )
        # What the filled children leave is shared by the others.
        everyone = Window.partitionBy(*above)
        level_nodes = level_nodes.select(
            *own, "cap", "w", "filled",
            (F.first("given").over(everyone) - F.coalesce(F.sum(F.when(F.col("filled"), F.col("cap"))).over(everyone), F.lit(0))).cast(TOKENS).alias("rest"),
            F.sum(F.when(~F.col("filled"), F.col("w"))).over(everyone).cast("decimal(18,0)").alias("w_rest"),
        )
        level_nodes = level_nodes.select(
            *own,
            F.expr("CASE WHEN filled THEN cap ELSE cast((rest * w) div w_rest as decimal(20,0)) END").alias("quota"),
        )
        nodes = nodes.drop("quota").join(level_nodes, own, "left").fillna(0, ["quota"])
    return nodes


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Sequence[Mapping[str, int]],
    share: tuple[int, int] = (1, 1),
    max_epochs: int = 2,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_rows: int = 1000,
    out: Sequence[str] = ("mix_group", "n_tokens", "repeats"),
) -> DataFrame:
    """``docs`` with its group (struct), ``n_tokens`` (words) and ``repeats``, how often the text is read.

    The whole budget is ``share`` (a fraction) of all tokens.  ``levels`` names the groups from the
    root down, with the expression of each.  ``out`` names the new columns; those of ``docs`` by these
    names are replaced.

    No group is ever ordered in one task: tokens are summed by prefix of the order's key, with as
    many prefixes as a leaf has thousands of rows, and only the one in which the budget ends is
    looked at row by row.
    """
    names = list(levels)
    slim = stored(
        docs.select(
            *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
            F.col(doc_id).cast("string").alias("id"),
            word_count(F.col(text)).alias("n"),
        ),
        "mix-tokens",
    )
    leaves = slim.groupBy(*names).agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    leaves = stored(leaves, "mix-leaves")
    whole = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("decimal(38,0)")).first()[0] or 0
    budget = int(whole) * share[0] // share[1]
    plan = budgets(
        leaves.withColumn("capacity", F.col("tokens") * max_epochs), names, weights, F.lit(budget)
    ).select(
        *names,
        F.expr("CASE WHEN tokens > 0 THEN int(quota div tokens) ELSE 0 END").alias("full"),
        F.expr("CASE WHEN tokens > 0 THEN bigint(quota % tokens) ELSE 0 END").alias("rest"),
        # 16 ** digits prefixes, each of about bucket_rows rows.
        F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("rows") / bucket_rows))).cast("int").alias("digits"),
    )
    plan = stored(plan, "mix-plan")
    part = slim.join(plan.filter("rest > 0"), names).withColumn("key", _key(seed, F.col("full"), F.col("id")))
    part = part.withColumn("prefix", F.expr("substring(key, 1, digits)"))
    sums = part.groupBy(*names, "prefix").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    ahead = Window.partitionBy(*names).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    # The one prefix in which the budget ends; what comes before it is taken whole.
    edge = sums.filter("before <= rest AND before + n > rest").select(*names, "prefix", "before")
    last = part.join(edge, [*names, "prefix"]).withColumn(
        "reached",
        F.col("before")
        + F.sum("n").over(
            Window.partitionBy(*names).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    cut = edge.join(
        last.filter("reached <= rest").groupBy(*names).agg(F.max("key").alias("key")), names, "left"
    ).select(*names, F.coalesce("key", "prefix").alias("cut"), F.col("key").isNotNull().alias("closed"))
    plan = stored(plan.join(cut, names, "left"), "mix-cut")

    group, at = fresh(docs, "at_group", "at_plan")
    keyed = docs.withColumn(
        group, F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()])
    )
    small = plan.select(F.struct(*names).alias(at), "full", "cut", "closed").select(
        at, F.struct("full", "cut", "closed").alias(f"{at}_row")
    )
    joined = keyed.join(small, F.col(group) == F.col(at), "left")
    key = _key(seed, F.col(f"{at}_row.full"), F.col(doc_id).cast("string"))
    taken = F.when(F.col(f"{at}_row.closed"), key <= F.col(f"{at}_row.cut")).otherwise(key < F.col(f"{at}_row.cut"))
    repeats = F.col(f"{at}_row.full") + F.coalesce(taken.cast("int"), F.lit(0))
    return joined.select(
        *[F.col(c) for c in docs.columns if c not in out],
        F.col(group).alias(out[0]),
        word_count(F.col(text)).alias(out[1]),
        repeats.cast("int").alias(out[2]),
    )


def _key(seed: str, epoch: Column, doc_id: Column) -> Column:
    """Place of a text in an epoch's order: uniform, and the same on every machine."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id, F.lit(""))).cast("binary"))


def mixed(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """Each text as often as it is read, with the columns of ``docs``; arguments as for ``mix``."""
    out = fresh(docs, "mix_group", "n_tokens", "repeats", "epoch")
    found = mix(docs, *args, out=out[:3], **kwargs).filter(F.col(out[2]) > 0)
    return found.withColumn(out[3], F.explode(F.sequence(F.lit(1), F.col(out[2])))).select(*docs.columns)
