"""Mixing sources to target weights over a domain - language - source tree.

Every node has a weight (1 unless given). A token budget is handed down from the root:
the children of a node share its budget in proportion to their weights, none takes more
than its subtree can supply (tokens times ``epochs``), and what one cannot take goes to
its siblings; only when all of them are full does a shortage reach the node above. The
shares of saturated and unsaturated children are found in closed form by running sums
over the children ordered by supply per weight, so a level is two window functions over
a table with one row per node, whatever the number of documents.

A leaf then reads whole epochs of its documents and, of one more epoch, a prefix in a
seeded order: documents ordered by the MD5 of seed, epoch and doc_id, the last one cut
so that the leaf's tokens come out exactly. For the running token sums a leaf is cut
into ranges of that hash of about ``RANGE_ROWS`` rows; ranges are summed first, so a
leaf with a third of all documents is many small windows and not one.

Token: a run of characters other than 0x20 and 0x09-0x0D.

Defined cases: null text has no tokens; null language or source is a node of its own;
documents without tokens take nothing and are part of every epoch that starts; rows
that repeat a doc_id are separate documents. Weights of zero or less get nothing. A
budget beyond all supply fills every leaf. An empty table gives an empty result. Extra
columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.plans.scratch import scratch_dir

SEED, EPOCHS = 17, 4
RANGE_ROWS = 4096
HASH_SPACE = 1 << 60
LEVELS = ("domain", "lang", "source")
_BETWEEN, _INSIDE = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
ADDED = ("domain", "n_tokens", "leaf_budget", "full_epochs", "taken_tokens")


def token_count(text: str = "text") -> Column:
    """Number of words: starts of a run, counted by the characters that end one."""
    runs = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[^\\x20\\x09-\\x0D]+", "x")
    return F.length(F.regexp_replace(runs, "[\\x20\\x09-\\x0D]+", "")).cast("long")


def domain_of(source: str = "source") -> Column:
    """The domain of the test data's sources: by the last digit of their name, in four."""
    digit = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9])$", 1)
    return F.concat(F.lit("domain"), (F.coalesce(digit.try_cast("int"), F.lit(0)) % 4).cast("string"))


def _weight(nodes: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1).cast("long")
    for name, w in weights.items():
        out = F.when(nodes == name, F.lit(max(0, w)).cast("long")).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Children with ``supply``, ``weight`` and the parent's ``budget``: adds ``got``.

    In order of supply per weight, a child is full when its supply is at most its share
    of what the earlier ones leave; all later children are unsaturated and share the
    remainder. Remainders of the division go one token each to the first by name.
    """
    order = [(F.col("supply") / F.col("weight")).asc(), *(F.col(c).asc_nulls_first() for c in LEVELS if c in nodes.columns)]
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.where("weight > 0")
    stepped = (
        nodes.withColumn("taken", F.coalesce(F.sum("supply").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "is_full",
            F.col("supply").cast("decimal(38,0)") * F.col("left_weight")
            <= F.greatest(F.col("budget") - F.col("taken"), F.lit(0)).cast("decimal(38,0)") * F.col("weight"),
        )
        # the first that is not full ends the full ones
        .withColumn("is_full", F.min("is_full").over(group.orderBy(*order)))
    )
    rest = (
        stepped.withColumn("full_supply", F.coalesce(F.sum(F.when(F.col("is_full"), F.col("supply"))).over(group), F.lit(0)))
        .withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(group), F.lit(0)))
        .withColumn("rest", F.greatest(F.col("budget") - F.col("full_supply"), F.lit(0)))
        .withColumn(
            "part",
            F.when(F.col("is_full"), F.col("supply")).otherwise(
                F.expr("cast((cast(rest as decimal(38,0)) * weight) div open_weight as bigint)")
            ),
        )
    )
    names = [F.col(c).asc_nulls_first() for c in LEVELS if c in nodes.columns]
    odd = rest.withColumn(
        "odd", F.col("rest") - F.coalesce(F.sum(F.when(~F.col("is_full"), F.col("part"))).over(group), F.lit(0))
    ).withColumn("nth", F.row_number().over(group.orderBy(F.col("is_full").asc(), *names)))
    got = F.col("part") + F.when(~F.col("is_full") & (F.col("nth") <= F.col("odd")), 1).otherwise(0)
    return odd.withColumn("got", got).drop(
        "taken", "left_weight", "is_full", "full_supply", "open_weight", "rest", "part", "odd", "nth", "budget"
    )


def leaf_budgets(
    leaves: DataFrame, budget: int | str, epochs: int = EPOCHS, weights: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with ``leaf_budget``.

    ``budget``: tokens, or an expression over ``all_tokens``, the tokens of all leaves.
    """
    weights = weights or {}
    # a leaf below a weight of zero can take nothing, so it is no supply of the nodes above either
    open_ = F.least(*(_weight(F.col(c), weights.get(c, {})) for c in LEVELS)) > 0
    leaves = leaves.withColumn("supply", F.when(open_, F.col("tokens") * epochs).otherwise(F.lit(0)))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("all_tokens")).select(
        (F.lit(budget) if isinstance(budget, int) else F.expr(budget)).cast("long").alias("budget")
    )
    handed = None
    for depth in range(1, len(LEVELS) + 1):
        path = list(LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(F.col(path[-1]), weights.get(path[-1], {})))
        if handed is None:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            up = handed.select(*(F.col(c).alias(f"__{c}") for c in path[:-1]), F.col("got").alias("budget"))
            same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in path[:-1]]
            nodes = nodes.join(up, same).drop(*(f"__{c}" for c in path[:-1]))
        handed = _share(nodes, path[:-1])
    own = handed.select(*(F.col(c).alias(f"__{c}") for c in LEVELS), F.col("got").alias("leaf_budget"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LEVELS]
    return leaves.join(own, same, "left").select(*LEVELS, "tokens", F.coalesce("leaf_budget", F.lit(0)).alias("leaf_budget"))


def _order(epoch: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed, epoch and doc_id."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mixed(
    docs: DataFrame,
    budget: int | str,
    epochs: int = EPOCHS,
    seed: int = SEED,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    domain: Column | None = None,
) -> DataFrame:
    """``docs`` with domain, n_tokens, leaf_budget, full_epochs and taken_tokens."""
    spark = docs.sparkSession
    # one key that is never null, so that joins and windows share a shuffle
    leaf = F.to_json(F.struct(*LEVELS))
    base = (
        docs.drop(*ADDED)
        .withColumn("domain", domain_of() if domain is None else domain)
        .withColumn("n_tokens", token_count())
        .withColumn("__leaf", leaf)
    )
    sizes = base.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    folder = scratch_dir(spark, "mixing")
    sizes.write.parquet(f"{folder}/sizes")
    sizes = spark.read.schema(sizes.schema).parquet(f"{folder}/sizes")
    plan = (
        leaf_budgets(sizes.drop("docs"), budget, epochs, weights)
        .withColumn("__leaf", leaf)
        .join(sizes.select(leaf.alias("__leaf"), "docs"), "__leaf")
        .withColumn(
            "full_epochs", F.when(F.col("tokens") > 0, F.expr("leaf_budget div tokens")).otherwise(F.lit(0))
        )
        .withColumn("__part", F.col("leaf_budget") - F.col("full_epochs") * F.col("tokens"))
        .withColumn("__width", F.expr(f"({HASH_SPACE} div ((docs + {RANGE_ROWS - 1}) div {RANGE_ROWS})) + 1"))
        .select("__leaf", "leaf_budget", "full_epochs", "__part", "__width")
    )
    # written, so that its size is known when the documents are joined with it
    plan.write.parquet(f"{folder}/plan")
    plan = spark.read.schema(plan.schema).parquet(f"{folder}/plan")
    placed = (
        base.join(plan, "__leaf")
        .withColumn("__u", _order(F.col("full_epochs") + 1, seed))
        .withColumn("__range", F.expr("__u div __width"))
    )
    earlier = Window.partitionBy("__leaf").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("__leaf", "__range").agg(F.sum("n_tokens").alias("__sum"))
    ranges = ranges.select(
        "__leaf", "__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before")
    )
    inside = (
        Window.partitionBy("__leaf", "__range")
        .orderBy("__u", "doc_id", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = placed.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    left = F.col("__part") - F.col("__before") - F.col("__in")
    partial = F.greatest(F.lit(0), F.least(F.col("n_tokens"), left))
    return (
        summed.join(ranges, ["__leaf", "__range"])
        .withColumn("taken_tokens", F.col("full_epochs") * F.col("n_tokens") + partial)
        .select(*(c for c in docs.columns if c not in ADDED), *ADDED)
    )


def token_prefix(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th token."""
    # each piece is a token and the separators after it; separators before the first are one more
    pieces = F.split(text, f"(?<={_BETWEEN})(?={_INSIDE})")
    led = F.length(F.regexp_replace(F.substring(text, 1, 1), _BETWEEN, "")) == 0
    taken = F.array_join(F.slice(pieces, F.lit(1), (n + led.cast("int")).cast("int")), "")
    return F.regexp_replace(taken, f"{_BETWEEN}+$", "")


def repeated_by_epoch(docs: DataFrame, budget: int | str, **options) -> DataFrame:
    """The documents of every epoch with the columns of ``docs``: one row for each time one is read.

    A document that the budget cuts is cut to its token prefix the last time, and its
    n_chars, if there is that column, follows.
    """
    kept = docs.withColumn("__row", F.struct(*docs.columns))
    got = mixed(kept, budget, **options)
    rest = F.col("taken_tokens") - F.col("full_epochs") * F.col("n_tokens")
    times = F.col("full_epochs") + (rest > 0).cast("int")
    rows = got.where(times > 0).select(
        "__row", rest.alias("__rest"), "full_epochs", "n_tokens", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("__nth")
    )
    is_cut = (F.col("__nth") > F.col("full_epochs")) & (F.col("__rest") < F.col("n_tokens"))
    text = F.col("__row")["text"]
    rows = rows.withColumn("__text", F.when(is_cut, token_prefix(text, F.col("__rest"))).otherwise(text))
    new = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        n_chars = F.col("__row")["n_chars"]
        new["n_chars"] = F.when(is_cut, F.length("__text").cast(docs.schema["n_chars"].dataType)).otherwise(n_chars)
    return rows.select(*((new[c] if c in new else F.col("__row")[c]).alias(c) for c in docs.columns))
