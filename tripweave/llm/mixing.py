"""Mixing sources to target weights.

Sources are the leaves of a tree (domain, language, source). A token budget flows from
the root: children share their parent's budget by weight, up to what each can give. What
a child cannot give goes to its siblings; only what a whole family cannot give is missing
in its parent, and so goes to the parent's siblings. A leaf gives the prefix of its
documents' tokens in seeded orders, one order an epoch.

Everything is DataFrame operations on whole numbers, so every run chooses alike.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import settled

LEAF = ("domain", "lang", "source")
SLICES = 4096  # parts of a leaf's order; a part is added up by itself, so no leaf is ordered in one task
WORD = r"[^ \t\n\x0B\f\r]"  # fixed value: a character of a word
DIGITS = 15  # hexadecimal digits of the order


@dataclass(frozen=True)
class Recipe:
    """Weights by name on each level (1 where none is given), the budget and the epochs.

    The budget is ``share`` hundredths of all tokens; a leaf gives at most ``epochs`` times its own.
    """

    domains: Mapping[str, int] = field(default_factory=lambda: {"d0": 4, "d1": 3, "d2": 2, "d3": 1})
    languages: Mapping[str, int] = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 2})
    sources: Mapping[str, int] = field(default_factory=dict)
    share: int = 80
    epochs: int = 2
    seed: int = 7


def _weight(name: str, weights: Mapping[str, int]):
    chosen = F.lit(1).cast("long")
    for value, weight in weights.items():
        chosen = F.when(F.col(name) == value, F.lit(weight).cast("long")).otherwise(chosen)
    return chosen


def _leaf_columns() -> dict:
    """Expressions over documents: domain, lang, source and tokens."""
    source = F.coalesce("source", F.lit("unknown"))
    domain = F.concat(F.lit("d"), F.conv(F.substring(F.md5(source), 1, 1), 16, 10).cast("int") % 4)
    tokens = F.coalesce(F.regexp_count("text", F.lit(f"{WORD}+")), F.lit(0)).cast("long")
    return {"domain": domain, "lang": F.coalesce("lang", F.lit("unknown")), "source": source, "tokens": tokens}


def tokens_of(docs: DataFrame) -> DataFrame:
    """``doc_id, domain, lang, source, tokens``; a missing language or source is one called "unknown".

    Tokens are the words between white space. A source's domain comes from a hash of its name.
    """
    return docs.select("doc_id", *(column.alias(name) for name, column in _leaf_columns().items()))


def shared(children: DataFrame, family: tuple[str, ...], name: str, weights: Mapping[str, int]) -> DataFrame:
    """``children`` with ``share``: each family's ``budget`` dealt out by weight, none above its ``capacity``.

    In the order of capacity over weight the children that give all they have come first.
    """
    own = Window.partitionBy(*family) if family else Window.partitionBy(F.lit(0))
    fullest = own.orderBy(F.col("capacity") / F.col("weight"), name)
    weighed = children.withColumn("weight", _weight(name, weights))
    before = F.coalesce(F.sum("capacity").over(fullest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fullest.rowsBetween(0, Window.unboundedFollowing))
    spent = weighed.withColumn("before", before).withColumn("rest", rest)
    gives_all = F.expr("capacity * rest <= (budget - before) * weight")
    marked = spent.withColumn("gives_all", gives_all)
    given = F.sum(F.when(F.col("gives_all"), F.col("capacity")).otherwise(0)).over(own)
    sharing = F.sum(F.when(F.col("gives_all"), 0).otherwise(F.col("weight"))).over(own)
    dealt = marked.withColumn("given", given).withColumn("sharing", sharing)
    share = F.expr("CASE WHEN gives_all THEN capacity ELSE ((budget - given) * weight) div sharing END")
    return dealt.withColumn("share", share).drop("weight", "before", "rest", "gives_all", "given", "sharing")


def budgets(tokens: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``domain, lang, source, own, budget`` per leaf that has tokens."""
    leaves = tokens.where("tokens > 0").groupBy(*LEAF).agg(F.sum("tokens").alias("own"))
    leaves = leaves.withColumn("capacity", F.col("own") * recipe.epochs)
    levels = [leaves]
    for depth in (2, 1):
        levels.insert(0, levels[0].groupBy(*LEAF[:depth]).agg(F.sum("capacity").alias("capacity"), F.sum("own").alias("own")))
    total = levels[0].agg(F.floor(F.sum("own") * recipe.share / 100).cast("long").alias("budget"))
    weights = (recipe.domains, recipe.languages, recipe.sources)
    budget = levels[0].join(F.broadcast(total))  # one row
    for depth, level in enumerate(levels):
        if depth:
            budget = level.join(budget, list(LEAF[:depth]))
        budget = shared(budget, LEAF[:depth], LEAF[depth], weights[depth])
        if depth < 2:
            budget = budget.select(*LEAF[: depth + 1], F.col("share").alias("budget"))
    return budget.select(*LEAF, "own", F.col("share").alias("budget"))


def _order(seed: int, epoch):
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def mixed(tokens: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``doc_id, domain, lang, source, epoch, tokens, taken_tokens`` of every document taken, once per epoch.

    Epochs that fit into a leaf's budget are taken whole. Of the next, documents are taken
    in its order until the budget is spent; of the last one only ``taken_tokens``. A
    document without tokens is never taken; a null id is ordered as an empty one.
    """
    # both are written: texts are read once, and the engine knows how small the table of leaves is
    tokens = settled(tokens, "tokens")
    rows = tokens.where("tokens > 0").join(settled(budgets(tokens, recipe), "budgets"), list(LEAF))
    last = F.expr("least(budget div own, CAST({} AS BIGINT))".format(recipe.epochs - 1))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("left", F.expr("budget - epoch * own")).where("left > 0")
    whole = rows.where("left >= own").withColumn("taken_tokens", F.col("tokens"))
    part = rows.where("left < own").withColumn("place", _order(recipe.seed, F.col("epoch")))
    part = part.withColumn("slice", F.expr(f"place div {16**DIGITS // SLICES}"))
    sums = part.groupBy(*LEAF, "slice").agg(F.sum("tokens").alias("in_slice"), F.first("left").alias("spend"))
    earlier = Window.partitionBy(*LEAF).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0))).where("ahead < spend")
    part = part.join(sums.select(*LEAF, "slice", "ahead"), [*LEAF, "slice"])
    within = Window.partitionBy(*LEAF, "slice").orderBy("place", "doc_id", "tokens")
    start = F.col("ahead") + F.coalesce(F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = part.withColumn("taken_tokens", F.least(F.col("tokens"), F.col("left") - start)).where("taken_tokens > 0")
    columns = ["doc_id", *LEAF, "epoch", "tokens", "taken_tokens"]
    return whole.select(*columns).unionByName(part.select(*columns))


def kept(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """The rows of ``docs`` that a recipe of one epoch takes, whole and with all their columns.

    Only the last place that each leaf takes is joined to the documents. That table has a
    row for each leaf; the engine broadcasts it below its own threshold and otherwise
    splits the leaves of many documents.
    """
    taken = mixed(tokens_of(docs), recipe).withColumn("place", _order(recipe.seed, F.col("epoch")))
    key = F.struct("place", F.col("doc_id").alias("id"))
    cuts = taken.groupBy(*LEAF).agg(F.max(key).alias("cut"))
    cuts = settled(cuts.select(*(F.col(c).alias(f"leaf_{c}") for c in LEAF), "cut"), "cuts")
    own = {name: column for name, column in _leaf_columns().items() if name != "tokens"}
    # a row travels as one struct, so that its columns may have any names
    labelled = docs.where(F.col("text").rlike(WORD)).select(
        F.struct("*").alias("row"),
        *(column.alias(name) for name, column in own.items()),
        F.struct(_order(recipe.seed, F.lit(0)).alias("place"), F.col("doc_id").alias("id")).alias("at"),
    )
    same = [F.col(c) == F.col(f"leaf_{c}") for c in LEAF]
    joined = labelled.join(cuts, same[0] & same[1] & same[2])
    return joined.where(F.col("at") <= F.col("cut")).select("row.*")
