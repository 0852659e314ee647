"""Mixing sources to target weights by temperature.

A source with token share p gets weight p^a / sum(p^a). The exponent a in [0, 1] is bisected until the weights have a
target entropy, or until no source is repeated more often than a limit. The weights are then realised in tokens: each
source passes its documents epoch by epoch, each epoch as a keyed permutation of blocks, until its budget is spent. The
result's ``mix_at`` in [0, 1) interleaves the sources, so that any prefix by it holds them at about their weights.

Blocks are the square root of a source's documents in number and size, so a source with a third of all rows is never
ordered in one task. Sources stay in a table (their number may grow); the bisection reads sums over it only.

Null is a source like any other. Texts without a word have no tokens: they cost nothing and come once per full epoch; a
source of such texts only has weight zero and passes once. Rows that share doc_id, source and text are one document that
passes with all its rows at once (``n_rows``); rows that share a doc_id only are documents of their own. Empty table:
empty result. Only the named columns are read, and further ones can have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .native import row_key, unused
from .store import stored
from .text import WORD


@dataclass(frozen=True)
class Target:
    """What the exponent must meet: ``entropy`` (in nats) of the weights, or ``repetition``, the most epochs a source
    may pass. ``tokens`` is the whole budget; without it, the smallest one that passes every source at least once."""

    entropy: float | None = None
    repetition: float | None = 2.0
    tokens: int | None = None


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(sized: DataFrame) -> DataFrame:
    """(source, docs, tokens, p) from rows of (source, n_tokens)."""
    sums = stored(
        sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")), "sources"
    )
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    return sums.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))


def _measures(sources: DataFrame, grid: list[float], target: Target, total: int, top: float) -> list:
    """Entropy and highest repetition of the weights for every exponent of ``grid``, in one pass over the sources."""
    a, p = F.col("a"), F.col("p")
    each = sources.where("p > 0").select("p", F.posexplode(F.array(*[F.lit(x) for x in grid])).alias("i", "a"))
    sums = each.groupBy("i", "a").agg(
        F.sum(p**a).alias("z"), F.sum(p**a * F.log(p)).alias("zl"), F.max(p ** (a - 1)).alias("most")
    )
    passes = F.col("most") * (target.tokens / total / F.col("z") if target.tokens else F.lit(top) ** (1 - a))
    entropy = F.log("z") - a * F.col("zl") / F.col("z")
    return sums.select("i", entropy.alias("entropy"), passes.alias("repetition")).orderBy("i").collect()


def exponent(sources: DataFrame, target: Target, rounds: int = 6, halvings: int = 5) -> float:
    """The exponent that meets the target; each round reads the table once for ``halvings`` halvings at once.

    Entropy and repetition fall as the exponent grows. A target that no exponent in [0, 1] meets gives the nearer end.
    """
    total, top = sources.agg(F.sum("tokens"), F.max("p")).first()
    if not total:
        return 1.0
    low, high, parts = 0.0, 1.0, 1 << halvings

    def too_low(found) -> bool:
        if target.entropy is not None:
            return found["entropy"] > target.entropy
        return found["repetition"] > target.repetition * (1 + 1e-12)

    for _ in range(rounds):
        grid = [low + (high - low) * i / parts for i in range(parts + 1)]
        found = _measures(sources, grid, target, total, top)
        at = next((i for i in range(parts + 1) if not too_low(found[i])), parts)
        low, high = grid[max(at - 1, 0)], grid[at]
    return high


def budgets(sources: DataFrame, target: Target) -> DataFrame:
    """(source, docs, tokens, weight, budget, epochs, rest): whole epochs, then ``rest`` tokens of one more."""
    a = exponent(sources, target)
    raw = F.when(F.col("p") > 0, F.col("p") ** F.lit(a)).otherwise(F.lit(0.0))
    z, total, top = sources.agg(F.sum(raw), F.sum("tokens"), F.max("p")).first()
    z, total = z or 1.0, total or 0
    whole = target.tokens or total * z * (top or 1.0) ** (1 - a)
    budget = F.round(raw / z * whole).cast("long")
    empty = F.col("tokens") == 0
    return sources.select(
        "source",
        "docs",
        "tokens",
        (raw / z).alias("weight"),
        budget.alias("budget"),
        F.when(empty, 1).otherwise(F.floor(budget / F.greatest("tokens", F.lit(1)))).cast("long").alias("epochs"),
        F.when(empty, 0).otherwise(budget % F.greatest("tokens", F.lit(1))).cast("long").alias("rest"),
    )


def mix(
    docs: DataFrame,
    target: Target = Target(),
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 17,
) -> DataFrame:
    """(doc_id, source, epoch, block, n_rows, n_tokens, token_at, mix_at): every passed document, once per epoch it is in.

    ``token_at``: tokens of its source before it.
    """
    return _mixed(docs, target, doc_id, source, text, seed).drop("unit")


def _unit(doc_id: str, source: str, text: str) -> Column:
    return row_key(F.col(doc_id), F.col(source), F.col(text))


def _mixed(docs: DataFrame, target: Target, doc_id: str, source: str, text: str, seed: int) -> DataFrame:
    each = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        _unit(doc_id, source, text).alias("unit"),
        tokens_of(F.col(text)).alias("n_tokens"),
    )
    sized = stored(
        each.groupBy("unit").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("source").alias("source"),
            F.count("*").alias("n_rows"),
            F.sum("n_tokens").alias("n_tokens"),
        ),
        "sizes",
    )
    plan = stored(budgets(shares(sized), target), "budgets").withColumnRenamed("source", "s")
    blocks_in = F.ceil(F.sqrt("docs"))
    dealt = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        *("unit", "doc_id", "source", "n_rows", "n_tokens"),
        F.pmod(F.xxhash64(F.lit(seed), "unit"), blocks_in).alias("block"),
        *("epochs", "rest", "tokens", "budget"),
    )
    key = [F.coalesce("source", F.lit("")).alias("k"), F.isnull("source").alias("k_null")]
    epochs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - (F.col("rest") == 0).cast("long")))
    passed = dealt.where((F.col("epochs") > 0) | (F.col("rest") > 0)).select("*", *key, epochs.alias("epoch"))

    in_epoch = Window.partitionBy("k", "k_null", "epoch").orderBy(
        F.xxhash64(F.lit(seed + 1), "epoch", "block"), "block"
    )
    blocks = (
        passed.groupBy("k", "k_null", "epoch", "block")
        .agg(F.sum("n_tokens").alias("held"), F.first("epochs").alias("e"), F.first("rest").alias("r"))
        .withColumn("block_at", F.sum("held").over(in_epoch) - F.col("held"))
        .where("epoch < e or block_at < r")
        .select("k", "k_null", "epoch", "block", "block_at")
    )
    in_block = (
        Window.partitionBy("k", "k_null", "epoch", "block")
        .orderBy(F.xxhash64(F.lit(seed + 2), "epoch", "unit"), "unit")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = passed.join(blocks, ["k", "k_null", "epoch", "block"]).withColumn(
        "at", F.col("block_at") + F.sum("n_tokens").over(in_block) - F.col("n_tokens")
    )
    token_at = F.col("epoch") * F.col("tokens") + F.col("at")
    return placed.where("epoch < epochs or at < rest").select(
        *("unit", "doc_id", "source", "epoch", "block", "n_rows", "n_tokens"),
        token_at.alias("token_at"),
        (token_at / F.greatest("budget", F.lit(1))).alias("mix_at"),
    )


def repeat_rows(
    docs: DataFrame,
    target: Target = Target(),
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 17,
) -> DataFrame:
    """``docs`` with every row as often as the mix passes it, with the columns of ``docs``, whatever their names are."""
    passes = _mixed(docs, target, doc_id, source, text, seed).groupBy("unit").agg(F.countDistinct("epoch").alias("n"))
    mine, theirs, n = (unused(x, docs) for x in ("mine", "theirs", "n_passes"))
    passes = passes.select(F.col("unit").alias(theirs), F.col("n").cast("int").alias(n))
    keyed = docs.withColumn(mine, _unit(doc_id, source, text)).join(passes, F.col(mine) == F.col(theirs))
    copies = F.sequence(F.lit(1), F.col(n))
    return keyed.drop(mine, theirs).withColumn(n, F.explode(copies)).drop(n)
