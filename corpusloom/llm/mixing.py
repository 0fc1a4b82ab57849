"""Problem 9: mixes in which every source has its share of the tokens.

Documents of a source are in the order of a random key (a hash of their id). The order is cut into ranges of keys, the
sums of the ranges are added up within each source, and each range is summed on its own from there: prefix sums without
one task for a source, however large. A source gives whole epochs while its budget lasts, and of the last one the
documents before the cut, the one on it if more than half of it fits. No document is used more than max_repeats times.

Documents without tokens (null, empty) and sources without a target take no part. A target without documents gives 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vec

#: Documents in a range of keys, about.
RANGE_DOCS = 2_000
_MOST_RANGES = 1 << 20


@dataclass(frozen=True)
class Mix:
    """members: mix_name, source, doc_id, n_tokens, uses; plan: each target's budget, epochs and rest."""

    members: DataFrame
    plan: DataFrame


def prefix_sums(sizes: DataFrame, id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """sizes (id, source, n_tokens) with before: the tokens of the source's documents earlier in random order."""
    n = sizes.count()
    ranges = 1 << min(max(n // RANGE_DOCS, 1).bit_length(), _MOST_RANGES.bit_length() - 1)
    keyed = sizes.withColumn("__key", F.xxhash64(F.lit(seed), id_col)).withColumn("__range", F.shiftrightunsigned("__key", 64 - ranges.bit_length() + 1) if ranges > 1 else F.lit(0).cast("long"))
    by_source = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most _MOST_RANGES rows
    offsets = keyed.groupBy("source", "__range").agg(F.sum("n_tokens").alias("__sum")).withColumn("__offset", F.coalesce(F.sum("__sum").over(by_source), F.lit(0))).drop("__sum")
    within = Window.partitionBy("source", "__range").orderBy("__key", id_col).rowsBetween(Window.unboundedPreceding, -1)
    summed = keyed.join(offsets, ["source", "__range"]).withColumn("before", F.col("__offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return summed.drop("__key", "__range", "__offset")


def mix(counted: DataFrame, targets: DataFrame, id_col: str = "doc_id") -> Mix:
    """counted: id, source, n_tokens of all documents; it is written once, to the shared folder.

    targets: mix_name, size_ratio, source, target_share, max_repeats; a table of fixed size, hence broadcast.
    """
    vec.shared_dir(counted.sparkSession)
    sizes = counted.select(id_col, "source", "n_tokens").where("n_tokens > 0").checkpoint()
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    everything = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("all_tokens"))
    plan = targets.dropDuplicates(["mix_name", "source"]).crossJoin(F.broadcast(everything)).join(totals, "source", "left")  # everything is one row
    plan = plan.withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0))).withColumn("mix_tokens", F.col("size_ratio") * F.col("all_tokens"))
    plan = plan.withColumn("budget", F.round(F.col("target_share") * F.col("mix_tokens")).cast("long"))
    whole = F.when(F.col("source_tokens") > 0, F.floor(F.col("budget") / F.col("source_tokens"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", F.least(whole, F.col("max_repeats").cast("long")))
    plan = plan.withColumn("rest", F.when(F.col("epochs") < F.col("max_repeats"), F.col("budget") - F.col("epochs") * F.col("source_tokens")).otherwise(F.lit(0)))
    ordered = prefix_sums(sizes.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi"), id_col)
    uses = F.col("epochs") + F.when((F.col("epochs") < F.col("max_repeats")) & (2 * F.col("before") + F.col("n_tokens") <= 2 * F.col("rest")), 1).otherwise(0)
    members = ordered.join(F.broadcast(plan.select("mix_name", "source", "epochs", "rest", "max_repeats")), "source")
    members = members.withColumn("uses", uses.cast("int")).where("uses > 0").select("mix_name", "source", id_col, "n_tokens", "uses")
    return Mix(members, plan.select("mix_name", "source", "target_share", "max_repeats", "budget", "source_tokens"))


def report(mixed: Mix) -> DataFrame:
    """mix_name, source, target_share, budget, documents, tokens, actual_share (of the mix as it is), most_uses."""
    used = mixed.members.groupBy("mix_name", "source").agg(F.count("*").alias("documents"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most_uses"))
    rows = mixed.plan.join(used, ["mix_name", "source"], "left").na.fill(0, ["documents", "tokens", "most_uses"])
    share = F.col("tokens") / F.sum("tokens").over(Window.partitionBy("mix_name"))  # a handful of rows in each mix
    return rows.withColumn("actual_share", share).select("mix_name", "source", "target_share", "actual_share", "budget", "tokens", "source_tokens", "documents", "max_repeats", "most_uses")
