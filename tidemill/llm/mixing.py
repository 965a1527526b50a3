"""Mixing sources to target weights (native: DataFrame functions only).

Sources form a tree: domain, language, source. Each node's weight is shared among its children; a leaf's target is the product down
its path. A node that has less than its target (its tokens times MAX_EPOCHS) takes what it has, and what it leaves is shared
among its siblings by weight, and only what all siblings cannot take goes to the siblings of their parent: budgets are
water-filled from the root, each node's capacity being that of its whole subtree. Then each leaf takes the prefix of its seeded
epochs: epoch e orders the leaf's documents by md5(seed, e, doc_id), and documents are taken while the tokens before them are
fewer than the leaf's budget.

Defined results: tokens are words; a null text has none; documents without tokens are never taken; null languages or
sources are "" (a leaf like any other); a repeated row is taken as often as it occurs; an empty table gives an empty result.
Clashing extra columns are left alone (helper columns begin with __mix_).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, documents, written

SEED = 17
SHARE = 0.5  # of all tokens
MAX_EPOCHS = 4
#: Weights of domains; a domain that isn't named weighs 1. Languages and sources of one parent weigh the same unless given.
DOMAIN_WEIGHTS = {"reference": 4, "forum": 2, "web": 1}
LANG_WEIGHTS = {"en": 3}
LEVELS = ("domain", "lang", "source")
DIGITS = 3  # hex digits of a document's place that are counted before any document is ordered


def domain_of(source: Column) -> Column:
    """The domain of a source, by its number: under 4 reference, under 10 forum, else web."""
    n = F.expr("try_cast(regexp_extract(__mix_source, '([0-9]+)$', 1) as int)")
    return F.when(n < 4, "reference").when(n < 10, "forum").otherwise("web")


def weight_of(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, v in weights.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out.cast("double")


def filled(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes (parent columns, name, w, cap, and the parent's budget as total) with budget: each parent's total shared by weight, no node above its cap."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = by.orderBy(F.col("cap") / F.col("w"), name).rowsBetween(Window.unboundedPreceding, -1)
    # In the order of cap / w: a node is full if the level that would serve it and all after it reaches its cap.
    x = nodes.withColumn("before_cap", F.coalesce(F.sum("cap").over(up), F.lit(0.0))).withColumn("before_w", F.coalesce(F.sum("w").over(up), F.lit(0.0)))
    x = x.withColumn("level", (F.col("total") - F.col("before_cap")) / (F.sum("w").over(by) - F.col("before_w")))
    x = x.withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    # Fullness is monotone in that order, so the first node that isn't full has the level of all that aren't.
    x = x.withColumn("share", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), F.col("level").alias("level")))).over(by)["level"])
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.col("share") * F.col("w"))).drop("before_cap", "before_w", "level", "full", "share", "total")


def budgets(leaves: DataFrame, total: Column, max_epochs: int) -> DataFrame:
    """leaves (domain, lang, source, tokens) with budget. A few rows a source, however many documents there are."""
    base = leaves.where("tokens > 0").withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    out = base.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    out = out.withColumn("total", total).withColumn("w", weight_of("domain", DOMAIN_WEIGHTS)).withColumn("total", F.least(F.col("total"), F.sum("cap").over(Window.partitionBy(F.lit(0)))))
    out = filled(out, [], "domain").select("domain", F.col("budget").alias("total"))
    langs = base.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("w", weight_of("lang", LANG_WEIGHTS)).join(out, "domain")
    langs = filled(langs, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("total"))
    leaf = base.withColumn("w", F.lit(1.0)).join(langs, ["domain", "lang"])
    return filled(leaf, ["domain", "lang"], "source").select(*LEVELS, "tokens", F.ceil("budget").cast("long").alias("budget"))


def select(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """docs, each taken document once for each of its epochs, with __mix_epoch, __mix_domain and __mix_tokens."""
    x = docs.withColumns({"__mix_tokens": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long"), "__mix_lang": F.coalesce(F.col(lang), F.lit("")), "__mix_source": F.coalesce(F.col(source), F.lit(""))})
    x = x.withColumn("__mix_domain", domain_of(F.col("__mix_source")))
    names = ["__mix_domain", "__mix_lang", "__mix_source"]
    key_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    light = x.where("__mix_tokens > 0").select(*[F.col(n).alias(n[6:]) for n in names], key_text.alias("id"), F.col("__mix_tokens").alias("tokens"))
    # Counts by leaf and first digits of a document's place, for each epoch: of bounded size for each leaf, made before any shuffle.
    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    place = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("id")))
    leaves = written(light.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    plan = budgets(leaves, F.lit(float(int(total * share))), max_epochs)
    plan = written(plan.withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "mix-budgets")
    hint = F.broadcast if plan.count() <= 100_000 else (lambda d: d)
    cut = light.join(hint(plan.where("rest > 0").select(*LEVELS, F.col("whole").alias("epoch"), "rest")), [*LEVELS]).withColumn("place", place).withColumn("head", F.substring("place", 1, DIGITS))
    heads = cut.groupBy(*LEVELS, "epoch", "rest", "head").agg(F.sum("tokens").alias("n"))
    up = Window.partitionBy(*LEVELS).orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("before", F.coalesce(F.sum("n").over(up), F.lit(0))).where("before < rest")
    edges = heads.groupBy(*LEVELS).agg(F.max_by(F.struct("head", "before"), "head").alias("e")).select(*LEVELS, F.col("e.head").alias("edge"), F.col("e.before").alias("before"))
    edges = written(edges, "mix-edges")
    # Only the documents that share the last head are ordered, about one in 16 ** DIGITS of a leaf.
    tail = cut.join(hint(edges), [*LEVELS]).where("head = edge")
    within = Window.partitionBy(*LEVELS).orderBy("place", "id").rowsBetween(Window.unboundedPreceding, -1)
    tail = tail.withColumn("seen", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).where("seen < rest")
    last = written(tail.groupBy(*LEVELS).agg(F.max(F.struct("place", "id")).alias("last")), "mix-last")
    marks = plan.select(*LEVELS, "whole", "rest").join(edges, [*LEVELS], "left").join(last, [*LEVELS], "left")
    marks = written(marks.select(*[F.col(c).alias(f"__mix_{c}") for c in LEVELS], F.col("whole").alias("__mix_whole"), F.col("rest").alias("__mix_rest"), F.col("edge").alias("__mix_edge"), F.col("last").alias("__mix_last")), "mix-marks")
    y = x.where("__mix_tokens > 0").join(hint(marks), names)
    own = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("__mix_whole").cast("string"), key_text))
    y = y.withColumn("__mix_place", own)
    more = (F.col("__mix_rest") > 0) & (F.struct(F.col("__mix_place").alias("place"), key_text.alias("id")) <= F.col("__mix_last"))
    n = F.col("__mix_whole") + F.when(more, 1).otherwise(0)
    y = y.where(n > 0).withColumn("__mix_epoch", F.explode(F.sequence(F.lit(0), n - 1)))
    return y.select(*[F.col(f"`{c}`") for c in docs.columns], "__mix_epoch", "__mix_domain", "__mix_tokens")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = select(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return x.select("doc_id", F.col("__mix_epoch").cast("int").alias("epoch"), F.col("__mix_domain").alias("domain"), "lang", "source", F.col("__mix_tokens").alias("n_tokens"))
