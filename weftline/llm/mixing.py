"""Mixing sources to target weights (5): hierarchical budgets and seeded token-prefixes.

The tree is domain, language, source. Weights propagate from the top: a node's budget is shared among its
children by weight, and what a child can't use (its tokens times `max_epochs`) goes to its siblings by weight
before anything returns to the level above. A leaf then takes whole epochs and the token-prefix of one more:
its documents in the order of a seeded hash, as long as they fit.

The sharing is closed-form: children ordered by capacity over weight are full as long as that ratio is at most
(budget left) / (weight left), which window functions tell. All of it is exact integer arithmetic; shares are rounded
down, and what that leaves (under a token a child) isn't dealt out. The prefix
of a leaf of any size comes from sums over 4096 hash buckets; single rows are ordered in the bucket alone in
which the budget ends, and the outcome is a threshold of the hash, so no text is shuffled.

Cases: null domain, language or source is the node named by the empty string; a null text has the one token
that ends each document; documents that share a doc_id share their hash and are taken together or not at all;
a node without a given weight has `default`; an empty table gives no rows; other columns are
kept by mix_documents() and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import WORD, written

LEVELS = ["domain", "language", "origin"]


@dataclass(frozen=True)
class Mix:
    domains: Mapping[str, int] = field(default_factory=dict)
    languages: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    share: tuple[int, int] = (3, 5)  # of the tokens there are
    max_epochs: int = 2
    seed: int = 17
    #: Domain of a source, as SQL: here its number (of a long one the last nine digits) mod 4.
    domain: str = "coalesce('d' || pmod(try_cast(right(regexp_extract(source, '([0-9]+)$', 1), 9) as int), 4), '')"


PRODUCTION = Mix(domains={"d0": 4, "d1": 3, "d2": 2, "d3": 1}, languages={"en": 5, "fr": 2, "de": 2}, sources={"src0": 2})


def _weight(names: Mapping[str, int], col: str, default: int) -> Column:
    out = F.lit(default)
    for name, w in sorted(names.items()):
        out = F.when(F.col(col) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(18,0)")


def leaves_of(docs: DataFrame, mix: Mix) -> DataFrame:
    """docs with domain, language and origin."""
    return docs.withColumns({"domain": F.expr(mix.domain), "language": F.coalesce("lang", F.lit("")), "origin": F.coalesce("source", F.lit(""))})


def n_tokens() -> Column:
    return (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) + 1).cast("long")


def share_out(nodes: DataFrame, parents: list[str], weight: Column) -> DataFrame:
    """nodes (with budget of the parent and cap) -> budget of each, at most its cap."""
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    name = LEVELS[len(parents)]
    nodes = nodes.withColumn("weight", weight)
    # by capacity over weight: the whole part, then the fraction, which doubles tell apart for weights under 2**26
    whole, fraction = F.expr("cap div weight"), F.expr("cap % weight").cast("double") / F.col("weight").cast("double")
    order = by.orderBy(whole, fraction, F.col("cap"), F.col(name))
    nodes = nodes.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nodes = nodes.withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    full = F.col("cap") * F.col("weight_left") <= F.col("weight") * F.col("left")
    nodes = nodes.withColumn("full", full)
    # the first child that isn't full sets the rate of all that follow
    first = order.rowsBetween(Window.unboundedPreceding, 0)
    rate = lambda c: F.first(F.when(~F.col("full"), F.col(c)), ignorenulls=True).over(first)
    nodes = nodes.withColumn("rate_left", rate("left")).withColumn("rate_weight", rate("weight_left"))
    budget = F.when(F.col("rate_left").isNull(), F.col("cap")).otherwise(F.expr("cast((weight * rate_left) div rate_weight as decimal(19,0))"))
    return nodes.withColumn("budget", budget).select(*LEVELS[: len(parents) + 1], "budget")


def budgets(slim: DataFrame, mix: Mix) -> DataFrame:
    """domain, language, origin, avail, budget for each leaf of slim (with n_tokens)."""
    leaf = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("avail"))
    leaf = leaf.withColumn("cap", (F.col("avail") * mix.max_epochs).cast("decimal(19,0)"))
    total = F.expr(f"cast((sum(avail) * {mix.share[0]}) div {mix.share[1]} as decimal(19,0))")
    above = leaf.groupBy().agg(total.alias("budget"))
    above = leaf.groupBy("domain").agg(F.sum("cap").cast("decimal(19,0)").alias("cap")).crossJoin(F.broadcast(above))  # one row
    above = share_out(above, [], _weight(mix.domains, "domain", mix.default))
    above = leaf.groupBy("domain", "language").agg(F.sum("cap").cast("decimal(19,0)").alias("cap")).join(above, "domain")
    above = share_out(above, ["domain"], _weight(mix.languages, "language", mix.default))
    shared = share_out(leaf.select(*LEVELS, "cap").join(above, ["domain", "language"]), ["domain", "language"], _weight(mix.sources, "origin", mix.default))
    return leaf.drop("cap").join(shared, LEVELS).withColumn("budget", F.least(F.col("budget"), F.col("avail") * mix.max_epochs).cast("long"))


def _key(mix: Mix) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def cuts(slim: DataFrame, mix: Mix) -> DataFrame:
    """domain, language, origin, epochs (whole ones) and last (the greatest hash of the further epoch's prefix)."""
    leaf = budgets(slim, mix).withColumn("epochs", F.expr("budget div avail")).withColumn("rest", F.expr("budget % avail"))
    leaf = written(leaf, "op5-leaves", slim=True)
    rows = slim.join(leaf.where(F.col("rest") > 0), LEVELS).withColumn("key", _key(mix)).select(*LEVELS, "rest", "key", "n_tokens", F.substring("key", 1, 3).alias("bucket"))
    sums = rows.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("n"), F.max("key").alias("last"))
    upto = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("n").over(upto))
    whole = sums.where(F.col("upto") <= F.col("rest")).groupBy(*LEVELS).agg(F.max("last").alias("whole"))
    ends = sums.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest"))).select(*LEVELS, "bucket", (F.col("upto") - F.col("n")).alias("base"))
    single = rows.join(ends, [*LEVELS, "bucket"])
    ties = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    single = single.withColumn("at", F.col("base") + F.sum("n_tokens").over(ties)).where(F.col("at") <= F.col("rest")).groupBy(*LEVELS).agg(F.max("key").alias("single"))
    return leaf.join(whole, LEVELS, "left").join(single, LEVELS, "left").select(*LEVELS, "epochs", F.greatest("whole", "single").alias("last"))


def choose(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, text, lang, source (and _row, if given) with domain, language, origin and n_copies, those with none left out."""
    with_leaves = leaves_of(docs.select(*(c for c in ("doc_id", "text", "lang", "source", "_row") if c in docs.columns)), mix)
    slim = written(with_leaves.select("doc_id", *LEVELS, n_tokens().alias("n_tokens")), "op5-slim")
    ends = written(cuts(slim, mix), "op5-cuts", slim=True)
    chosen = with_leaves.join(ends, LEVELS)
    copies = F.col("epochs") + F.coalesce((_key(mix) <= F.col("last")).cast("long"), F.lit(0))
    return chosen.withColumn("n_copies", copies).where("n_copies > 0").drop("epochs", "last")


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The chosen rows of docs, with its columns; a row of n epochs comes n times."""
    names = docs.columns
    held = docs.select(F.struct(*names).alias("_row"), "doc_id", "text", "lang", "source")
    chosen = choose(held, mix)
    if mix.max_epochs > 1:
        chosen = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    return chosen.select("_row.*")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return choose(docs, PRODUCTION).select("doc_id", "domain", "language", "origin", n_tokens().alias("n_tokens"), "n_copies")


def _case(names: Mapping[str, int], col: str, default: int) -> str:
    return "CASE " + col + "".join(f" WHEN '{k}' THEN {v}" for k, v in sorted(names.items())) + f" ELSE {default} END"


def _level(src: str, parents: str, name: str, weight: str) -> str:
    """share_out() in DuckDB; src has the parents, name, cap and budget."""
    part = f"PARTITION BY {parents}" if parents else ""
    keys = f"{parents}, {name}" if parents else name
    return f"""(
  SELECT {keys}, CASE WHEN rl IS NULL THEN cap ELSE (weight * rl) // rw END AS budget FROM (
    SELECT *, first_value(CASE WHEN NOT f THEN lft END IGNORE NULLS) OVER u AS rl, first_value(CASE WHEN NOT f THEN wl END IGNORE NULLS) OVER u AS rw FROM (
      SELECT *, cap * wl <= weight * lft AS f FROM (
        SELECT *, budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
          sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
        FROM (SELECT *, CAST({weight} AS HUGEINT) AS weight FROM {src})
        WINDOW o AS ({part} ORDER BY cap // weight, CAST(cap % weight AS DOUBLE) / CAST(weight AS DOUBLE), cap, {name})))
    WINDOW u AS ({part} ORDER BY cap // weight, CAST(cap % weight AS DOUBLE) / CAST(weight AS DOUBLE), cap, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


def mix_sql(mix: Mix, table: str) -> str:
    """CTEs in DuckDB up to `chosen` (doc_id, domain, language, origin, n_tokens, n_copies) over a table of documents."""
    return f"""
docs5 AS (
  SELECT *, coalesce('d' || (TRY_CAST(right(regexp_extract(source, '([0-9]+)$', 1), 9) AS INT) % 4), '') AS domain, coalesce(lang, '') AS language,
    coalesce(source, '') AS origin, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + 1 AS n_tokens FROM {table}
), leaf AS (
  SELECT domain, language, origin, CAST(sum(n_tokens) AS HUGEINT) AS avail, CAST(sum(n_tokens) * {mix.max_epochs} AS HUGEINT) AS cap FROM docs5 GROUP BY ALL
), total AS (SELECT CAST(sum(avail) * {mix.share[0]} AS HUGEINT) // {mix.share[1]} AS budget FROM leaf),
l0 AS (SELECT domain, CAST(sum(cap) AS HUGEINT) AS cap, any_value(budget) AS budget FROM leaf, total GROUP BY domain),
b0 AS (SELECT * FROM {_level("l0", "", "domain", _case(mix.domains, "domain", mix.default))}),
l1 AS (SELECT domain, language, CAST(sum(cap) AS HUGEINT) AS cap, any_value(budget) AS budget FROM leaf JOIN b0 USING (domain) GROUP BY domain, language),
b1 AS (SELECT * FROM {_level("l1", "domain", "language", _case(mix.languages, "language", mix.default))}),
l2 AS (SELECT domain, language, origin, cap, budget FROM leaf JOIN b1 USING (domain, language)),
b2 AS (SELECT * FROM {_level("l2", "domain, language", "origin", _case(mix.sources, "origin", mix.default))}),
ends AS (SELECT *, least(budget, cap) // avail AS epochs, least(budget, cap) % avail AS rest FROM b2 JOIN leaf USING (domain, language, origin)),
keyed AS (SELECT docs5.*, epochs, rest, md5('{mix.seed}:' || CAST(epochs AS BIGINT) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM docs5 JOIN ends USING (domain, language, origin)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY key) AS upto FROM keyed),
chosen AS (SELECT * EXCLUDE (epochs, rest, key, upto), CAST(epochs + CAST(upto <= rest AS INT) AS BIGINT) AS n_copies FROM summed WHERE epochs + CAST(upto <= rest AS INT) > 0)"""


OP5_SQL = f"WITH {mix_sql(PRODUCTION, 'documents')} SELECT doc_id, domain, language, origin, CAST(n_tokens AS BIGINT) AS n_tokens, n_copies FROM chosen"
