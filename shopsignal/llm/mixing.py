"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain > language > source; a leaf is one (domain, language, source). Every node
has a weight among its siblings and a capacity: the tokens that its leaves can give in
``epochs`` passes. Budgets go down the tree. Among siblings the budget is spread by weight; a
node whose capacity is short gets all it can give, and the shortage is spread over the other
siblings by their weights. A node's budget never exceeds the capacity below it, so a shortage
is made up by siblings first and reaches an ancestor's siblings only when they are exhausted.

Each leaf puts its documents in one seeded order per epoch and takes the longest prefix whose
tokens fit the budget: whole epochs first, then a prefix of the next. The end of a prefix is
one key of that order for each leaf and epoch. It is found from sums over 4,096 hash ranges
of each leaf; only the rows of the one range that holds the end are put in order. No leaf's
documents are ever sorted or gathered.

All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsignal.llm.common import record, unpack, whole_text, written

EPOCHS = 2
SEED = 20
#: Weights are leaf sizes to this power: small sources gain on large ones.
TEMPERATURE = 0.7
#: The budget as a share of the tokens there are.
BUDGET_SHARE = 1.0
_RANGE_BITS = 12
TREE = ["domain", "lang", "source"]


def tokens_of(text: Column) -> Column:
    """Tokens for budgeting: words between ASCII spaces, one at least, so that no row is free."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source: here one of four by the first hex digit of the MD5 of its name."""
    digit = F.conv(F.substring(F.md5(source.cast("binary")), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("domain"), (digit % 4).cast("string"))


def spread(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Spread each parent's ``budget`` over its children by ``weight``, capped by ``capacity``: adds ``share``.

    Children are ordered by capacity / weight. Those before some place get their capacity, all
    later ones share the rest by weight: a child is full exactly if the rest of the budget times
    its weight reaches its capacity times the rest of the weights. All numbers are integers, so
    the shares are exact (rounded down).
    """
    names = [c for c in TREE if c in nodes.columns]
    order = Window.partitionBy(*parents).orderBy((F.col("capacity") / F.col("weight")).alias("level"), *names)
    before, siblings = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parents)
    big = lambda c: c.cast("decimal(19,0)")  # noqa: E731  products of two fit 38 digits
    n = (nodes.withColumn("seq", F.row_number().over(order))
         .withColumn("rest", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
         .withColumn("open", F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    n = n.withColumn("full", big(F.col("rest")) * big(F.col("weight")) >= big(F.col("capacity")) * big(F.col("open")))
    # the first child that is not full sets what it and all behind it share
    first = F.min(F.when(~F.col("full"), F.struct("seq", "rest", "open"))).over(siblings)
    n = n.withColumn("first", first).withColumn(
        "part", F.expr("cast(first.rest as decimal(19,0)) * cast(weight as decimal(19,0)) div cast(first.open as decimal(19,0))"))
    return n.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(F.col("part"))).drop(
        "seq", "rest", "open", "full", "first", "part")


def leaf_budgets(leaves: DataFrame, budget: int, epochs: int = EPOCHS, temperature: float = TEMPERATURE) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens[, weight]) with each leaf's ``budget`` in tokens.

    Without a column ``weight`` a leaf's weight is tokens ** ``temperature``, in thousandths; an
    inner node's weight is the sum of its leaves'. The total is ``budget``, at most the capacity of all.
    """
    if "weight" not in leaves.columns:
        power = F.pow(F.col("tokens").cast("double"), F.lit(temperature))
        leaves = leaves.withColumn("weight", F.round(power * 1000).cast("long"))
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    sums = [F.sum("weight").alias("weight"), F.sum("capacity").alias("capacity")]
    langs = leaves.groupBy("domain", "lang").agg(*sums)
    most = leaves.agg(F.sum("capacity")).first()[0] or 0
    domains = langs.groupBy("domain").agg(*sums).withColumns(
        {"all": F.lit(1), "budget": F.lit(min(budget, most)).cast("long")})
    domains = spread(domains, ["all"]).select("domain", F.col("share").alias("budget"))
    langs = spread(langs.join(domains, "domain"), ["domain"]).select("domain", "lang", F.col("share").alias("budget"))
    out = spread(leaves.join(langs, ["domain", "lang"]), ["domain", "lang"])
    return out.select(*TREE, "tokens", "capacity", "weight", F.col("share").alias("budget"))


def _named(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    text = whole_text(text_col)
    return docs.select(
        *more, domain_of(name(source_col)).alias("domain"), name(lang_col).alias("lang"), name(source_col).alias("source"),
        F.col(id_col).cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("print"), tokens_of(text).alias("n_tokens"))


def _key(epoch: Column, seed: int) -> Column:
    """Place of a row in its leaf's order of one epoch: 60 bits of a hash of seed, epoch, id and text."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.col("print"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _place(key: Column) -> Column:
    """Total order of a leaf's rows: key, then id, then text."""
    return F.struct(key.alias("key"), F.col("doc_id").isNotNull().alias("has"), "doc_id", "print")


def choose(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", budget_share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: int = SEED,
           temperature: float = TEMPERATURE, weights: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(leaves, cuts). leaves: domain, lang, source, tokens, capacity, weight, budget, whole (epochs
    taken whole). cuts: domain, lang, source, epoch, last (the greatest key taken, as a struct).

    ``weights`` (domain, lang, source, weight: integers > 0) replaces the temperature's weights; a leaf
    that it lacks gets no budget.
    """
    rows = written(_named(docs, id_col, text_col, lang_col, source_col), "mixing-rows")
    leaves = written(rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens")), "leaf-tokens")
    have = leaves.agg(F.sum("tokens")).first()[0] or 0
    if weights is not None:
        leaves = leaves.join(weights.select(*TREE, "weight"), TREE)
    leaves = leaf_budgets(leaves, int(have * budget_share), epochs, temperature)
    leaves = leaves.withColumn("whole", F.expr("budget div tokens"))
    leaves = written(leaves.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "leaves")
    # sums over hash ranges of the epoch that is not taken whole
    todo = rows.join(_small(leaves.where("rest > 0").select(*TREE, "whole", "rest")), TREE)
    todo = todo.withColumn("key", _key(F.col("whole"), seed)).withColumn(
        "bin", F.shiftright("key", 60 - _RANGE_BITS))
    bins = todo.groupBy(*TREE, "whole", "rest", "bin").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*TREE).orderBy("bin")
    bins = bins.withColumn("upto", F.sum("n").over(upto))
    ends = written(bins.where("upto - n <= rest and upto > rest").select(
        *TREE, "bin", (F.col("rest") - F.col("upto") + F.col("n")).alias("left")), "ends")
    # the one range with the end: the longest prefix that fits
    within = todo.join(_small(ends), [*TREE, "bin"]).groupBy(*TREE, "left", _place(F.col("key")).alias("place")).agg(
        F.sum("n_tokens").alias("n"))
    run = Window.partitionBy(*TREE).orderBy("place")
    within = within.withColumn("upto", F.sum("n").over(run)).where("upto <= left")
    inside = within.groupBy(*TREE).agg(F.max("place").alias("inside"))
    cuts = leaves.where("rest > 0").select(*TREE, F.col("whole").alias("epoch")).join(ends, TREE, "left").join(
        inside, TREE, "left")
    return leaves, written(cuts.select(*TREE, "epoch", "bin", "inside"), "cuts")


def _small(df: DataFrame, bound: int = 200_000) -> DataFrame:
    """A side with a row per leaf: broadcast if it has at most ``bound`` rows, else left to the planner."""
    return F.broadcast(df) if df.count() <= bound else df


def _chosen(named: DataFrame, leaves: DataFrame, cuts: DataFrame, epochs: int, seed: int) -> DataFrame:
    """Rows of ``named`` once for every epoch in which they are taken (column ``epoch``)."""
    plan = written(leaves.select(*TREE, "whole").join(cuts, TREE, "left"), "mixing-plan")
    joined = named.join(_small(plan), TREE)
    key = _key(F.col("epoch"), seed)
    bin_ = F.shiftright(key, 60 - _RANGE_BITS)
    taken = (F.col("n_epoch") < F.col("whole")) | F.coalesce(
        (F.col("n_epoch") == F.col("epoch")) & ((bin_ < F.col("bin")) | (bin_ == F.col("bin")) & (_place(key) <= F.col("inside"))),
        F.lit(False))
    every = F.explode(F.sequence(F.lit(0), F.least(F.col("whole"), F.lit(epochs - 1)).cast("int"))).alias("n_epoch")
    return joined.select("*", every).where(taken)


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", epochs: int = EPOCHS, seed: int = SEED, **settings) -> DataFrame:
    """One row per chosen row and epoch: doc_id, epoch, domain, lang, source, n_tokens, budget.

    A document counts its words, at least 1, so empty and null texts can be chosen too. Null
    languages and sources are leaves named by the empty string. Rows that are equal in id and
    text share a place in the order and are taken together or not at all. An empty table gives no rows.
    """
    leaves, cuts = choose(docs, id_col, text_col, lang_col, source_col, epochs=epochs, seed=seed, **settings)
    named = _named(docs, id_col, text_col, lang_col, source_col)
    out = _chosen(named, leaves, cuts, epochs, seed)
    return out.join(_small(leaves.select(*TREE, "budget")), TREE).select(
        "doc_id", F.col("n_epoch").cast("long").alias("epoch"), *TREE, "n_tokens", "budget")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source", epochs: int = EPOCHS, seed: int = SEED, **settings) -> DataFrame:
    """The chosen rows of ``docs`` with all their columns, once for every epoch that takes them (see ``assign``)."""
    leaves, cuts = choose(docs, id_col, text_col, lang_col, source_col, epochs=epochs, seed=seed, **settings)
    named = _named(docs, id_col, text_col, lang_col, source_col, record(docs))
    return unpack(_chosen(named, leaves, cuts, epochs, seed), docs.columns)


def oracle_sql(budget_share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: int = SEED,
               temperature: float = TEMPERATURE) -> str:
    """``assign`` over the table documents, as DuckDB SQL: one ordered window per leaf and epoch."""
    def level(name: str, source: str, parents: str, names: str) -> str:
        by = f"PARTITION BY {parents}"
        order = f"{by} ORDER BY capacity / weight, {names}"
        before = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return f"""
{name}_a AS (SELECT *, row_number() OVER ({order}) AS seq,
    budget - coalesce(sum(capacity) OVER ({before}), 0) AS rest,
    sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({before}), 0) AS open FROM {source}),
{name}_b AS (SELECT *, rest::HUGEINT * weight >= capacity::HUGEINT * open AS is_full FROM {name}_a),
{name}_c AS (SELECT *, min(seq) FILTER (NOT is_full) OVER ({by}) AS turn FROM {name}_b),
{name}_d AS (SELECT *, max(rest) FILTER (seq = turn) OVER ({by}) AS rest1, max(open) FILTER (seq = turn) OVER ({by}) AS open1
    FROM {name}_c),
{name} AS (SELECT {names}, CASE WHEN is_full THEN capacity ELSE rest1::HUGEINT * weight // open1 END::BIGINT AS share
    FROM {name}_d)"""

    return f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, md5(coalesce(text, '')) AS print,
        greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS n_tokens,
        'domain' || (('0x' || substr(md5(coalesce(source, '')), 1, 1))::INT % 4) AS domain FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {epochs})::BIGINT AS capacity,
    round(pow(sum(n_tokens)::DOUBLE, {temperature}) * 1000)::BIGINT AS weight FROM d GROUP BY ALL),
lang AS (SELECT domain, lang, sum(capacity)::BIGINT AS capacity, sum(weight)::BIGINT AS weight FROM leaf GROUP BY ALL),
dom AS (SELECT 1 AS one, domain, sum(capacity)::BIGINT AS capacity, sum(weight)::BIGINT AS weight,
    (SELECT least(floor(sum(tokens) * {budget_share}), sum(capacity)) FROM leaf)::BIGINT AS budget FROM lang GROUP BY domain),
{level("s1", "dom", "one", "domain").lstrip()},
lang2 AS (SELECT lang.*, share AS budget FROM lang JOIN s1 USING (domain)),{level("s2", "lang2", "domain", "domain, lang")},
leaf2 AS (SELECT leaf.*, share AS budget FROM leaf JOIN s2 USING (domain, lang)),{level("s3", "leaf2", "domain, lang", "domain, lang, source")},
p AS (SELECT domain, lang, source, share AS budget, share // tokens AS whole, share % tokens AS rest
    FROM s3 JOIN leaf USING (domain, lang, source)),
e AS (SELECT d.*, p.budget, p.whole, p.rest, unnest(range({epochs})) AS epoch FROM d JOIN p USING (domain, lang, source)),
k AS (SELECT *, md5('{seed}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '') || ':' || print) AS h FROM e WHERE epoch <= whole),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch
    ORDER BY substr(h, 1, 15), doc_id NULLS FIRST, print) AS upto FROM k)
SELECT doc_id, epoch, domain, lang, source, n_tokens, budget FROM o WHERE epoch < whole OR upto <= rest"""
