"""Mixing sources to target weights by Poisson replication, with built-in expressions only.

A document of a source with rate r (mean copies wanted) is repeated k times, where k inverts the Poisson
distribution of mean r at a number in [0, 1) made from a seeded hash of its id: the same seed gives the
same mixture on any cluster. The copies are then dealt to partitions and ordered there by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

#: Hexadecimal digits of a hash that make a uniform number: 52 bits, exact in a double.
DIGITS = 13
#: Rate tables up to this many sources are broadcast; larger ones meet the rows by a salted join.
BROADCAST_SOURCES = 20_000
SALTS = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts joined by colons; null parts read as ``null``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2 ... copies, as far as doubles tell them from 1."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.lit(0.0).alias("logf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all"))

    def step(acc: Column, k: Column) -> Column:
        logf = acc["logf"] + F.when(k > 0, F.log(k.cast("double"))).otherwise(0.0)
        total = acc["sum"] + F.exp(k * F.log(rate) - rate - logf)
        return F.struct(logf.alias("logf"), total.alias("sum"), F.array_append(acc["all"], total).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), last), start, step, lambda acc: acc["all"])).otherwise(F.array(F.lit(1.0)))


def source_rates(documents: DataFrame, weights: dict[str | None, float] | None, power: float, ratio: float) -> DataFrame:
    """source, rate: mean copies of a document so that sources reach their target share of the text.

    A source's size is its characters plus one per document. Targets are ``weights`` (sources not named
    get none), or the sizes raised to ``power``. ``ratio`` is the wanted size of the mixture over the input's.
    """
    size = F.sum(F.length(F.coalesce("text", F.lit(""))) + 1).alias("size")
    sizes = documents.select("source", "text").groupBy("source").agg(size)
    if weights is None:
        target = F.pow(F.col("size").cast("double"), F.lit(float(power)))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("source").eqNullSafe(F.lit(name)), float(weight)).otherwise(target)
    sizes = materialize(sizes.withColumn("target", target), "source-sizes")
    all_size, all_target = sizes.agg(F.sum("size"), F.sum("target")).first()
    rate = F.lit(float(ratio)) * F.col("target") / F.lit(float(all_target or 1)) * F.lit(int(all_size or 0)) / F.col("size")
    return sizes.select(F.col("source").alias("__mix_source"), rate.alias("rate"))


def mix_sources(documents: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, ratio: float = 1.0,
                seed: int = 17) -> DataFrame:
    """``documents`` repeated to the target weights and shuffled: all columns, plus copy_no (from 1) and mix_order.

    A null source is a source of its own; a null id hashes as the word null (so such rows are repeated alike);
    empty texts count one character; equal rows are repeated alike. No weight at all, or an empty table, gives no
    rows. Input columns named like the added ones are replaced.

    Rates come from one combinable sum per source. They are broadcast while they are at most
    ``BROADCAST_SOURCES`` rows (counted), else joined on (source, salt), so that no task gets a whole source.
    The copies' text moves once, in the global shuffle by hash.
    """
    documents = documents.drop("copy_no", "mix_order")
    rates = materialize(source_rates(documents, weights, power, ratio).where("rate > 0").select("__mix_source", poisson_cdf(F.col("rate")).alias("__mix_cdf")), "mix-rates")
    same = F.col("source").eqNullSafe(F.col("__mix_source"))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = documents.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        rated = documents.withColumn("__mix_own", salt).join(salted, same & (F.col("__mix_own") == F.col("__mix_salt"))).drop("__mix_own", "__mix_salt")
    drawn = uniform(F.lit(seed), F.col("doc_id"))
    copies = F.size(F.filter("__mix_cdf", lambda c: c <= F.col("__mix_drawn")))
    rows = rated.withColumn("__mix_drawn", drawn).withColumn("__mix_copies", copies).where("__mix_copies > 0").drop("__mix_source", "__mix_cdf", "__mix_drawn")
    rows = rows.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))).drop("__mix_copies")
    rows = rows.withColumn("mix_order", uniform(F.lit(seed + 1), F.col("doc_id"), F.col("copy_no")))
    return rows.repartition("mix_order").sortWithinPartitions("mix_order")


ORACLE_SQL = f"""
WITH sized AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
targets AS (SELECT source, size, pow(size::DOUBLE, 0.5) AS target FROM sized),
rates AS (SELECT source, target / (SELECT sum(target) FROM targets) * (SELECT sum(size) FROM targets) / size AS rate FROM targets),
terms AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p
          FROM rates, LATERAL (SELECT unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
drawn AS (SELECT *, ('0x' || substr(md5('17:' || doc_id), 1, {DIGITS}))::BIGINT::DOUBLE / {16**DIGITS}.0 AS u FROM documents),
counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
                   (SELECT count(*) FROM cdf WHERE cdf.source = d.source AND cdf.c <= d.u) AS copies FROM drawn d),
copied AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INTEGER AS copy_no FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy_no,
       ('0x' || substr(md5('18:' || doc_id || ':' || copy_no), 1, {DIGITS}))::BIGINT::DOUBLE / {16**DIGITS}.0 AS mix_order
FROM copied
"""
