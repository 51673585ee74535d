"""Mixing sources to target weights: temperature mixing, realised as budgeted permutations of blocks.

Each source's share of the tokens is raised to an exponent and normalised. The exponent, from 0 (uniform) to 1
(proportional), is bisected so that the weights' entropy is ``entropy`` times the largest possible; where a source
would then be repeated more than ``most_epochs`` times, it is bisected up to that limit. The budget is the corpus'
tokens, or with ``cover`` just enough that every source is passed once at least.

Every source is cut by a hash of the document ids into blocks of about ``block_tokens`` tokens, ``MOST_BLOCKS`` at
most. An epoch is a permutation of a source's blocks by a hash of seed, source, epoch and block. A source's budget
buys whole epochs and then, of the last one, the blocks in order whose middle lies within the rest. Only
tables of sources and of blocks are ranked; sources reach the driver only up to FEW_SOURCES, and documents meet their
blocks' rows in a join.

Rows: one for each document and epoch that it is in. Null sources are a source of their own. A null text counts as
empty, with no words; empty documents go with their blocks. Null ids share a block of each source; repeated rows
are all kept. A table without words has no rows. Other columns are ignored, or carried along by ``realised``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import WORD, stored

MOST_BLOCKS, FEW_SOURCES, STEPS = 4096, 100_000, 50


def words(text: str = "text") -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def digits(*parts: Column) -> Column:
    """The first 32 bits of the parts' MD5 digest, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def weights(tokens: np.ndarray, exponent: float) -> np.ndarray:
    p = (tokens / tokens.sum()) ** exponent
    return p / p.sum()


def bisect(flat: Callable[[float], bool], worn: Callable[[float], bool]) -> float:
    """The least exponent that makes the weights neither more even than asked (``flat``) nor repeats a source too often (``worn``)."""
    out = 0.0
    for over in (flat, worn):
        lo, hi = 0.0, 1.0
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if over(mid) else (lo, mid)
        out = max(out, hi if over(0.0) else 0.0)
    return out


def exponent(tokens: np.ndarray, entropy: float, most_epochs: float, cover: bool) -> float:
    """The exponent for the tokens of the sources that have any."""
    goal = entropy * np.log(len(tokens))

    def flat(a: float) -> bool:
        w = weights(tokens, a)
        return -(w * np.log(w)).sum() > goal

    def worn(a: float) -> bool:
        w = weights(tokens, a)
        budget = (tokens / w).max() if cover else tokens.sum()
        return (w * budget / tokens).max() > most_epochs

    return bisect(flat, worn)


def large_plan(total: DataFrame, entropy: float, most_epochs: float, cover: bool, block_tokens: int) -> DataFrame:
    """``source_plan`` for more sources than the driver should hold: each step of the bisection is one aggregate of the (_source, total) rows."""
    total = stored(total, "source-totals")
    n, whole = total.agg(F.count(F.lit(1)), F.sum("total")).first()
    p = F.col("total") / F.lit(float(whole))

    def sums(a: float) -> tuple[float, float, float, float]:
        """The sum of the powers, the weights' entropy, the most repeats of a source and the tokens that cover all."""
        w = F.pow(p, F.lit(a))
        z, log, most, least = total.agg(F.sum(w), F.sum(w * F.log(p)), F.max(w / F.col("total")), F.max(F.col("total") / w)).first()
        budget = z * least if cover else float(whole)
        return z, float(np.log(z) - a * log / z), most / z * budget, budget

    a = bisect(lambda a: sums(a)[1] > entropy * np.log(n), lambda a: sums(a)[2] > most_epochs)
    z = sums(a)[0]
    rows = total.select("_source", "total", F.round(F.pow(p, F.lit(a)) / F.lit(z), 9).alias("weight"))
    budget = rows.agg(F.max(F.col("total") / F.col("weight"))).first()[0] if cover else float(whole)
    bought = F.round(F.col("weight") * F.lit(budget)).cast("long")
    blocks = F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(float(block_tokens))))).cast("long")
    return stored(rows.select("_source", "total", "weight", (F.greatest("total", bought) if cover else bought).alias("budget"), blocks.alias("blocks")), "source-plan")


def named() -> Column:
    """The source, never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, _source, _tokens) of each document."""
    return docs.select("doc_id", "source", named().alias("_source"), words().alias("_tokens"))


def source_plan(tokens: DataFrame, entropy: float = 0.97, most_epochs: float = 4.0, cover: bool = False, block_tokens: int = 20_000, few: int = FEW_SOURCES) -> DataFrame:
    """(_source, total, weight, budget, blocks) of (_source, _tokens) rows, one for each source.

    Up to ``few`` sources go through the driver and come back to be broadcast; beyond, see ``large_plan``. A weight of
    less than 1e-9 is rounded to 0.
    """
    spark = tokens.sparkSession
    total = tokens.groupBy("_source").agg(F.sum("_tokens").alias("total")).where("total > 0")
    got = sorted((r["_source"], r["total"]) for r in total.limit(few + 1).collect())
    if len(got) > few:
        return large_plan(total, entropy, most_epochs, cover, block_tokens)
    schema = "_source string, total long, weight double, budget long, blocks long"
    if not got:
        return spark.createDataFrame([], schema)
    t = np.array([n for _, n in got], float)
    w = np.round(weights(t, exponent(t, entropy, most_epochs, cover)), 9) if len(got) > 1 else np.ones(1)
    whole = (t / w).max() if cover else t.sum()
    rows = [(s, n, float(x), round(x * whole), int(min(MOST_BLOCKS, max(1, -(-n // block_tokens))))) for (s, n), x in zip(got, w, strict=True)]
    if cover:  # rounding leaves no source short of one epoch
        rows = [(s, n, x, max(b, n), k) for s, n, x, b, k in rows]
    return F.broadcast(spark.createDataFrame(rows, schema))


def block_of(seed: int) -> Column:
    return F.pmod(digits(F.lit(f"block{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.col("blocks"))


def block_plan(placed: DataFrame, seed: int) -> DataFrame:
    """(_source, _block, epoch, rank) that are in the mixture, of rows (_source, _tokens, _block, total, budget); the windows hold a source's blocks."""
    blocks = placed.groupBy("_source", "_block").agg(F.sum("_tokens").alias("own"), F.first("total").alias("total"), F.first("budget").alias("budget"))
    epochs = F.explode(F.sequence(F.lit(1), F.ceil(F.col("budget") / F.col("total")).cast("int")))
    rows = blocks.where("budget > 0").withColumn("epoch", epochs)
    rows = rows.withColumn("spin", digits(F.lit(f"order{seed}"), F.col("_source"), F.col("epoch").cast("string"), F.col("_block").cast("string")))
    before = Window.partitionBy("_source", "epoch").orderBy("spin", "_block")
    rows = rows.withColumn("rank", F.row_number().over(before)).withColumn("past", F.sum("own").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("own"))
    left = F.col("budget") - (F.col("epoch") - 1) * F.col("total")
    return rows.where(2 * F.col("past") + F.col("own") <= 2 * left).select("_source", "_block", "epoch", F.col("rank").cast("long").alias("rank"))


def mixture(docs: DataFrame, seed: int = 0, **target: float) -> DataFrame:
    """(doc_id, source, n_tokens, weight, epoch, block, rank): the documents of (doc_id, source, text) rows in the mixture, ranked by block within each epoch of their source."""
    rows = stored(measured(docs), "measured")
    plan = source_plan(rows, **target)
    placed = rows.join(plan, "_source").withColumn("_block", block_of(seed))
    chosen = block_plan(placed, seed)
    return placed.join(chosen, ["_source", "_block"]).select("doc_id", "source", F.col("_tokens").alias("n_tokens"), "weight", F.col("epoch").cast("long").alias("epoch"), F.col("_block").alias("block"), "rank")


def realised(docs: DataFrame, seed: int = 0, few: int = 2_000_000, **target: float) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, text and others), each as often as the mixture has it."""
    counted = stored(measured(docs), "measured")
    plan = source_plan(counted, **target)
    placed = counted.join(plan, "_source").withColumn("_block", block_of(seed))
    times = stored(block_plan(placed, seed).groupBy("_source", "_block").agg(F.count(F.lit(1)).cast("int").alias("_times")), "block-plan")
    rows = docs.withColumn("_source", named()).join(plan.select("_source", "blocks"), "_source").withColumn("_block", block_of(seed))
    small = times.count() <= few  # at most MOST_BLOCKS for each source
    rows = rows.join(F.broadcast(times) if small else times, ["_source", "_block"])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)


def mixture_sql(entropy: float = 0.97, most_epochs: float = 4.0, block_tokens: int = 20_000, seed: int = 0) -> str:
    """DuckDB SQL for ``mixture`` over the table documents, without ``cover``."""
    return f"""
with recursive measured as (
  select doc_id, source, coalesce('=' || source, 'null') as s, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n from documents),
totals as (select s, sum(n)::bigint as total from measured group by s having sum(n) > 0),
shares as (select s, total, total::double / sum(total) over () as p, sum(total) over () as whole, count(*) over () as k from totals),
search(step, lo1, hi1, lo2, hi2) as (
  select 0, 0.0::double, 1.0::double, 0.0::double, 1.0::double
  union all
  select step + 1,
    case when flat then (lo1 + hi1) / 2 else lo1 end, case when flat then hi1 else (lo1 + hi1) / 2 end,
    case when worn then (lo2 + hi2) / 2 else lo2 end, case when worn then hi2 else (lo2 + hi2) / 2 end
  from (select step, lo1, hi1, lo2, hi2,
      (select -sum(w / z * ln(w / z)) > any_value({entropy} * ln(k)) from (select pow(p, (lo1 + hi1) / 2) as w, sum(pow(p, (lo1 + hi1) / 2)) over () as z, k from shares)) as flat,
      (select max(w / z * whole / total) > {most_epochs} from (select pow(p, (lo2 + hi2) / 2) as w, sum(pow(p, (lo2 + hi2) / 2)) over () as z, whole, total from shares)) as worn
    from search where step < {STEPS})),
exponent as (select greatest(
    case when (select any_value(ln(k)) > any_value({entropy} * ln(k)) from shares) then hi1 else 0 end,
    case when (select max(1.0 / k * whole / total) > {most_epochs} from shares) then hi2 else 0 end) as a from search where step = {STEPS}),
plan as (
  select s, total, weight, round(weight * whole)::bigint as budget, least({MOST_BLOCKS}, greatest(1, ceil(total / {block_tokens}.0)::bigint)) as blocks
  from (select s, total, whole, round(pow(p, a) / sum(pow(p, a)) over (), 9) as weight from shares, exponent)),
placed as (
  select doc_id, source, measured.s, n, weight, total, budget,
    ('0x' || substr(md5('block{seed}|' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint % blocks as block
  from measured join plan using (s)),
blocks as (select s, block, sum(n)::bigint as own, any_value(total) as total, any_value(budget) as budget from placed group by s, block),
epochs as (select *, unnest(range(1, ceil(budget::double / total)::bigint + 1)) as epoch from blocks where budget > 0),
spun as (select *, ('0x' || substr(md5('order{seed}|' || s || '|' || epoch || '|' || block), 1, 8))::bigint as spin from epochs),
ranked as (
  select *, row_number() over w as rank, sum(own) over (w rows unbounded preceding) - own as past
  from spun window w as (partition by s, epoch order by spin, block)),
chosen as (select s, block, epoch, rank from ranked where 2 * past + own <= 2 * (budget - (epoch - 1) * total))
select doc_id, source, n as n_tokens, weight, epoch, block, rank from placed join chosen using (s, block)"""
