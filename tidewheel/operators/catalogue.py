"""Catalogue operators: lookups, coverage, upserts and merges as functions from old tables to new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.values import blank, matches_source, percent

PIXELS, BANDS = range(1, 20), range(8)


def by_group(obs: DataFrame, group: str | None, source: str | None = None, least: int | None = 7000, most: int | None = 1_000_000, strict: bool = False) -> DataFrame:
    """Observations of a group within inclusive id bounds (None: no bound); any other group means Galactic or Foreground unless ``strict``."""
    if group in ("SkyDip", "Calibrator") or strict:
        own = F.col("source_group") == group
    else:
        own = F.col("source_group").isin("Galactic", "Foreground")
    rows = obs.where(own & matches_source(F.col("source"), source))
    rows = rows if least is None else rows.where(F.col("obsid") >= least)
    return rows if most is None else rows.where(F.col("obsid") <= most)


def by_ids(obs: DataFrame, ids: DataFrame, least: int = 7000) -> DataFrame:
    """Observations whose id is in a table of ids, however long."""
    return obs.where(F.col("obsid") >= least).join(ids.select("obsid").distinct(), "obsid", "left_semi")


def missing_paths(obs: DataFrame, by: str, least: int = 0) -> DataFrame:
    """Rows, missing paths and their percentage for each group, and a TOTAL row."""
    rows = obs.where(F.col("obsid") >= least).select(F.coalesce(by, F.lit("Unknown")).alias("grp"), blank(F.col("level2_path")).cast("bigint").alias("miss"))
    out = rows.rollup("grp").agg(F.count(F.lit(1)).alias("total"), F.sum("miss").alias("missing"), F.grouping("grp").alias("_all"))
    return out.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("grp")).alias("grp"), "total", "missing", percent(F.col("missing"), F.col("total")).alias("pct"))


def coverage(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """For each group (null kept): rows, distinct observations and the share of non-null values of each column."""
    return rows.groupBy(by).agg(F.countDistinct("obsid").alias("n_obs"), F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(F.col(c).isNotNull().cast("double")), 6).alias(f"has_{c}") for c in columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """``old`` with the non-null values of ``new`` put over it; unknown columns of ``new`` are ignored. One full outer join."""
    shared = [c for c in new.columns if c in old.columns and c not in keys]
    change = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in shared])
    rows = old.withColumn("_was", F.lit(True)).join(change, keys, "full_outer")

    def value(c: str) -> Column:
        v = F.coalesce(f"_new_{c}", c) if c in shared else F.col(c)
        if defaults and c in defaults:
            v = F.when(F.col("_was").isNull(), F.coalesce(v, defaults[c])).otherwise(v)
        return v.alias(c)

    return rows.select(*[F.col(c) if c in keys else value(c) for c in old.columns])


def merge(primary: DataFrame, secondary: DataFrame, keys: list[str], prefer: str = "primary") -> DataFrame:
    """Both databases' rows over their shared columns; where both have a value, the preferred one's counts."""
    shared = [c for c in primary.columns if c in secondary.columns and c not in keys]
    a = primary.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in shared])
    b = secondary.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in shared])
    order = ("_a_", "_b_") if prefer == "primary" else ("_b_", "_a_")
    return a.join(b, keys, "full_outer").select(*keys, *[F.coalesce(*(F.col(p + c) for p in order)).alias(c) for c in shared])


def flag_grid(obs: DataFrame) -> DataFrame:
    """One row for each observation, pixel and band."""
    return obs.select("obsid", F.explode(F.array(*[F.lit(p).cast("bigint") for p in PIXELS])).alias("pixel")).select("obsid", "pixel", F.explode(F.array(*[F.lit(b).cast("bigint") for b in BANDS])).alias("band"))


def missing_flags(obs: DataFrame, flags: DataFrame) -> DataFrame:
    """Grid cells that have no flag row yet, good by default."""
    return flag_grid(obs).join(flags.select("obsid", "pixel", "band"), ["obsid", "pixel", "band"], "left_anti").withColumn("is_good", F.lit(True))


def remap_paths(obs: DataFrame, old: str, new: str) -> DataFrame:
    """Paths that begin with ``old`` begin with ``new`` instead; trailing slashes of both are dropped first."""
    old, new = old.rstrip("/"), new.rstrip("/")
    hit = F.col("level2_path").startswith(old)
    return obs.withColumn("level2_path", F.when(hit, F.concat(F.lit(new), F.substring("level2_path", len(old) + 1, 1 << 20))).otherwise(F.col("level2_path")))


def reconcile(obs: DataFrame, files: DataFrame) -> DataFrame:
    """Each id as missing (no file), remapped (another path), matched, new path or orphan (no observation)."""
    both = obs.select("obsid", "level2_path", F.lit(True).alias("_o")).join(files.select("obsid", F.col("path").alias("found"), F.lit(True).alias("_f")), "obsid", "full_outer")
    state = F.when(F.col("_o").isNull(), "orphan").when(blank(F.col("level2_path")) & F.col("_f").isNull(), "absent").when(F.col("_f").isNull(), "missing").when(blank(F.col("level2_path")), "backfill").when(F.col("level2_path") == F.col("found"), "matched").otherwise("remapped")
    return both.select("obsid", "level2_path", "found", state.alias("state"))


def flag_ranges(text: DataFrame) -> DataFrame:
    """Observer flags as (first, last, pixels, bands): an empty end means the start alone, ``ongoing`` any later id."""
    end = F.lower(F.trim(F.coalesce("obsid_end", F.lit(""))))
    pix = F.coalesce("pixels", F.lit("All"))
    numbers = F.transform(F.regexp_extract_all(pix, F.lit(r"(\d+)")), lambda x: x.cast("bigint"))
    bands = F.when(F.col("sidebands") == "All", F.array(*[F.lit(b).cast("bigint") for b in range(4)])).when(F.col("sidebands") == "BandA", F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).when(F.col("sidebands") == "BandB", F.array(F.lit(2).cast("bigint"), F.lit(3).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    first = F.col("obsid_start").try_cast("bigint")
    last = F.when(end == "ongoing", F.lit((1 << 62))).when(end == "", first).otherwise(end.try_cast("bigint"))
    return text.select(first.alias("first"), last.alias("last"), F.when(F.size(numbers) > 0, numbers).otherwise(F.array(*[F.lit(p).cast("bigint") for p in PIXELS])).alias("pixels"), bands.alias("bands")).where("first is not null")


def apply_flag_ranges(flags: DataFrame, ranges: DataFrame, comment: str = "Observer Flag") -> DataFrame:
    """All flags good, then those in a range bad. Ranges are few; the join is a range join on the id with them broadcast."""
    cells = ranges.select("first", "last", F.explode("pixels").alias("pixel"), "bands").select("first", "last", "pixel", F.explode("bands").alias("band"))
    f, r = flags.alias("f"), F.broadcast(cells).alias("r")
    bad = f.join(r, (F.col("f.pixel") == F.col("r.pixel")) & (F.col("f.band") == F.col("r.band")) & F.col("f.obsid").between(F.col("r.first"), F.col("r.last")), "left_semi").select("obsid", "pixel", "band").withColumn("_bad", F.lit(True))
    return flags.join(bad, ["obsid", "pixel", "band"], "left").withColumn("is_good", F.col("_bad").isNull()).withColumn("comment", F.lit(comment)).drop("_bad")


def failed(flags: DataFrame, summary: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(flags, summary) after observations of an error table (obsid, step, message) have failed: all their flags bad, with the first message, and their status ``failed``; the others stay."""
    own = errors.groupBy("obsid").agg(F.min("message").alias("_message"))
    out = flags.join(own, "obsid", "left").withColumn("is_good", F.col("is_good") & F.col("_message").isNull())
    done = summary.join(own.select("obsid", F.lit(True).alias("_failed")), "obsid", "left")
    status = F.when(F.col("_failed"), "failed").otherwise(F.col("processing_status"))
    return out.withColumnRenamed("_message", "comment"), done.withColumn("processing_status", status).drop("_failed")


def with_value(table: DataFrame, key: str, id_: object, column: str, value: object) -> DataFrame:
    """``table`` with one value set in the row of a key; a column that it lacks is an error, a key that it lacks changes nothing."""
    if column not in table.columns or column == key:
        raise ValueError(f"the table has no column {column} to set")
    kind = table.schema[column].dataType
    return table.withColumn(column, F.when(F.col(key) == id_, F.lit(value).cast(kind)).otherwise(F.col(column)))


def copied(old: DataFrame, new: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Rows of an old catalogue in the columns of ``new``: renamed, cast, null where the old one has none, and only ids that ``new`` lacks."""
    rows = old.withColumnsRenamed(renamed)
    rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in new.schema])
    return new.unionByName(rows.join(new.select("obsid"), "obsid", "left_anti"))


def random_subset(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows, the same ones for the same seed: those with the least digests of seed and key."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
