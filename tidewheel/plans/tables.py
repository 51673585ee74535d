"""The engine's domain tables, built from the driver's tables by the same integer arithmetic in Spark and in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.values import mjd

Query = Callable[[SparkSession, str], DataFrame]

#: Raw source texts that observations take in turn.
SOURCES = ["TauA,", "GField10,CasA", "GField11, ", "fg10, ,", "co2", "Jupiter", "CygA", "Field of view", "fg3", ""]


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("event_id").alias("sample"), (F.col("user_id") % 19 + 1).alias("feed"), (F.col("event_id") % 4).alias("band"), F.floor(F.col("event_id") / 250).alias("scan"), F.floor(F.col("event_id") / 5000).alias("obsid"),
        F.col("event_type").alias("status"), F.col("value").alias("tod"), k.alias("k"), (k % 4 + 1).cast("double").alias("w"),
        ((F.col("user_id") * 37 + F.col("event_id") * 11) % 211).alias("pix"), mjd(F.col("ts")).alias("mjd"), F.col("ts"),
        (F.lit(40.0) + (F.col("event_id") % 200) / 10.0).alias("el"), (F.lit(100.0) + (F.col("event_id") % 37) / 2.0).alias("az"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    path = F.when(n % 3 == 0, F.lit(None)).when(n % 7 == 0, "").otherwise(F.concat(F.lit("/data/Level2_scope-"), F.lpad(n.cast("string"), 7, "0"), F.lit("-2020.hd5")))
    return o.select(
        n.alias("obsid"), F.element_at(F.array(*map(F.lit, SOURCES)), (F.col("o_custkey") % len(SOURCES) + 1).cast("int")).alias("source"),
        F.when(n % 11 == 0, F.lit(None)).otherwise(F.element_at(F.array(*map(F.lit, ["Galactic", "Foreground", "Calibrator", "SkyDip", "CO"])), (F.col("o_custkey") % 5 + 1).cast("int"))).alias("source_group"),
        F.when(n % 13 == 0, "Sky Nod run").otherwise("science").alias("comment"), path.alias("level2_path"), F.date_format("o_orderdate", "yyyy-MM-dd-HH:mm:ss").alias("utc_start"), F.col("o_orderdate").alias("started"),
    )


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0")
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "P", "pending").otherwise("failed")
    return o.select(
        F.col("o_orderkey").alias("obsid"), status.alias("processing_status"), F.when(F.col("o_orderkey") % 9 != 0, F.round(F.col("o_totalprice") / 1000, 3)).alias("median_tsys"),
        F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 100) / 100.0).alias("mean_tau"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("calibrator_flux"), (F.col("o_orderkey") % 17).alias("n_scans"),
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obsid"), (F.col("l_suppkey") % 19 + 1).alias("pixel"), (F.col("l_linenumber") % 8).cast("bigint").alias("band"))
    return rows.agg(
        F.bool_and(F.col("l_returnflag") != "R").alias("is_good"), F.max("l_quantity").alias("auto_rms"), F.nullif(F.max("l_discount"), F.lit(0.0)).alias("red_noise"),
        F.nullif(F.min("l_tax"), F.lit(0.0)).alias("white_noise"), (-F.min("l_discount") * 30).alias("noise_index"), F.count(F.lit(1)).alias("n_spikes"),
    )


def flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "lineitem").join(raw(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("l_orderkey").alias("obsid"), (F.col("l_suppkey") % 19 + 1).alias("feed"), (F.col("l_linenumber") % 4).cast("bigint").alias("band"), (F.col("l_partkey") % 2).alias("channel"),
        F.element_at(F.array(F.lit("TauA"), F.lit("CasA"), F.lit("CygA")), (F.col("l_partkey") % 3 + 1).cast("int")).alias("source"), mjd(F.col("l_shipdate")).alias("mjd"),
        F.col("l_extendedprice").alias("measured"), (F.col("p_retailprice") * F.col("l_quantity")).alias("expected"), F.col("l_quantity").alias("chi2"),
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = raw(spark, sf_dir, "nation").join(F.broadcast(raw(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_name").alias("field"), ((F.col("n_nationkey") * 37) % 360).cast("double").alias("l"), ((F.col("n_nationkey") * 7) % 21 - 10).cast("double").alias("b"), F.col("r_name").alias("grp"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = raw(spark, sf_dir, "supplier")
    return s.select(F.col("s_name").alias("region"), ((F.col("s_suppkey") * 13) % 360 + 0.25).cast("double").alias("l"), (F.col("s_suppkey") % 23 - 11).cast("double").alias("b"), F.col("s_acctbal").alias("brightness"))


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("sample"), (F.col("label") % 4).cast("bigint").alias("band"), F.posexplode("embedding").alias("channel", "v")).select("sample", "band", F.col("channel").cast("bigint").alias("channel"), F.col("v").cast("double").alias("value"))


#: The same tables for DuckDB.
SQL = {
    "samples": "select event_id as sample, user_id % 19 + 1 as feed, event_id % 4 as band, event_id // 250 as scan, event_id // 5000 as obsid, event_type as status, value as tod, regexp_extract(props, '[0-9]+')::bigint as k, (regexp_extract(props, '[0-9]+')::bigint % 4 + 1)::double as w, (user_id * 37 + event_id * 11) % 211 as pix, epoch_us(ts) / 86400e6 + 40587.0 as mjd, ts, 40.0::double + (event_id % 200) / 10.0::double as el, 100.0::double + (event_id % 37) / 2.0::double as az from events",
    "observations": "select o_orderkey as obsid, list_extract(['TauA,', 'GField10,CasA', 'GField11, ', 'fg10, ,', 'co2', 'Jupiter', 'CygA', 'Field of view', 'fg3', ''], o_custkey % 10 + 1) as source, case when o_orderkey % 11 = 0 then null else list_extract(['Galactic', 'Foreground', 'Calibrator', 'SkyDip', 'CO'], o_custkey % 5 + 1) end as source_group, case when o_orderkey % 13 = 0 then 'Sky Nod run' else 'science' end as comment, case when o_orderkey % 3 = 0 then null when o_orderkey % 7 = 0 then '' else '/data/Level2_scope-' || lpad(o_orderkey::varchar, 7, '0') || '-2020.hd5' end as level2_path, strftime(o_orderdate, '%Y-%m-%d-%H:%M:%S') as utc_start, o_orderdate as started from orders",
    "summaries": "select o_orderkey as obsid, case o_orderstatus when 'F' then 'complete' when 'P' then 'pending' else 'failed' end as processing_status, case when o_orderkey % 9 <> 0 then round(o_totalprice / 1000, 3) end as median_tsys, case when o_orderkey % 4 <> 0 then (o_orderkey % 100) / 100.0::double end as mean_tau, case when o_orderkey % 2 = 0 then o_totalprice end as calibrator_flux, o_orderkey % 17 as n_scans from orders where o_orderkey % 5 <> 0",
    "flags": "select l_orderkey as obsid, l_suppkey % 19 + 1 as pixel, (l_linenumber % 8)::bigint as band, bool_and(l_returnflag <> 'R') as is_good, max(l_quantity) as auto_rms, nullif(max(l_discount), 0) as red_noise, nullif(min(l_tax), 0) as white_noise, -min(l_discount) * 30 as noise_index, count(*) as n_spikes from lineitem group by all",
    "flux": "select l_orderkey as obsid, l_suppkey % 19 + 1 as feed, (l_linenumber % 4)::bigint as band, l_partkey % 2 as channel, list_extract(['TauA', 'CasA', 'CygA'], l_partkey % 3 + 1) as source, epoch_us(l_shipdate) / 86400e6 + 40587.0 as mjd, l_extendedprice as measured, p_retailprice * l_quantity as expected, l_quantity as chi2 from lineitem join part on l_partkey = p_partkey",
    "fields": "select n_name as field, ((n_nationkey * 37) % 360)::double as l, ((n_nationkey * 7) % 21 - 10)::double as b, r_name as grp from nation join region on n_regionkey = r_regionkey",
    "regions": "select s_name as region, ((s_suppkey * 13) % 360 + 0.25)::double as l, (s_suppkey % 23 - 11)::double as b, s_acctbal as brightness from supplier",
    "spectra": "select vec_id as sample, (label % 4)::bigint as band, unnest(range(64))::bigint as channel, unnest(embedding)::double as value from embeddings",
}


def with_tables(body: str) -> str:
    """SQL whose domain tables are defined in front."""
    used = [name for name in SQL if re.search(rf"\b{name}\b", body)]
    front = ", ".join(f"{n} as ({SQL[n]})" for n in used)
    if not used:
        return body
    return f"with recursive {front}, {body.strip()[5:]}" if body.strip().startswith("with ") else f"with {front} {body}"


class Book:
    """Queries by name, with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}
        self.plain: dict[str, str] = {}  # SQL without the tables' definitions

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries are called {name}")
            self.queries[name] = f
            if sql:
                self.oracle[name], self.plain[name] = with_tables(sql), sql
            return f

        return put
