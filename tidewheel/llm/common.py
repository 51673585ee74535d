"""What the corpus operators share: the shared folder, ordered partitions, text batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Splits words: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session that leaves it unset (as in tests) gets a temporary folder; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidewheel-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidewheel-{spark.sparkContext.applicationId}"


def light(spark: SparkSession) -> None:
    """Lowers the session's rows in an Arrow batch to 1,000, where more are set: texts are long, and a batch stands in the executor and in its Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > 1000:
        spark.conf.set(name, "1000")


_cleaned: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has gone: the folder stays for the cluster's own clean-up
        pass


def scratch_path(spark: SparkSession, tag: str) -> str:
    folder = shared_folder(spark)
    if folder not in _cleaned:
        _cleaned.add(folder)
        atexit.register(_delete, spark, folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: it cuts lineage and survives lost executors."""
    light(df.sparkSession)
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def parts_for(df: DataFrame, each: int = 1 << 25, most: int = 20_000) -> int:
    """How many parts to cut a table of files into: one for ``each`` bytes on disk, at least the session's shuffle partitions.

    Beyond ``most`` parts, whose cut points a plan can still hold, parts grow instead; sorted parts spill, and are
    read in batches.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0
    return max(parallelism(df.sparkSession), min(most, -(-known // each)))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``: the fold of a document; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    light(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


class Cuts:
    """Cut points of a key, approximate percentiles whose number follows the input's size on disk (see ``parts_for``).

    The driver holds the cuts; a row finds its part by two searches among about the square root of them.
    """

    def __init__(self, docs: DataFrame, key: str) -> None:
        n = parts_for(docs)
        self.key, self.kind = key, docs.schema[key].dataType.simpleString()
        head = docs.select(key).agg(
            F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], max(10_000, 4 * n)).alias("cuts"),
            F.min(key).alias("least"),
            F.sum(F.col(key).isNull().cast("int")).alias("nulls"),
        ).first()
        self.least, self.nulls = head["least"], head["nulls"]
        self.cuts = sorted({c for c in head["cuts"] or [] if c != head["least"]}) if n > 1 else []
        self.step = max(1, int(np.ceil(len(self.cuts) ** 0.5)))
        self.runs = [self.cuts[i : i + self.step] for i in range(0, len(self.cuts), self.step)]

    def _below(self, at: Column) -> Column:
        return F.size(F.filter(at, lambda c: c <= F.col(self.key)))

    def _run(self) -> Column:
        return self._below(F.array(*[F.lit(r[0]) for r in self.runs]).cast(f"array<{self.kind}>"))

    def own(self) -> Column:
        """The run of cuts that holds the last one at or below the key; null below all."""
        return F.get(F.array(*[F.array(*map(F.lit, r)) for r in self.runs]).cast(f"array<array<{self.kind}>>"), self._run() - 1)

    def part(self) -> Column:
        """The number of cuts at or below the key; 0 for a null."""
        if not self.cuts:
            return F.lit(0)
        run = self._run()
        return F.when(F.col(self.key).isNotNull() & (run > 0), (run - 1) * self.step + self._below(self.own())).otherwise(0).cast("int")


def placed(docs: DataFrame, key: str) -> DataFrame:
    """Adds ``_part``: the rows of part 0 have the smallest keys (nulls first), and equal keys share a part."""
    return docs.withColumn("_part", Cuts(docs, key).part())


def in_order(docs: DataFrame, key: str, *ties: str, echo: bool = False) -> DataFrame:
    """Deals rows out so that partition 0 has the smallest keys, and sorts each partition.

    Equal keys share a partition; null keys come first. Adds ``_part``; with ``echo`` also ``_echo``: true on a copy
    of the next partition's first rows (for the last partition: of the first partition's).
    """
    cuts = Cuts(docs, key)
    df = docs.withColumn("_part", cuts.part())
    last = len(cuts.cuts)
    order = ["_part", F.asc_nulls_first(key), *ties]
    if echo:
        first = F.col(key).isNull() if cuts.nulls else F.col(key) == cuts.least
        back = F.when(first, F.lit(last))
        if cuts.cuts:
            back = back.when((F.col("_part") > 0) & F.array_contains(cuts.own(), F.col(key)), F.col("_part") - 1)
        df = df.withColumn("_to", F.when(back.isNull(), F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("e")))).otherwise(
            F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("e")), F.struct(back.cast("int").alias("p"), F.lit(True).alias("e")))))
        df = df.withColumn("_to", F.explode("_to")).withColumn("_part", F.col("_to.p")).withColumn("_echo", F.col("_to.e")).drop("_to")
        order = ["_part", "_echo", F.asc_nulls_first(key), *ties]
    return df.repartitionById(last + 1, F.col("_part")).sortWithinPartitions(*order)


def chunks(texts: list[str | None], most: int):
    """Ranges (from, to) of ``texts`` with at most ``most`` characters, or one longer text."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def codes(text: str) -> np.ndarray:
    """Code points as unsigned 32-bit integers."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Strata whose counts are broadcast.
FEW_STRATA = 10_000


def bounded_ids(ids: DataFrame, strata: str, most: int, seed: int = 0) -> DataFrame:
    """About ``most`` rows of each value of ``strata``, those with the lowest hashes of ``doc_id``; all of them where there are fewer.

    The cut for each stratum is its share of the hash range, so that no row is sorted or gathered. Up to ``FEW_STRATA``
    strata are counted into a broadcast table; beyond, their counts meet the rows in a shuffle join.
    """
    light(ids.sparkSession)
    seen = ids.groupBy(F.col(strata).alias("_stratum")).agg(F.count(F.lit(1)).alias("_count"))
    seen = F.broadcast(seen) if len(seen.limit(FEW_STRATA + 1).collect()) <= FEW_STRATA else seen
    spin = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    return ids.join(seen, F.col(strata).eqNullSafe(F.col("_stratum"))).where((F.col("_count") <= most) | (spin * F.col("_count") < most)).select(*ids.columns)


def kept_columns(id_col: str, text: str, keep: tuple[str, ...], added: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """The columns that a scorer reads and those that it hands on; a column that it adds can't be kept."""
    clash = sorted(set(added) & {id_col, *keep})
    if clash:
        raise ValueError(f"{clash} can't be kept: the result has columns of that name")
    return list(dict.fromkeys([id_col, text, *keep])), list(dict.fromkeys([id_col, *keep]))
