import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import jobs as J
from tidewheel.plans import library, steps
from tidewheel.plans.tables import flags, observations, samples
from tidewheel.sources import readers as R
from tidewheel.sources import writers as W
from tidewheel.streaming import incremental as I


def test_discovery(spark, tmp_path):
    for name in ("a/Level2_scope-0006329-2019.hd5", "b/Level2_scope-0006329-2019.hd5", "b/scope-0029828-2022-07-21-092019.hd5", "b/other.txt", "c/junk.hd5"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x")
    files = R.listed(spark, str(tmp_path))
    assert files.count() == 4
    got = R.level2_files(files).first()
    assert (got["obsid"], got["n"]) == (6329, 2) and "/a/" in got["path"]
    assert {r["obsid"] for r in R.level1_files(files).collect()} == {6329, 29828}
    assert R.stale(files, "2000-01-01").count() == 0 and R.stale(files, "2999-01-01").count() == 4


def test_text_and_csv_readers(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# ids\n 12\n\n13 \nx\n12\n")
    assert sorted(r["obsid"] for r in R.id_list(spark, str(tmp_path / "ids.txt")).collect()) == [12, 13]
    (tmp_path / "flags.csv").write_text('ObsID start,ObsID end,Pixels,Sidebands\n5,,"1, 3",BandA\n7,ongoing,All,All\n')
    rows = R.flag_csv(spark, str(tmp_path / "flags.csv")).collect()
    assert [tuple(r) for r in rows] == [("5", None, "1, 3", "BandA"), ("7", "ongoing", "All", "All")]
    (tmp_path / "fields.csv").write_text("field_name,ra,dec,group,notes\ncentre,17:45:37.2,-28:56:10.2,galactic_plane,\nsmall,00:00:00,-0:30:00,targeted,x\n")
    got = {r["field_name"]: r for r in R.field_csv(spark, str(tmp_path / "fields.csv")).collect()}
    assert abs(got["centre"]["b"]) < 0.01 and got["small"]["dec_deg"] == -0.5
    (tmp_path / "hii.csv").write_text("GLon,GLat,name\n1.5,0.5,a\n,1,b\n")
    assert [r["l"] for r in R.region_csv(spark, str(tmp_path / "hii.csv"), "GLon", "GLat").collect()] == [1.5]
    with pytest.raises(ValueError):
        R.region_csv(spark, str(tmp_path / "hii.csv"), "x", "GLat")


def test_remote_listing(spark):
    files = spark.createDataFrame([("12345 _ L1 /path/to/data more",), ("invalid _ L1 /x",), ("7 _ L1 /y",)], "value string")
    targets = spark.createDataFrame([("12345 TauA (raster)",)], "value string")
    assert sorted(tuple(r) for r in R.remote_listing(files, targets).collect()) == [(7, "/y", "Unknown", None), (12345, "/path/to/data", "TauA", "raster")]


def test_optional_table(spark, tmp_path):
    assert R.optional(spark, str(tmp_path / "none"), "obsid bigint").count() == 0
    spark.range(3).withColumnRenamed("id", "obsid").write.parquet(str(tmp_path / "some"))
    assert R.optional(spark, str(tmp_path / "some"), "obsid bigint").count() == 3


def test_per_scan(spark):
    cube = [[[[1.0, 2.0], [3.0, 4.0]]], [[[5.0, 6.0], [7.0, 8.0]]]]
    df = spark.createDataFrame([(9, cube, cube)], "obsid int, a array<array<array<array<double>>>>, b array<array<array<array<double>>>>")
    got = {(r["feed"], r["band"], r["channel"], r["scan"]): (r["a"], r["b"]) for r in R.per_scan(df, ["a", "b"]).collect()}
    assert got == {(f, b, c, s): (cube[f][b][c][s],) * 2 for f in range(2) for b in range(1) for c in range(2) for s in range(2)}


def test_writers(spark, sf_dir, tmp_path):
    obs = observations(spark, sf_dir).where("obsid < 50 and source <> ''")
    W.level2(obs.withColumn("x", F.lit(2.0)), str(tmp_path / "l2"), {"x": 0.5})
    back = spark.read.parquet(str(tmp_path / "l2"))
    assert back.count() == obs.count() and {r["x"] for r in back.select("x").distinct().collect()} == {1.0} and "year_month" in back.columns
    rows = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "v int, k int, s string")
    W.replaced(rows, str(tmp_path / "r"), ["k"])
    W.replaced(spark.createDataFrame([(9, 2, "c")], rows.schema), str(tmp_path / "r"), ["k"])
    assert {(r["v"], r["k"]) for r in spark.read.parquet(str(tmp_path / "r")).collect()} == {(1, 1), (9, 2)}
    W.report(rows, str(tmp_path / "t"), "\t")
    assert spark.read.csv(str(tmp_path / "t"), header=True, sep="\t").count() == 2
    W.path_list(obs, str(tmp_path / "p"))
    assert spark.read.text(str(tmp_path / "p")).count() == obs.where("level2_path <> ''").count()
    W.group_lists(rows.selectExpr("v as obsid", "s as field", "k as grp"), str(tmp_path / "g"))
    assert spark.read.text(str(tmp_path / "g")).count() == 2
    W.snapshot(obs, flags(spark, sf_dir), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == obs.count()
    W.map_product(spark.createDataFrame([(1, 2.0), (2, float("nan"))], "pix int, naive double"), str(tmp_path / "m"), {"nx": 3})
    assert tuple(spark.read.json(str(tmp_path / "m/header")).select("datamin", "datamax").first()) == (2.0, 2.0)


def test_steps(spark):
    @steps.step("Test.scale")
    def scale(df, by=1.0):
        return df.withColumn("v", F.col("v") * by)

    text = '[pipeline]\nsteps = ["Test.scale", {name = "Test.scale", by = 3.0}]\n'
    df = spark.createDataFrame([(2.0,)], "v double")
    assert steps.Config.loads(text).apply(df).first()["v"] == 6.0
    assert steps.Config.loads(text + "[Test.scale]\nby = 10.0\n").apply(df).first()["v"] == 200.0
    assert len(steps.Config.loads(text).name()) == 12 and steps.Config.loads(text).name() != steps.Config().name()
    with pytest.raises(KeyError):
        steps.Config([("no.such", {})]).apply(df)
    good, bad = steps.errors(spark.createDataFrame([(1, 2.0), (2, None), (3, -1.0)], "obsid int, v double"), "obsid", {"no value": F.col("v").isNotNull(), "negative": F.col("v") >= 0})
    assert [r["obsid"] for r in good.collect()] == [1]
    assert sorted((r["obsid"], r["message"]) for r in bad.collect()) == [(2, "negative"), (2, "no value"), (3, "negative")]


@pytest.mark.parametrize(("mode", "n"), [("none", 1), ("per_feed", 15), ("alternate_scans", 2), ("custom", 4)])
def test_split_keys(spark, sf_dir, mode, n):
    assert steps.split_keys(samples(spark, sf_dir), mode, column="band").select("split").distinct().count() == n


def test_streams_equal_batches(spark, sf_dir, tmp_path):
    rows = samples(spark, sf_dir)
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    q = I.replaced(I.deepening_map(I.source(spark, str(tmp_path / "in"), rows.schema, 2), "pix", "tod", "w"), str(tmp_path / "map"), str(tmp_path / "c1"))
    q.awaitTermination(120)
    want = {r["pix"]: (round(r["t"], 6), r["n"]) for r in rows.groupBy("pix").agg(F.sum(F.col("tod") * F.col("w")).alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    assert {r["pix"]: (round(r["total"], 6), r["hits"]) for r in spark.read.parquet(str(tmp_path / "map")).collect()} == want


def test_windows_and_late_rows(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    schema = "ts timestamp, k int, v double"
    first = spark.createDataFrame([(at(0, 5), 1, 1.0), (at(0, 50), 1, 3.0), (at(9), 1, 5.0)], schema)
    late = spark.createDataFrame([(at(0, 30), 1, 100.0), (at(9, 30), 1, 7.0), (at(20), 1, 0.0)], schema)
    for i, part in enumerate((first, late)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = I.windowed(I.source(spark, str(tmp_path / "in"), first.schema), "ts", "v", ["k"])
        I.written(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    got = {r["start"].hour: (r["n"], r["total"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: (2, 4.0), 9: (2, 12.0)}  # the row of 0:30 came after its window had closed


def test_unprocessed(spark, tmp_path):
    spark.range(6).withColumnRenamed("id", "obsid").write.parquet(str(tmp_path / "in"))
    done = spark.range(3).withColumnRenamed("id", "obsid")
    stream = I.unprocessed(I.source(spark, str(tmp_path / "in"), done.schema), done)
    I.written(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    assert sorted(r["obsid"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 4, 5]


def test_retried_and_timed():
    waits, tries = [], []

    def read(path):
        tries.append(path)
        if len(tries) < 3:
            raise OSError("busy")
        return 7

    assert R.retried(read, "/a/scope-0029828-2022.hd5", sleep=waits.append) == 7
    assert len(waits) == 2 and 1.4 <= waits[0] <= 2.6 and 2.8 <= waits[1] <= 5.2

    def broken(path):
        raise OSError("gone")

    for path, obsid in (("/a/scope-0029828-2022.hd5", 29828), ("/a/junk.hd5", -1)):
        waits.clear()
        with pytest.raises(R.BadFile) as e:
            R.retried(broken, path, most=3, sleep=waits.append)
        assert e.value.obsid == obsid and len(waits) == 3
    rows = R.timed_reads(lambda p: 5 if p == "x" else broken(p), ["x", "y"], 2)
    assert [(r[0], r[1], r[4], r[5]) for r in rows] == [(2, "x", 5, None), (2, "y", 0, "gone")] and all(r[2] <= r[3] for r in rows)


def test_registered(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    a, b = R.registered(spark, str(tmp_path), {"a": "id bigint", "b": "id bigint"}, "own_")
    assert spark.sql(f"select (select count(*) from {a}), (select count(*) from {b})").first() == (2, 0)


def test_job_books(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", None), (None, "z")], "label string, path string")
    jobs = {r["label"]: (r["n"], r["token"]) for r in J.map_jobs(rows, {"p": 1}).collect()}
    assert {k: v[0] for k, v in jobs.items()} == {"a": 2, "b": 1, None: 1} and len({v[1] for v in jobs.values()}) == 3
    assert {r["token"] for r in J.map_jobs(rows.orderBy(F.desc("path")), {"p": 1}).collect()} == {v[1] for v in jobs.values()}
    assert not {r["token"] for r in J.map_jobs(rows, {"p": 2}).collect()} & {v[1] for v in jobs.values()}
    W.job_files(rows, J.map_jobs(rows, {"p": 1}), str(tmp_path / "jobs"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "jobs/lists")).collect()) == ["x", "x", "y", "z"]
    there, lost = J.absent(spark.createDataFrame([(1, "x"), (2, "q"), (3, None), (4, "")], "obsid int, path string"), rows.select("path"))
    assert [r["obsid"] for r in there.collect()] == [1]
    assert sorted(tuple(r) for r in lost.collect()) == [(2, "files", "no file q"), (3, "files", "no path"), (4, "files", "no path")]
    rates = J.read_rates(spark.createDataFrame([(1, 0.0, 2.0, 1 << 20, None), (1, 1.0, 4.0, 1 << 20, None), (2, 1.0, 1.0, 0, "bad")], "k int, began double, ended double, bytes long, error string"), ["k"])
    assert {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rates.collect()} == {(1, 4.0, 0.5, 2.5, 2.95, 0), (2, 0.0, None, None, None, 1)}


def test_library_steps(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, 2.0), (2, float("nan"), 1.0), (2, None, 1.0), (2, float("inf"), 1.0), (3, 5.0, 0.0)], "pix int, tod double, w double")
    text = '[pipeline]\nsteps = ["Clean.Finite", {name = "Maps.Binned", keys = ["pix"], value = "tod", weight = "w"}]\n[Clean.Finite]\ncolumns = ["tod"]\n'
    assert {tuple(r) for r in steps.Config.loads(text).apply(df).collect()} == {(1, 2.0, 4.0, 2), (3, None, 0.0, 1)}
    assert library.between(df, "tod", 1.0, 3.0).count() == 2 and library.where(df, "pix = 3").count() == 1
    out, bad = steps.run(steps.Config(), spark.createDataFrame([(1, 1), (2, None)], "obsid int, v int"), df.withColumnRenamed("pix", "obsid"), {"no v": F.col("v").isNotNull()})
    assert out.count() == 2 and [tuple(r) for r in bad.collect()] == [(2, "check", "no v")]
    with pytest.raises(ValueError):
        steps.preset(df, "no such", "pix", "tod", "w")
