import numpy as np
from pyspark.sql import functions as F

from lamella.sources import readers, writers
from lamella.streaming import slabs


def test_image_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("b.pgm\na.pgm\n\n")
    assert [tuple(r) for r in readers.image_list(spark, str(tmp_path / "list.txt")).orderBy("z").collect()] == [(0, "b.pgm"), (1, "a.pgm")]


def test_gray_images(spark, tmp_path):
    a = np.arange(6, dtype=np.uint8).reshape(2, 3)
    (tmp_path / "im_0007.pgm").write_bytes(b"P5\n# made\n3 2\n255\n" + a.tobytes())
    got = readers.gray_images(spark, str(tmp_path), unit=True).collect()
    assert {(r.z, r.y, r.x): round(r.v * 255) for r in got} == {(7, y, x): int(a[y, x]) for y in range(2) for x in range(3)}


def test_stumps_text(spark, tmp_path):
    (tmp_path / "m.txt").write_text("membrane_19 <= 0.5 ? -1.25 : 2\nnot a stump\n")
    assert [tuple(r) for r in readers.stumps(spark, str(tmp_path / "m.txt")).collect()] == [("membrane_19", 0.5, -1.25, 2.0)]


def test_sift_text(spark, tmp_path):
    (tmp_path / "k.sift").write_text("2 3\n1 2 3 4\n 5 6 7\n8 9 10 11\n 12 13\n 14\n")
    got = readers.sift_frames(spark, str(tmp_path / "k.sift")).orderBy("frame").collect()
    assert [(r.y, r.theta, r.descriptor) for r in got] == [(1.0, 4.0, [5.0, 6.0, 7.0]), (8.0, 11.0, [12.0, 13.0, 14.0])]


def test_commit_checks_the_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert writers.commit(df, str(tmp_path / "m"), "merges").count() == 1


def test_solver_text(spark, tmp_path):
    objective = spark.createDataFrame([("s1", 2.0), ("s2", 1.0)], "name string, cost double")
    rows = spark.createDataFrame([("x1", "s1", 1.0, "<=", 1.0), ("x1", "s2", 1.0, "<=", 1.0)], "row string, name string, coef double, sense string, rhs double")
    writers.solver_text(objective, rows, str(tmp_path / "lp"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "lp")).collect())
    assert "obj: +1.0 s2 +2.0 s1" in text and "x1: +1.0 s1 +1.0 s2 <= 1.0" in text and text.rstrip().endswith("End")


def test_mesh_text(spark, tmp_path):
    v = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 3.0, 0.0, 4.0), (1, 2.0, 4.0, 0.0, 0.0, 1.0, 0.0)], "label long, x double, y double, z double, nx double, ny double, nz double")
    writers.mesh_text(v, str(tmp_path / "t"))
    assert "1 -1.000000 -1.000000 0.000000 0.600000 0.000000 0.800000" in [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]


def test_slabs_as_they_arrive(spark, tmp_path):
    for slab, (label, below) in enumerate(((11, 1), (21, 11))):
        spark.range(50).select(F.lit(slab).alias("slab"), F.lit(slab).alias("z"), F.lit(0).alias("y"), F.col("id").cast("int").alias("x"), F.lit(label).cast("long").alias("label"), F.lit(below).cast("long").alias("below")).write.mode("append").parquet(str(tmp_path / "in"))
        slabs.merge_slabs(slabs.slab_stream(spark, str(tmp_path / "in")), str(tmp_path / "merges"), str(tmp_path / "state"), 40, 10).awaitTermination()
    merges = spark.read.parquet(str(tmp_path / "merges")).select("a", "b")
    from lamella.operators.components import global_map

    assert {r.old: r.new for r in global_map(merges).collect()} == {0: 0, 1: 1, 11: 1, 21: 1}


def test_commit_keeps_the_old_table_on_failure(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.commit(spark.createDataFrame([(1, 2)], "a long, b long"), path, "merges")
    broken = spark.range(3).select(F.col("id").alias("a"), F.expr("if(id = 2, cast(raise_error('lost') as long), id)").alias("b"))
    try:
        writers.commit(broken, path, "merges")
        raise AssertionError("no error")
    except Exception as error:
        assert "lost" in str(error)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, 2)]


def test_models(spark, tmp_path):
    nodes = [(1, 1, 1, 2, 0.5, 2, 3, 0), (1, 2, -1, 0, 0.0, 0, 0, 1), (1, 3, -1, 0, 0.0, 0, 0, 2)]
    forest = spark.createDataFrame(nodes, "tree int, node int, status int, feature int, thr double, left int, right int, cls int")
    writers.forest_text(forest, str(tmp_path / "f"))
    assert sorted(map(tuple, readers.forest(spark, str(tmp_path / "f")).collect())) == nodes
    tree = "<_><nodes><_><splits><_><var>{v}</var><quality>1</quality><{op}>{t}</{op}></_></splits></_><_><value>{a}</value></_><_><value>{b}</value></_></nodes></_>"
    (tmp_path / "m.xml").write_text("<opencv_storage><m><trees>" + tree.format(v=3, op="le", t=0.25, a=-1, b=2) + tree.format(v=4, op="gt", t=7, a=5, b=6) + "</trees></m></opencv_storage>")
    assert readers.boosted_xml(str(tmp_path / "m.xml")) == [(3, 0.25, -1.0, 2.0), (4, 7.0, 6.0, 5.0)]


def test_label_plane(spark):
    df = spark.createDataFrame([(0, 0, 0, 5), (1, 0, 0, 6)], "z int, y int, x int, label long")
    assert [tuple(r) for r in writers.label_plane(df, 1).collect()] == [(0, 0, 6)]
