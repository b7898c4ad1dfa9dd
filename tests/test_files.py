"""CSV and GeoJSON sources and sinks, and side tables."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_engine.sinks import files as sinks
from incident_engine.sources import files


def write(path, text):
    path.write_text(text)
    return str(path)


def test_scan_csv_infers_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "ID,Date,Ward\n1,x,2\n3,y,\n")
    df = files.scan_csv(spark, path)
    assert df.dtypes == [("ID", "int"), ("Date", "string"), ("Ward", "int")]
    assert files.scan_csv(spark, path, "ID string, Date string, Ward string").first()["ID"] == "1"


def test_long_lines_are_left_out_and_short_ones_kept(spark, tmp_path):
    path = write(tmp_path / "a.csv", (
        "A,B,C\n1,2,3\n4,5\n6,7,8,9\n\"q,1\",\"say \"\"hi\"\"\",x\n,,\n1,2,3,\n1,2,3,4,5\nlast,,z\n"))
    rows = [tuple(r) for r in files.scan_csv_skip_long(spark, path).collect()]
    assert rows == [("1", "2", "3"), ("4", "5", None), ("q,1", 'say "hi"', "x"),
                    (None, None, None), ("last", None, "z")]
    assert files.scan_csv_skip_long(spark, path).select("B").count() == 5


def test_quoted_line_break(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'A,B\n"one\ntwo",x\n')
    assert files.scan_csv_skip_long(spark, path, multi_line=True).first()["A"] == "one\ntwo"


def test_optional_csv(spark, tmp_path):
    ddl = "year int, month int, AREA string, unemployment_rate double"
    good = write(tmp_path / "good.csv", "month,year,AREA,unemployment_rate,x\n2,2020,7,4.5,z\n")
    bad = write(tmp_path / "bad.csv", "a,b\n1,2\n")
    assert tuple(files.optional_csv(spark, good, ddl).first()) == (2020, 2, "7", 4.5)
    with pytest.raises(ValueError, match="has no column"):
        files.optional_csv(spark, bad, ddl)
    assert files.optional_csv(spark, str(tmp_path / "none.csv"), ddl) is None
    assert files.optional_csv(spark, None, ddl) is None


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties,
            "geometry": {"type": kind, "coordinates": coordinates}}


SQUARE = [[0, 0], [1, 0], [1, 1.5], [0, 0]]
HOLE = [[0.1, 0.1], [0.2, 0.1], [0.2, 0.2]]
FEATURES = [feature("Polygon", [SQUARE, HOLE], name="a"),
            feature("MultiPolygon", [[SQUARE], [HOLE]], name="b"),
            feature("Point", [1, 2], name="c")]


@pytest.mark.parametrize("lines", [False, True])
def test_geojson(spark, tmp_path, lines):
    text = ("\n".join(map(json.dumps, FEATURES)) if lines else
            json.dumps({"type": "FeatureCollection", "features": FEATURES}, indent=1))
    df = files.scan_geojson(spark, write(tmp_path / "b.json", text), feature_lines=lines)
    rows = df.orderBy(F.col("properties")["name"], "part_no", "ring_no").collect()
    assert [(r["properties"]["name"], r["part_no"], r["ring_no"]) for r in rows] == [
        ("a", 0, 0), ("a", 0, 1), ("b", 0, 0), ("b", 1, 0)]
    assert [tuple(p) for p in rows[0]["ring"]] == [(0, 0), (1, 0), (1, 1.5), (0, 0)]
    # The hole came without its closing point.
    assert rows[1]["ring"][0] == rows[1]["ring"][-1] and len(rows[1]["ring"]) == 4
    assert len({r["polygon_id"] for r in rows}) == 2


def cells(spark, n=3):
    return spark.range(n).selectExpr(
        "id as grid_id", "id * 0.5D as xmin", "1D as ymin", "id * 0.5D + 0.5D as xmax", "2D as ymax")


def test_feature_collection_and_back(spark, tmp_path):
    out = str(tmp_path / "hot")
    sinks.write_feature_collection(cells(spark), out, ["grid_id"])
    part, = [f for f in os.listdir(out) if f.startswith("part")]
    document = json.loads(open(os.path.join(out, part)).read())
    assert document["type"] == "FeatureCollection" and document["crs"]["type"] == "name"
    assert [f["properties"]["grid_id"] for f in document["features"]] == [0, 1, 2]
    ring, = document["features"][1]["geometry"]["coordinates"]
    assert ring[0] == ring[-1] == [0.5, 1.0] and len(ring) == 5
    assert files.scan_geojson(spark, out).count() == 3


def test_feature_collection_of_any_size(spark, tmp_path):
    sinks.write_feature_collection(cells(spark, 500), str(tmp_path / "x"), ["grid_id"])
    sinks.write_feature_collection(cells(spark, 0), str(tmp_path / "none"), ["grid_id"])
    for name, n in (("x", 500), ("none", 0)):
        part, = [p for p in os.listdir(tmp_path / name) if p.startswith("part")]
        assert len(json.loads(open(tmp_path / name / part).read())["features"]) == n


def test_ids_of_two_boundary_files_differ(spark, tmp_path):
    for name in ("one", "two"):
        sinks.write_feature_collection(cells(spark, 1), str(tmp_path / "b" / name), ["grid_id"])
    rows = files.scan_geojson(spark, str(tmp_path / "b" / "*")).collect()
    assert len(rows) == len({r["polygon_id"] for r in rows}) == 2


def test_a_repeated_feature_line_is_one_feature(spark, tmp_path):
    sinks.write_feature_lines(cells(spark, 2).union(cells(spark, 2)), str(tmp_path / "f"), ["grid_id"])
    assert files.scan_geojson(spark, str(tmp_path / "f"), feature_lines=True).count() == 2


def test_long_quoted_fields_are_read(spark, tmp_path):
    long = "x" * 100_000 + '""' + "y,z"
    (tmp_path / "long.csv").write_text(f'a,b\n1,"{long}"\n2,3,4\n5,6\n')
    rows = files.scan_csv_skip_long(spark, str(tmp_path / "long.csv")).collect()
    assert [r["a"] for r in rows] == ["1", "5"] and len(rows[0]["b"]) == 100_004


def test_feature_lines_and_back(spark, tmp_path):
    sinks.write_feature_lines(cells(spark, 50), str(tmp_path / "grid"), ["grid_id"])
    assert files.scan_geojson(spark, str(tmp_path / "grid"), feature_lines=True).count() == 50


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you'), (2, None)], "a int, b string").repartition(4)
    out = str(tmp_path / "out")
    sinks.write_csv(df, out, files=1)
    sinks.write_csv(df, out, files=1)
    part, = [f for f in os.listdir(out) if f.startswith("part")]
    assert part.endswith(".csv")
    lines = open(os.path.join(out, part)).read().splitlines()
    assert lines[0] == "a,b" and sorted(lines[1:]) == ['1,"say \\"hi\\", you"', "2,"]


def test_csv_batch_replay_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "rows")
    write_batch = sinks.csv_batch_writer(out, files=1)
    write_batch(spark.range(5), 0)
    write_batch(spark.range(5, 8), 1)
    write_batch(spark.range(5, 8), 1)
    assert spark.read.csv(out).count() == 8
    assert sorted(f for f in os.listdir(out) if "batch" in f) == ["batch_id=0", "batch_id=1"]


def test_csv_batch_error_is_raised(spark, tmp_path):
    with pytest.raises(Exception):
        sinks.csv_batch_writer(str(tmp_path / "rows"))(spark.range(3).select(F.raise_error(F.lit("no"))), 0)


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    write(tmp_path / "d" / "one.csv", 'A,B,"C, c"\n1,2,3\n1,2,3,4\n5\n')
    write(tmp_path / "d" / "two.csv", '\ufeff"C, c",A\nx,y\nx,y,z\n"q,""r""",s\n')
    write(tmp_path / "d" / "sub" / "three.csv", "A,B,\"C, c\"\r\n7,8,9\r\n")
    write(tmp_path / "d" / "none.csv", "")
    write(tmp_path / "d" / "_hidden.csv", "Z\n1\n")
    df = files.scan_csv_skip_long(spark, str(tmp_path / "d"))
    rows = sorted(map(tuple, df.select("A", "B", "C, c").collect()), key=str)
    assert df.columns[:3] and set(df.columns) == {"A", "B", "C, c"}
    assert rows == sorted([("1", "2", "3"), ("5", None, None), ("y", None, "x"), ("s", None, 'q,"r"'),
                           ("7", "8", "9")], key=str)
    again = files.scan_csv_skip_long(spark, str(tmp_path / "d" / "*.csv"), columns=["a", "b", "c"])
    assert again.columns == ["a", "b", "c"]


def test_first_lines_of_compressed_files(spark, tmp_path):
    spark.createDataFrame([("1", "2")], "u string, v string").coalesce(1).write.option(
        "header", True).option("compression", "gzip").csv(str(tmp_path / "z"))
    write(tmp_path / "z" / "plain.csv", "v,u\n4,3\n")
    names = files.data_files(spark, str(tmp_path / "z"))
    assert sorted(files.first_lines(spark, names).values()) == ["u,v", "v,u"]
    rows = files.scan_csv_skip_long(spark, str(tmp_path / "z")).select("u", "v").collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("copy", [True, False])
def test_feature_collection_in_parts(spark, tmp_path, copy):
    """Many tasks write it; the parts in order of their names are the document."""
    out = tmp_path / "hot"
    shuffled = cells(spark, 700).orderBy(F.rand(1))
    how = sinks.write_feature_collection(shuffled, str(out), ["grid_id"], part_rows=100, copy=copy)
    parts = sorted(p for p in os.listdir(out) if p.startswith("part"))
    assert (how, len(parts) == 1) == (("copy", True) if copy else ("parts", False))
    texts = [(out / p).read_text() for p in parts]
    document = json.loads("".join(texts))
    assert [f["properties"]["grid_id"] for f in document["features"]] == list(range(700))
    if not copy:
        assert len(parts) >= 6 and max(t.count("\n") for t in texts) < 300


def test_feature_collection_is_read_by_many_tasks(spark, tmp_path):
    """A written FeatureCollection is split by lines; no task reads the whole document."""
    out = str(tmp_path / "big")
    sinks.write_feature_collection(cells(spark, 3000), out, ["grid_id"], part_rows=500)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = files.scan_geojson(spark, out, collection_lines=True)
        assert lines.rdd.getNumPartitions() > 1
        got = lines.select(F.col("properties")["grid_id"], "part_no", "ring_no", "ring").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    whole = files.scan_geojson(spark, out).select(
        F.col("properties")["grid_id"], "part_no", "ring_no", "ring").collect()
    assert len(got) == 3000 and sorted(got) == sorted(whole)
