"""File sources: CSV scans, optional side tables, GeoJSON boundaries."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EXTRA = "__beyond_last_column"
_LINE = "__line"


def scan_csv(spark: SparkSession, path: str, schema=None, **options: str) -> DataFrame:
    """CSV with a header line. Types are inferred, at the cost of one more
    pass over the files, unless a schema is given."""
    reader = spark.read.option("header", "true").options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, length and time of change of the files under ``path`` (a file, folder or pattern)
    that Spark would read, through Hadoop."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found: list[tuple[str, int, int]] = []
    for top in store.globStatus(pattern) or []:
        root = top.getPath().toString()
        files = store.listFiles(top.getPath(), True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().toString()
            if not any(part[:1] in ("_", ".") for part in name[len(root):].split("/")):
                found.append((name, status.getLen(), status.getModificationTime()))
    return sorted(found)


def data_files(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _, _ in file_states(spark, path)]


def first_lines(spark: SparkSession, files: list[str], threads: int = 16) -> dict[str, str]:
    """First line of each file. One short read per file, as listing them is; no file is scanned."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def head(name: str) -> tuple[str, str]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        stream = path.getFileSystem(conf).open(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
                codec.createInputStream(stream) if codec else stream, "UTF-8"))
            return name, (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            stream.close()

    with ThreadPoolExecutor(threads) as pool:
        return dict(pool.map(head, files))


def scan_csv_skip_long(spark: SparkSession, path: str, columns: list[str] | None = None,
                       multi_line: bool = False) -> DataFrame:
    """CSV as text columns; lines with more fields than their file's header are left out.

    Short lines are kept, their missing fields null. Empty fields are null too. Every file
    has its own header: columns are found by name, those that a file lacks are null. Files of
    one header are one scan. With ``columns`` all files are taken to have these, in this order.
    """
    if columns is not None:
        return _skip_long(spark, path, columns, multi_line)
    by_header: dict[str, list[str]] = {}
    for name, line in first_lines(spark, data_files(spark, path)).items():
        by_header.setdefault(line, []).append(name)
    if len(by_header) < 2:
        columns = spark.read.option("header", "true").option("escape", '"').csv(path).columns
        return _skip_long(spark, path, columns, multi_line)
    out = None
    for line, names in by_header.items():
        header = next(csv.reader([line]), [])
        if not header:  # an empty file has no rows either
            continue
        rows = _skip_long(spark, names, header, multi_line)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _skip_long(spark: SparkSession, path: str | list[str], columns: list[str],
               multi_line: bool) -> DataFrame:
    """The scan asks for one column more than there is, so that Spark hands out
    the text of every line with another number of fields; the separators
    outside quotes then tell short and exact lines from long ones.
    """
    ddl = ", ".join(f"`{c}` string" for c in [*columns, _EXTRA, _LINE])
    raw = (
        spark.read.schema(ddl)
        .options(header="true", enforceSchema="true", escape='"', columnPruning="false",
                 multiLine=str(multi_line).lower(), columnNameOfCorruptRecord=_LINE)
        .csv(path)
    )
    unquoted = F.regexp_replace(_LINE, '"[^"]*"', "")
    separators = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(",")))
    # A line without text has exactly one field too many.
    fits = F.col(_LINE).isNotNull() & F.col(_EXTRA).isNull() & (separators < len(columns))
    return raw.filter(fits).select(
        *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through Hadoop, so any file system Spark reads will do."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def optional_csv(spark: SparkSession, path: str | None, schema: str) -> DataFrame | None:
    """A side table, or nothing when there is no path or no file. A file whose header lacks a
    column is an error: a default in its place would pass unnoticed."""
    if not path or not path_exists(spark, path):
        return None
    wanted = [part.split()[0].strip("`") for part in schema.split(",")]
    table = spark.read.option("header", "true").csv(path)
    types = [part.split()[1] for part in schema.split(",")]
    if missing := [n for n in wanted if n not in table.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return table.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, t in zip(wanted, types)])


_GEOMETRY = "struct<type: string, coordinates: string>"
_FEATURE_LINE = f"properties map<string, string>, geometry {_GEOMETRY}"
_COLLECTION = f"features array<struct<properties: map<string, string>, geometry: {_GEOMETRY}>>"
_POLYGON = "array<array<array<double>>>"


def scan_geojson(spark: SparkSession, path: str, feature_lines: bool = False,
                 collection_lines: bool = False) -> DataFrame:
    """Boundary polygons as rings: ``polygon_id, part_no, ring_no, ring, properties``.

    Reads one FeatureCollection per file, or with ``feature_lines`` one feature
    per line, which Spark can split; a line given twice is one feature. Rings come
    out closed. Ids tell apart the features of all files.

    With ``collection_lines`` each file is a FeatureCollection laid out as
    ``write_feature_collection`` writes it: a head line, one feature per line after a
    comma, and a tail line. Spark splits such files by lines too, so that no task reads a
    whole document; ids come from the file and the feature's line.
    """
    if collection_lines:
        line = F.regexp_replace("value", r"^\s*,", "")
        features = (
            spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("file"), line.alias("line"))
            .select("file", "line", F.from_json("line", _FEATURE_LINE).alias("feature"))
            .where(F.col("feature.geometry").isNotNull())
            .select(F.xxhash64("file", "line").alias("polygon_id"), "feature.*")
        )
    elif feature_lines:
        features = spark.read.schema(_FEATURE_LINE).json(path)
        features = features.withColumn(
            "polygon_id", F.xxhash64(F.to_json("properties"), "geometry.coordinates")) \
            .dropDuplicates(["polygon_id"])
    else:
        features = (
            spark.read.schema(_COLLECTION).option("multiLine", "true").json(path)
            .select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("place", "feature"))
            .select(F.xxhash64("file", "place").alias("polygon_id"), "feature.*")
        )
    shape = F.col("geometry.coordinates")
    # A polygon is a multi-polygon of one part.
    parts = F.when(
        F.col("geometry.type") == "MultiPolygon", F.from_json(shape, f"array<{_POLYGON}>")
    ).when(F.col("geometry.type") == "Polygon", F.array(F.from_json(shape, _POLYGON)))
    points = F.transform("coordinates", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return (
        features.select("polygon_id", "properties", F.posexplode(parts).alias("part_no", "rings"))
        .select("polygon_id", "properties", "part_no",
                F.posexplode("rings").alias("ring_no", "coordinates"))
        .select("polygon_id", "part_no", "ring_no", close_ring(points).alias("ring"), "properties")
    )


def close_ring(points):
    """Repeat the first point at the end unless it is there already."""
    first, last = F.get(points, F.lit(0)), F.get(points, F.size(points) - 1)
    return F.when(first == last, points).otherwise(F.concat(points, F.array(first)))
