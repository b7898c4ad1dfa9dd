"""File sinks: CSV in batch and per micro-batch, GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Coordinate system name written into feature collections (fixed value).
CRS_NAME = "urn:ogc:def:crs:OGC:1.3:CRS84"
#: Features of one numbered part.
FEATURES_PER_PART = 500_000


def write_csv(df: DataFrame, path: str, files: int | None = None, header: bool = True,
              mode: str = "overwrite") -> None:
    """Uncompressed CSV. ``files`` merges the output to that many parts at most;
    leave it unset for big results, so that all tasks write."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).option("header", header).option("compression", "none").csv(path)


def csv_batch_writer(path: str, files: int | None = None):
    """``foreachBatch`` function: headerless CSV in one folder per batch id.

    A replayed batch overwrites its own folder, so it cannot add rows twice. A
    failed write raises, and the checkpoint does not move past the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_csv(batch, f"{path}/batch_id={batch_id}", files, header=False)

    return write


def box_geometry() -> Column:
    """Closed polygon of a cell box, as nested coordinate arrays."""
    corner = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"),
              ("xmin", "ymin")]
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in corner])
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def cell_features(cells: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per cell, as text in ``feature``."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        box_geometry().alias("geometry"),
    )
    return cells.select("grid_id", F.to_json(feature).alias("feature"))


def write_feature_lines(cells: DataFrame, path: str, properties: list[str]) -> None:
    """One feature per line, written by all tasks: the form for grids of any size."""
    cell_features(cells, properties).select("feature").write.mode("overwrite").text(path)


def join_parts(spark: SparkSession, path: str, copy: bool | None = None) -> str:
    """Make one file of the numbered parts in ``path``; tells how: ``concat``, ``copy`` or ``parts``.

    Where the file system can put files together by itself it does, and no byte is read.
    Elsewhere the parts stay as they are: in order of their names they are the document. With
    ``copy`` their bytes are passed through a small buffer here instead; on a local disk that is
    the default.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(conf)
    parts = sorted((s.getPath() for s in store.listStatus(folder)
                    if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if len(parts) < 2:
        return "parts"
    try:
        rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            rest[i] = part
        store.concat(parts[0], rest)
        return "concat"
    except Exception as error:  # the gateway has one class for all Java errors
        if "UnsupportedOperation" not in f"{type(error).__name__} {error}":
            raise
    if copy is None:
        copy = store.getUri().getScheme() == "file"
    if not copy:
        return "parts"
    whole = jvm.org.apache.hadoop.fs.Path(path, "_joined")
    out = store.create(whole, True)
    for part in parts:
        stream = store.open(part)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 65536, False)
        stream.close()
    out.close()
    for part in parts:
        store.delete(part, False)
    store.rename(whole, parts[0])
    return "copy"


def write_feature_collection(cells: DataFrame, path: str, properties: list[str],
                             part_rows: int = FEATURES_PER_PART, copy: bool | None = None) -> str:
    """One FeatureCollection document of any size: a head line, one feature per line in order of
    ``grid_id``, and a tail line.

    Tasks write ranges of ids as numbered parts, the first with the head and the last with the
    tail; no task holds all features. ``join_parts`` then makes one file of them where it can,
    and its answer is returned. ``cells`` is read three times: hand in a written table.
    """
    features = cell_features(cells, properties)
    rows, first = features.agg(F.count(F.lit(1)), F.min("grid_id")).first()
    head = ('{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "'
            + CRS_NAME + '"}}, "features": [')
    spark = cells.sparkSession
    frame = spark.createDataFrame([(0, None, head), (2, None, "]}")],
                                  "part int, grid_id long, value string")
    comma = F.when(F.col("grid_id") == F.lit(first), "").otherwise(",")
    lines = features.select(F.lit(1).alias("part"), F.col("grid_id").cast("long").alias("grid_id"),
                            F.concat(comma, "feature").alias("value"))
    parts = max(1, -(-rows // part_rows))
    frame.union(lines).repartitionByRange(parts, "part", "grid_id") \
        .sortWithinPartitions("part", "grid_id").select("value").write.mode("overwrite").text(path)
    return join_parts(spark, path, copy)
