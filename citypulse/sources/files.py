"""File sources. Every reader takes an explicit schema and splits files over tasks where the format allows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.session import cut_lineage
from citypulse.sources import json_ranges

# Name of the Korean code page in the JVM.
KOREAN = "MS949"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows; timestamps without a zone become UTC timestamps (event time needs a zone)."""
    df = spark.read.parquet(path)
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoneless}) if zoneless else df


def read_delimited(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = "|", encoding: str = "UTF-8"
) -> DataFrame:
    """Headed delimited files, columns by the names in the header. A malformed field is NULL, the rest of its row stays.

    Further columns are ignored; a missing one is an error, and so is a file whose header differs from
    that of the first (``read_delimited_tree`` takes those).
    """
    if encoding != "UTF-8":
        # Other code pages than the Unicode ones need the JVM's own charsets; lines still split on a
        # newline byte, which is never part of a Korean character.
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    options = {"header": "true", "sep": sep, "mode": "PERMISSIVE", "encoding": encoding}
    names = spark.read.options(**options).csv(paths).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {paths}")
    kinds = {f.name: f.dataType for f in schema.fields}
    in_file = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    rows = spark.read.schema(in_file).options(**options, enforceSchema="false").csv(paths)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )


def find_files(spark: SparkSession, root: str, pattern: str, recursive: bool = True) -> list[str]:
    """Paths under ``root`` whose file name matches the pattern. File contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return sorted(row["path"] for row in reader.load(root).select("path").collect())


def newest_file(spark: SparkSession, root: str, pattern: str) -> str:
    """The matching file in ``root`` whose name sorts last."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root)
    newest = listed.agg(F.max_by("path", F.substring_index("path", "/", -1)).alias("path")).first()["path"]
    if newest is None:
        raise FileNotFoundError(f"no file matching {pattern} in {root}")
    return newest


def _inspect(spark: SparkSession, paths: list[str], detect_encoding: bool) -> list:
    """Header and code page of every file, aggregated on the executors to one row per file.

    The driver already lists the files, so a row for each is no more than it holds anyway.
    Without encoding detection only the first split of each file is read.
    """
    lines = _lines(spark, paths)
    first = F.first(F.when(F.col("start") == 0, F.col("value").cast("binary")), ignorenulls=True)
    if not detect_encoding:
        lines = lines.filter(F.col("start") == 0)
    found = lines.groupBy("path").agg(
        first.alias("header"), F.bool_and(F.is_valid_utf8(F.col("value").cast("binary"))).alias("utf8")
    )
    return found.collect()


def read_delimited_tree(
    spark: SparkSession,
    root: str,
    pattern: str,
    schema: T.StructType,
    sep: str = "|",
    detect_encoding: bool = True,
) -> DataFrame:
    """All matching files below ``root`` as one frame, columns matched by header name.

    Files that are not valid UTF-8 throughout are read in the Korean code page. Files with the same
    header and code page are read together; columns a file lacks are NULL, others are ignored.
    A corrupt file is an error, which names it.
    """
    paths = find_files(spark, root, pattern)
    if not paths:
        return spark.createDataFrame([], schema)
    groups: dict[tuple, list[str]] = {}
    for row in _inspect(spark, paths, detect_encoding):
        encoding = "UTF-8" if row["utf8"] or not detect_encoding else KOREAN
        header = bytes(row["header"] or b"").decode("utf-8" if encoding == "UTF-8" else "cp949", "replace")
        names = tuple(name.strip().strip('"') for name in header.lstrip("\ufeff").rstrip("\r").split(sep))
        groups.setdefault((names, encoding), []).append(row["path"])
    kinds = {field.name: field.dataType for field in schema.fields}
    frames = []
    for (names, encoding), members in sorted(groups.items()):
        unique = [n if names.index(n) == i else f"_{i}" for i, n in enumerate(names)]
        in_file = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in unique])
        spark_reader = (
            spark.read.schema(in_file)
            .option("header", True)
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .option("encoding", encoding)
        )
        if encoding != "UTF-8":
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        part = spark_reader.csv(sorted(members))
        columns = [
            F.col(f.name) if f.name in unique else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
        ]
        frames.append(part.select(*columns))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def read_zipped(
    spark: SparkSession, root: str, member: str, schema: T.StructType, sep: str = "|", members_per_task: int = 1
) -> DataFrame:
    """Rows of the members of ZIP archives whose name contains ``member`` and ends in .csv.

    First the directories at the ends of the archives are read, and no more of them. Then the members are
    dealt out, the largest first: a task opens an archive by path, reads the bytes of its member alone and
    streams them in batches, so neither an archive nor a member is ever held whole. A member is compressed
    as a whole and cannot be split. Rows keep the archive in ``archive``. Columns are matched by header name.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(root).select("path")
    listed = cut_lineage(paths.mapInArrow(_zip_members(member.lower()), "archive string, name string, bytes long"))
    count = listed.count()
    # In turn by size, so that the large members go to different tasks.
    ranked = listed.withColumn("turn", F.row_number().over(Window.orderBy(F.desc("bytes"), "archive", "name")))
    tasks = max(1, -(-count // members_per_task))
    spread = ranked.select("archive", "name", (F.col("turn") % tasks).alias("task")).repartitionById(tasks, F.col("task").cast("int")).select("archive", "name")
    names = [field.name for field in schema.fields]
    as_text = T.StructType([T.StructField("archive", T.StringType())] + [T.StructField(n, T.StringType()) for n in names])
    rows = spread.mapInArrow(_zip_rows(sep, names), as_text)
    return rows.select("archive", *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _opened(path: str):  # noqa: ANN202
    """A file that can be read from any place, by its path."""
    from pyarrow import fs

    place = path.replace("file:", "file://", 1) if path.startswith("file:/") and "://" not in path else path
    system, inner = fs.FileSystem.from_uri(place)
    return system.open_input_file(inner)


def _zip_members(member: str):
    """Task function: the wanted members of archives, from the directories at their ends."""

    def read(batches):
        import zipfile

        import pyarrow as pa

        for paths in batches:
            for path in paths.column(0).to_pylist():
                with _opened(path) as handle, zipfile.ZipFile(handle) as archive:
                    found = [i for i in archive.infolist() if member in i.filename.lower() and i.filename.endswith(".csv")]
                columns = [pa.array([path] * len(found), pa.string()), pa.array([i.filename for i in found], pa.string()), pa.array([i.compress_size for i in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["archive", "name", "bytes"])

    return read


def _zip_rows(sep: str, names: list[str]):
    """Task function: rows of archive members as batches of text columns."""

    def read(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import csv

        class Decoded(io.RawIOBase):
            """UTF-8 bytes of a member: as they are, or from the Korean code page from the first line that is not valid."""

            def __init__(self, stream):
                self.lines, self.encoding, self.rest = stream, "utf-8", b""

            def readable(self):
                return True

            def readinto(self, out):
                parts, size = [self.rest], len(self.rest)
                while size < len(out) and (line := self.lines.readline()):
                    try:
                        line.decode(self.encoding)
                    except UnicodeDecodeError:
                        self.encoding = "cp949"
                    parts.append(line if self.encoding == "utf-8" else line.decode(self.encoding, "replace").encode())
                    size += len(parts[-1])
                whole = b"".join(parts)
                n = min(len(out), size)
                out[:n], self.rest = whole[:n], whole[n:]
                return n

        for wanted in batches:
            for path, name in zip(wanted.column(0).to_pylist(), wanted.column(1).to_pylist(), strict=True):
                with _opened(path) as handle, zipfile.ZipFile(handle) as archive, archive.open(name) as stream:
                    reader = csv.open_csv(
                        io.BufferedReader(Decoded(stream)),
                        parse_options=csv.ParseOptions(delimiter=sep),
                        convert_options=csv.ConvertOptions(
                            column_types={n: pa.string() for n in names}, include_columns=names,
                            include_missing_columns=True, strings_can_be_null=False,
                        ),
                    )
                    for rows in reader:
                        columns = [rows.column(n).cast(pa.string()) for n in names]
                        yield pa.RecordBatch.from_arrays([pa.array([path] * rows.num_rows, pa.string()), *columns], ["archive", *names])

    return read


def read_lookup_json(spark: SparkSession, path: str, value_type: str = "string") -> DataFrame:
    """``key, value`` rows of a JSON object of scalars, read by several tasks. Also takes an object stored as a JSON string.

    That one is a single value, which one task parses.
    """
    kind = f"map<string,{value_type}>"
    begin = spark.read.option("lineSep", ",").text(path).select(F.regexp_extract("value", r"\S", 0).alias("sign")).filter("sign <> ''").first()
    if begin is not None and begin[0] == '"':
        text = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
        inner = F.from_json(F.get_json_object(F.concat(F.lit('{"doc":'), "doc", F.lit("}")), "$.doc"), kind)
        return text.select(F.explode(inner).alias("key", "value"))
    entry = F.concat(F.lit("{"), "value", F.lit("}"))
    return json_ranges.members(spark, path, 1, ",").select(F.explode(F.from_json(entry, kind)).alias("key", "value"))


def read_geojson(spark: SparkSession, path: str, properties: list[str], one_feature_per_line: bool = False) -> DataFrame:
    """Polygon features: the named properties (text), ``rings``, all rings of all parts, and ``ring_parts``, the part of each.

    A feature collection may stand on one line: it is read by ranges of bytes, in two passes. Written with one
    feature per line (as most writers do) ``one_feature_per_line=True`` needs one pass.
    """
    wanted = ", ".join(f"`{p}` string" for p in properties)
    feature = f"struct<type: string, properties: struct<{wanted.replace('` string', '`: string')}>, geometry: struct<type: string, coordinates: string>>"
    if one_feature_per_line:
        lines = spark.read.text(path).filter(F.col("value").contains('"Feature"'))
        body = F.regexp_replace(F.col("value"), r",\s*$", "")
        features = lines.select(F.from_json(body, feature).alias("f"))
    else:
        # Below the collection's own object (1) is its list of features (2).
        features = json_ranges.members(spark, path, 2).select(F.from_json("value", feature).alias("f")).filter("f.type = 'Feature'")
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>"))).when(
        kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")
    )
    numbers = F.flatten(F.transform("parts", lambda part, i: F.transform(part, lambda ring: i)))
    return features.select("f", parts.alias("parts")).filter(F.col("parts").isNotNull()).select(
        *[F.col("f.properties")[p].alias(p) for p in properties], F.flatten("parts").alias("rings"), numbers.alias("ring_parts")
    )


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read of a query; with a partition column it is read in ranges, in parallel."""
    options = {"url": url, "dbtable": f"({query.strip().rstrip(';')}) q", "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_query(spark: SparkSession, **options: object) -> DataFrame:
    """Rows of a database query; see :func:`jdbc_options`. Credentials come from the caller only."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


