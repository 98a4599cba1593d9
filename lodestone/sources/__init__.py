"""Readers and writers: Parquet tables, JSON lines, sessions, vectors, symbol maps, tables, rosters, chunk files."""

from __future__ import annotations

import io
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a stored session that the operators use.
SESSION = "metadata map<string,string>, analyzed_functions map<string,struct<address:string,old_name:string,new_name:string,behavior_summary:string,analysis_timestamp:double>>, rag_vectors array<array<double>>, analysis_log array<string>"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, below the one that the session names; a temporary one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        base = f"file://{tempfile.mkdtemp(prefix='lodestone-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file session JSON, one row per file, newest first by its last_modified."""
    return spark.read.schema(SESSION).option("multiLine", True).json(path).orderBy(F.desc_nulls_last(F.col("metadata")["last_modified"]))


def session_functions(sessions: DataFrame) -> DataFrame:
    """session_id and one row per analyzed function."""
    rows = sessions.select(F.col("metadata")["session_id"].alias("session_id"), F.explode("analyzed_functions").alias("key", "f"))
    return rows.select("session_id", "key", "f.*")


def write_sessions(sessions: DataFrame, path: str, vectors: bool = True) -> None:
    """Sessions as JSON with their counters made anew; without vectors those are left out."""
    named = F.filter(F.map_values("analyzed_functions"), lambda f: F.coalesce(f["new_name"], f["old_name"]) != f["old_name"])
    counts = F.map_from_arrays(F.array(F.lit("total_functions"), F.lit("renamed_functions")), F.array(F.coalesce(F.cardinality("analyzed_functions"), F.lit(0)).cast("string"), F.coalesce(F.size(named), F.lit(0)).cast("string")))
    rest = F.map_filter("metadata", lambda k, _: ~k.isin("total_functions", "renamed_functions"))
    out = sessions.withColumn("metadata", F.map_concat(rest, counts))
    (out if vectors else out.drop("rag_vectors")).write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)  # one file a session


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; broken lines give nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def append_events(df: DataFrame, path: str, most: int = 32 << 20) -> None:
    """Appends JSON lines; a folder that has reached ``most`` bytes becomes path.1 first and a new one begins."""
    jvm = df.sparkSession.sparkContext._jvm
    folder, spare = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.1"))
    store = folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if store.exists(folder) and store.getContentSummary(folder).getLength() >= most:
        store.delete(spare, True)
        store.rename(folder, spare)
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str, kind: str, last: int, order: str = "timestamp") -> DataFrame:
    """The last records of one interaction type."""
    return read_events(spark, path, schema).where(F.col("interaction_type") == kind).orderBy(F.desc(order)).limit(last)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """row, embedding from a matrix stored as .npy."""

    def rows(batches):
        for pdf in batches:
            for content in pdf["content"]:
                m = np.load(io.BytesIO(content), allow_pickle=False)
                for i in range(0, len(m), 4096):
                    part = m[i : i + 4096].astype(np.float32)
                    yield pd.DataFrame({"row": np.arange(i, i + len(part)), "embedding": list(part)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "row long, embedding array<float>")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """path, at, value: the lines of text files with their numbers."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("at", "value"))


def read_symbol_map(spark: SparkSession, path: str) -> DataFrame:
    """address, name from lines of an address of 8 hex digits, three columns and a name, which may hold blanks; the last line of an address wins."""
    cells = F.split(F.rtrim("value"), r"\s+", 5)
    rows = _lines(spark, path).select("path", "at", cells.alias("c")).where((F.size("c") == 5) & F.get("c", F.lit(0)).rlike("^[0-9a-fA-F]{8}$") & (F.get("c", F.lit(4)) != ""))
    rows = rows.select(F.conv(F.get("c", F.lit(0)), 16, 10).cast("long").alias("address"), F.get("c", F.lit(4)).alias("name"), F.struct("path", "at").alias("place"))
    return rows.groupBy("address").agg(F.max_by("name", "place").alias("name"))


def read_pipe_table(spark: SparkSession, path: str) -> DataFrame:
    """path, at, cells of Markdown table rows without separators."""
    lines = _lines(spark, path).where(F.col("value").rlike(r"^\s*\|") & ~F.col("value").rlike(r"^[\s|:-]+$"))
    return lines.select("path", "at", F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\|+|\|+$", ""), r"\|"), lambda x: F.trim(x)).alias("cells"))


def read_offset_table(spark: SparkSession, path: str) -> DataFrame:
    """offset, kind, meaning from table rows of four cells or more that start with hexadecimal offsets; headings are left out, the last row of an offset wins."""
    rows = read_pipe_table(spark, path).where(F.size("cells") >= 4)
    rows = rows.select(F.struct("path", "at").alias("place"), F.get("cells", F.lit(1)).alias("kind"), F.element_at("cells", -1).alias("meaning"), F.explode(F.regexp_extract_all(F.get("cells", F.lit(0)), F.lit("0x[0-9a-fA-F]{2,4}"), F.lit(0))).alias("offset"))
    rows = rows.where((F.col("meaning") != "") & ~F.contains(F.lower("meaning"), F.lit("meaning")))
    return rows.groupBy(F.lower("offset").alias("offset")).agg(F.max_by(F.struct("kind", "meaning"), "place").alias("x")).select("offset", "x.*")


def read_roster(spark: SparkSession, path: str, separator: str = ",", key: str = "filename", pattern: str = "^pl[0-9a-f]{4}$") -> DataFrame:
    """Rows of delimited files whose key, trimmed and in lower case, has the pattern."""
    name = F.lower(F.trim(F.col(key)))
    return spark.read.csv(path, header=True, sep=separator).where(name.rlike(pattern)).withColumn(key, name)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """name, address from lines "address tab name ..."; the first line of a name wins, others than 8 hex digits are no address.

    Spark skips files whose names begin with an underscore: such an index needs another name.
    """
    cells = F.split("value", "\t")
    rows = _lines(spark, path).select("path", "at", cells.alias("c")).where(F.size("c") >= 2)
    rows = rows.select("path", "at", F.lower(F.regexp_extract(F.trim(F.get("c", F.lit(0))), "^(?:0[xX])?([0-9a-fA-F]{8})$", 1)).alias("address"), F.get("c", F.lit(1)).alias("name")).where("address <> ''")
    return rows.groupBy("name").agg(F.min_by("address", F.struct("path", "at")).alias("address"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """path, address, name, body from files cut at lines "// ==== address name ====" ."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    parts = files.select("path", F.explode(F.slice(F.split("value", r"(?m)^// ==== "), 2, 1 << 30)).alias("p"))
    head = r"^(?:0x)?([0-9a-fA-F]+)\s+(.*?) ====\s*\n?"
    return parts.select("path", F.regexp_extract("p", head, 1).alias("address"), F.regexp_extract("p", head, 2).alias("name"), F.regexp_replace("p", head, "").alias("body"))


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    df.write.mode("overwrite").option("header", True).format(kind).save(path)
