"""Source tables kept as files, read with their declared schema."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.plans.entities import ENTITIES
from deskspark.plans.spec import EntitySpec

# NULL, the empty string and blanks must stay apart in CSV.
CSV_OPTIONS = {
    "header": "true", "nullValue": "\\N", "multiLine": "true", "escape": '"', "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "enforceSchema": "false",
}
JSON_OPTIONS = {"mode": "FAILFAST"}
ROWS_PER_CSV_FILE = 1_000_000
FILES_PER_TASK = 64
# Schemes that Hadoop and Arrow name differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
FOUND = "file string, found array<string>"


class FileContract(ValueError):
    """Files that lack declared columns, or hold them in another order where order counts."""


def _file_names(spark: SparkSession, path: str) -> DataFrame:
    """(path): the data files of a folder, as Spark lists them; nothing of their content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return listed.repartition(max(1, -(-len(listed.inputFiles()) // FILES_PER_TASK)))


def _footers(fmt: str):
    """For mapInPandas: the column names in the footer (Parquet, ORC) or first line (CSV) of each file."""

    def names(batches):
        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.orc as orc
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for file in batch["path"]:
                scheme, _, rest = file.partition(":")
                if scheme == "file":
                    fs, inside = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    fs, inside = pafs.FileSystem.from_uri(quote(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}", safe=":/@?&="))
                with fs.open_input_file(inside) as stream:
                    if fmt == "parquet":
                        columns = list(pq.read_schema(stream).names)
                    elif fmt == "orc":
                        columns = list(orc.ORCFile(stream).schema.names)
                    else:
                        columns = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline="")), None)
                found.append(columns)
            yield pd.DataFrame({"file": batch["path"], "found": found})

    return names


def columns_by_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(file, found): the column names in each file below `path`, from footers, header lines, or,
    for JSON, the fields that any line of the file has. `found` is NULL for a CSV file without a line;
    a JSON file without a line has no row. Storage has to be one that Arrow reads too (local or mounted
    disks, HDFS and the common object stores)."""
    if fmt in ("parquet", "orc", "csv"):
        return _file_names(spark, path).mapInPandas(_footers(fmt), FOUND)
    if fmt != "json":
        raise ValueError(f"no file contract for {fmt!r}")
    lines = spark.read.text(path).filter("trim(value) <> ''").select(
        F.col("_metadata.file_path").alias("file"), F.json_object_keys("value").alias("names"))
    return lines.groupBy("file", "names").count().groupBy("file").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("found"))


def audit_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """(file, missing, reordered): the files at `path` that break the contract of `schema`.

    Names are compared without case, as Spark's readers do. More columns are allowed, but not in CSV, whose
    lines are read by place: there header and schema must agree. Empty files say nothing and pass.
    """
    wanted = [c.lower() for c in schema.names]
    names = F.array(*(F.lit(c) for c in wanted))
    seen = columns_by_file(spark, path, fmt).filter("found IS NOT NULL").withColumn("found", F.transform("found", F.lower))
    checked = seen.select("file", F.array_except(names, "found").alias("missing"),
                          (F.lit(fmt == "csv") & (F.col("found") != names)).alias("reordered"))
    return checked.filter("size(missing) > 0 OR reordered")


def require_contract(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Raise FileContract, naming the first files, if any file at `path` breaks the contract."""
    bad = audit_files(spark, path, schema, fmt).orderBy("file").take(5)
    if bad:
        raise FileContract("; ".join(
            f"{r.file} lacks the columns {', '.join(r.missing)}" if r.missing else f"{r.file} has more columns or another order"
            for r in bad))


def read_file(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", audited: bool = False) -> DataFrame:
    """The table at `path`, every file of which has to have all declared columns (see `audit_files`).

    Columns of Parquet, ORC and JSON go by name. Lines that cannot be read fail, in CSV and JSON, and so do
    Parquet columns of a type that does not fit. In JSON a column must occur in some line of each file, if
    only as null. `audited` spares the look at the files where it was done before.
    """
    options = {"csv": CSV_OPTIONS, "json": JSON_OPTIONS}.get(fmt, {})
    if not audited:
        require_contract(spark, path, schema, fmt)
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def write_file(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """CSV files are bounded in rows, as a file with line breaks inside values cannot be split. JSON
    lines name their NULL columns too, so that a column of NULLs is not taken for a missing one."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**{k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode", "enforceSchema")})
        writer = writer.option("maxRecordsPerFile", ROWS_PER_CSV_FILE)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(path)


class FileSource(Mapping):
    """name -> DataFrame over `<root>/<name>`, for Parquet, ORC, JSON or CSV folders. The files of a
    folder are audited when the table is first asked for; `audit` does it again, after files were added."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet",
                 specs: Mapping[str, EntitySpec] = ENTITIES):
        self.spark, self.root, self.fmt, self.specs = spark, root.rstrip("/"), fmt, specs
        self._audited: set[str] = set()

    def audit(self, name: str) -> None:
        require_contract(self.spark, f"{self.root}/{name}", self.specs[name].source_schema, self.fmt)
        self._audited.add(name)

    def __getitem__(self, name: str) -> DataFrame:
        schema = self.specs[name].source_schema
        if name not in self._audited:
            self.audit(name)
        return read_file(self.spark, f"{self.root}/{name}", schema, self.fmt, audited=True)

    def __iter__(self) -> Iterator[str]:
        return iter(self.specs)

    def __len__(self) -> int:
        return len(self.specs)
