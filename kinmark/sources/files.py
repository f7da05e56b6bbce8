"""Lists of identifiers as sources; XML files, CSV and identifier lists as sinks.

Edge cases: blank lines are left out; rows without an identifier are not
written; writing an empty table makes an empty folder.
"""

from __future__ import annotations

import os
import urllib.request
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.functions.identifiers import ark_file_name, file_name_ark, full_ark
from kinmark.session import named_shared_dir


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """canonical_id: one identifier a line, stripped and completed."""
    return spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").select(full_ark(F.col("v")).alias("canonical_id"))


def listed_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """canonical_id: the identifiers by which the files of a folder are named; their contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(path)
    return files.select(file_name_ark(F.element_at(F.split("path", "/"), -1)).alias("canonical_id"))


def mint(spark: SparkSession, start: int, n: int, shoulder: str = "ark:/00000/k") -> DataFrame:
    """canonical_id: ``n`` new identifiers from a counter, the same for the same ``start``."""
    return spark.range(start, start + n).select(F.concat(F.lit(shoulder), F.lpad(F.col("id").cast("string"), 12, "0")).alias("canonical_id"))


def service_identifiers(spark: SparkSession, address: str, n: int) -> DataFrame:
    """canonical_id: ``n`` new identifiers from a minting service; ``{}`` in its address stands for their number.

    The service answers with lines ``id: identifier``; others are left out.  An
    answer other than success raises.
    """
    with urllib.request.urlopen(address.replace("{}", str(n))) as answer:  # noqa: S310 (the address is the operator's own)
        if (answer.status or 200) >= 300:
            raise RuntimeError(f"{address}: status {answer.status}")
        lines = answer.read().decode().splitlines()
    ids = [(x.split(": ", 1)[1].strip(),) for x in lines if ": " in x]
    return spark.createDataFrame(ids, "v string").where("v <> ''").select(full_ark(F.col("v")).alias("canonical_id"))


def append_identifiers(ids: DataFrame, path: str) -> None:
    """Append identifiers to a list, one a line."""
    ids.select("canonical_id").where("canonical_id IS NOT NULL").write.mode("append").text(path)


def append_csv(rows: DataFrame, path: str) -> None:
    """Append rows to a CSV folder."""
    rows.write.mode("append").option("header", "false").csv(path)


def file_rows(records: DataFrame, xml: str = "record_data") -> DataFrame:
    """file_name, xml: what is written for each merged record."""
    return records.where(F.col("canonical_id").isNotNull() & F.col(xml).isNotNull()).select(ark_file_name(F.col("canonical_id")).alias("file_name"), F.col(xml).alias("xml"))


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder as an address that all executors understand.

    A path without scheme belongs to the default file system of the cluster; a
    machine's own disk is refused there, as every executor would write to its own.
    """

    def whole(path: str) -> str:
        if "://" in path:
            return path.rstrip("/")
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        base = jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf).toString().rstrip("/")
        return f"file://{os.path.abspath(path)}" if base.startswith("file:") else f"{base}/{path.strip('/')}"

    folder = whole(folder)
    if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        shared = named_shared_dir(spark)
        if not shared or not folder.startswith(whole(shared) + "/"):
            raise ValueError(f"{folder} is a machine's own disk: name a folder that all executors share")
    return folder


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write one file per row (file_name, xml) from the executors into a shared folder; gives file_name, bytes.

    Each file is written whole under a name of its own attempt and then moved to
    its place, so that a repeated task does no harm.
    """
    folder = shared_folder(rows.sparkSession, folder)

    def run(batches: Iterator) -> Iterator:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            sizes = []
            for name, text in zip(batch["file_name"], batch["xml"], strict=True):
                data = text.encode()
                part = f"{base}/.{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as f:
                    f.write(data)
                system.move(part, f"{base}/{name}")
                sizes.append(len(data))
            yield batch[["file_name"]].assign(bytes=sizes)

    return rows.select("file_name", "xml").mapInPandas(run, "file_name string, bytes bigint")
