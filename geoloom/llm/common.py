"""What the operators of this subpackage share: table access, lineage cuts, names."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.lineage import cut, shared_dir

#: The white space of the contracts: space and the five ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that written() has made in this process and discard() has not deleted yet.
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Materialise a large table as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(at)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def made() -> list[str]:
    """The folders of written() that are still there."""
    return list(_WRITTEN)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of written() whose tables are read no more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for at in folders:
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(conf).delete(path, True)
        if at in _WRITTEN:
            _WRITTEN.remove(at)


#: Plan nodes that pass each row of a file on as it is, or leave it out.
_ROWWISE = {"LogicalRelation", "Project", "Filter", "SubqueryAlias"}


def _from_files(plan) -> bool:
    children = plan.children()
    return plan.nodeName() in _ROWWISE and all(_from_files(children.apply(i)) for i in range(children.size()))


def numberable(docs: DataFrame) -> DataFrame:
    """The rows as a scan of files, whose rows have fixed places; any other table is written first."""
    plan = docs._jdf.queryExecution().analyzed()
    return docs if _from_files(plan) and plan.deterministic() else written(docs, "rows")


def row_number(docs: DataFrame) -> Column:
    """A number of each row of a numberable table: a hash of its file and its place there, the same in every scan, whatever tasks are repeated.

    Two of N rows share a number with a chance of N * N / 2 ** 65; keys take the id beside it.
    """
    at = docs.metadataColumn("_metadata")
    return F.xxhash64(at["file_path"], at["row_index"])


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose tables are materialised and no longer held.

    Spark's cleaner waits for the driver to collect its garbage, which a quiet driver does rarely.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(name: str, *taken: list[str]) -> str:
    """A column name that none of the given lists holds (in any letter case)."""
    used = {c.lower() for names in taken for c in names}
    while name.lower() in used:
        name += "_"
    return name


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % n


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and further columns; all else is left unread."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)
