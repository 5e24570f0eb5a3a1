"""Writers of the partitioned access log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from hitledger.functions.net import ip_to_long
from hitledger.functions.text import sql_literal
from hitledger.schema import ACCESS_LOG_TABLE, ADDRESS_NUMBERS, LAYOUT_COLUMNS, PARTITION_COLUMNS, QUERY_COLUMNS
from hitledger.workspace import Files, at_once

MAX_RECORDS_PER_FILE = 5_000_000
ORC_OPTIONS = {"orc.bloom.filter.columns": "domain,url", "orc.bloom.filter.fpp": "0.01"}
#: Partitions named in one catalog statement.
STATEMENT_PARTITIONS = 500


def stored_rows(rows: DataFrame) -> DataFrame:
    """Log rows with their addresses as numbers."""
    return rows.withColumns({name: ip_to_long(ip) for name, ip in ADDRESS_NUMBERS.items()})


def orc_writer(rows: DataFrame, by: Sequence[str], mode: str) -> DataFrameWriter:
    """Log files: within a file rows go by address, so that stripes hold ranges of it; domain and URL have Bloom filters."""
    # Dynamic partitions are written in this order anyway; the address is one more key.
    return (
        rows.sortWithinPartitions(*by, "batch", *ADDRESS_NUMBERS).write.mode(mode).options(**ORC_OPTIONS)
        .partitionBy(*by, "batch")
    )


def _writer(rows: DataFrame, root: str, mode: str, by: Sequence[str], balance: bool) -> DataFrameWriter:
    found = [name for name in Files(rows.sparkSession, root).levels(root) if name != "batch"]
    if found and found != list(by):
        raise ValueError(f"{root} is partitioned by {found}, not by {list(by)}")
    rows = stored_rows(rows).select(*QUERY_COLUMNS, *ADDRESS_NUMBERS, *LAYOUT_COLUMNS)
    if balance:
        # Adaptive rebalancing splits a hot house or minute over several tasks and
        # packs thin ones together, so file sizes follow the data.
        rows = rows.hint("rebalance", *by)
    return orc_writer(rows, by, mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)


def publish(
    rows: DataFrame, root: str, by: Sequence[str] = PARTITION_COLUMNS, balance: bool = True
) -> None:
    """Replace what a batch wrote before in every (partition, batch) it touches now.

    Publishing a batch twice is publishing it once. A partition that only the
    earlier run touched keeps the earlier rows. ``by`` may name fewer levels for
    a log too thin for 5-minute directories; the other columns go into the files.
    ``balance=False`` saves the shuffle where input files already hold one house
    and a few minutes each.
    """
    _writer(rows, root, "overwrite", by, balance).option("partitionOverwriteMode", "dynamic").orc(root)


def append(
    rows: DataFrame, root: str, by: Sequence[str] = PARTITION_COLUMNS, balance: bool = True
) -> None:
    """Add rows without replacing any; a repeated run repeats them."""
    _writer(rows, root, "append", by, balance).orc(root)


def create_log_table(spark: SparkSession, table: str, root: str, by: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Catalog table over the published log of these directory levels."""
    levels = [*by, "batch"]
    types = {f.name: f.dataType.simpleString() for f in ACCESS_LOG_TABLE}
    columns = [f"{c} {t}" for c, t in types.items() if c not in levels] + [f"{c} {types[c]}" for c in levels]
    spark.sql(
        f"create table if not exists {_name(table)} ({', '.join(columns)}) "
        f"using orc partitioned by ({', '.join(levels)}) location {sql_literal(root)}"
    )


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make the catalog find every partition directory written so far."""
    spark.sql(f"msck repair table {_name(table)}")


def add_partitions(spark: SparkSession, table: str, folders: Iterable[str]) -> None:
    """Partition directories (``hid=1/d=240101/...``) made known, many in a statement."""
    _alter(spark, table, "add if not exists", " ", folders)


def drop_partitions(spark: SparkSession, table: str, folders: Iterable[str]) -> None:
    """Partition directories forgotten; files stay as they are."""
    _alter(spark, table, "drop if exists", ", ", folders)


def _alter(spark: SparkSession, table: str, what: str, sep: str, folders: Iterable[str]) -> None:
    folders = sorted(set(folders))
    for at in range(0, len(folders), STATEMENT_PARTITIONS):
        specs = []
        for folder in folders[at : at + STATEMENT_PARTITIONS]:
            levels = (level.split("=", 1) for level in folder.split("/"))
            specs.append("partition (" + ", ".join(f"{name}={sql_literal(unquote(value))}" for name, value in levels) + ")")
        spark.sql(f"alter table {_name(table)} {what} {sep.join(specs)}")


def known_partitions(spark: SparkSession, table: str) -> set[str]:
    return {row[0] for row in spark.sql(f"show partitions {_name(table)}").collect()}


def stored_partitions(spark: SparkSession, root: str, within: Sequence[str] = ("",), batch: str = "*") -> set[str]:
    """Partition directories below the globs ``within`` that hold rows of batches of this name."""
    files = Files(spark, root)
    start, levels = len(files.qualified(root)) + 1, files.levels(root)
    found: set[str] = set()
    for glob in within:
        rest = len(levels) - 1 - len([level for level in glob.split("/") if level])
        pattern = "/".join([part for part in (root, glob) if part] + ["*=*"] * rest + [f"batch={batch}"])
        found |= {path[start:] for path in files.glob(pattern)} if rest >= 0 else set()
    return found


def register_batch(spark: SparkSession, table: str, root: str, batch_id: str) -> None:
    """Register the partitions that one batch wrote, and no others."""
    add_partitions(spark, table, stored_partitions(spark, root, batch=batch_id))


def register_partition(spark: SparkSession, table: str, **values: str | int) -> None:
    """One partition, known beforehand: a value for every level, in their order."""
    add_partitions(spark, table, ["/".join(f"{name}={value}" for name, value in values.items())])


def sync_partitions(spark: SparkSession, table: str, root: str) -> tuple[int, int]:
    """Catalog brought in step with the directories; returns how many were added and dropped."""
    known, stored = known_partitions(spark, table), stored_partitions(spark, root)
    drop_partitions(spark, table, known - stored)
    add_partitions(spark, table, stored - known)
    return len(stored - known), len(known - stored)


def expire(spark: SparkSession, root: str, before: str, table: str | None = None) -> int:
    """Remove the directories of days before ``before`` (yyMMdd), from the catalog first; returns how many."""
    day = lambda folder: next(level[2:] for level in folder.split("/") if level.startswith("d="))
    old = sorted(f for f in stored_partitions(spark, root) if day(f).isdigit() and len(day(f)) == 6 and day(f) < before)
    if table is not None:
        drop_partitions(spark, table, old)
    files = Files(spark, root)
    at_once([lambda f=f: files.remove(f"{root}/{f}") for f in old])
    return len(old)


def _name(table: str) -> str:
    """A table's name, quoted part by part."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in table.split("."))
