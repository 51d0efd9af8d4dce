"""Warehouse tables.

A table's rows lie in generations: folders beside each other, of which the catalogue names the current
one. A replacement writes a generation of its own and then changes the name in the catalogue, so a
write that fails, at whatever point, leaves the rows that were there. The facts are also
partitioned, by region, so that a question about a region reads its folders alone, and in slices of games.
Folders of partitions are named one by one: a replacement of some slices writes and changes those alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.schemas import DERIVED, LEDGER, TABLES
from pixeltally.session import hadoop_path

# The large tables are bucketed by the key that joins them and that views count
# distinctly, so neither needs a shuffle of the facts.
BUCKETED_BY = {"dim_game": "game_id", "fact_sales": "game_id"}

# Partitioned as well, by these and by groups of buckets, each replaceable on its own.
SLICED = {"fact_sales": ["region_id"]}
SLICE = "slice"
MOST_SLICES = 256

# The load that a row came with, in every table; null for rows of loads without an id.
LOAD = "load_id"
BEGUN, DONE = "begun", "done"


@dataclass
class Generation:
    """Rows written beside a table and not in it yet."""

    table: str
    staging: str
    place: str
    slices: list[int] | None
    rows: DataFrame


class Warehouse:
    """The star schema's tables in one database. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, buckets: int | None = None):
        """``buckets`` defaults to the session's shuffle partitions, which are sized for the cluster.

        Reading a bucketed table takes one task per bucket, so choose enough of them
        for a bucket to fit a task. Tables that exist keep the number they were made with.
        """
        self.spark = spark
        self.database = database
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._buckets_of: dict[str, int] = {}
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        self.root = spark.catalog.getDatabase(database).locationUri.rstrip("/")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        """The table's rows. What was resolved before a replacement reads the former rows until the next one."""
        return self.spark.table(self.name(table)).drop(LOAD, SLICE)

    def create_tables(self, tables: Sequence[str] = tuple(TABLES)) -> None:
        """Create the tables that do not exist yet."""
        there = {t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary}
        for table in tables:
            if table not in there:
                self._create(self.name(table), table, f"{self.root}/{table}/{_new_name()}", self.buckets)

    def _create(self, name: str, table: str, place: str, buckets: int) -> None:
        key = BUCKETED_BY.get(table)
        sliced = table in SLICED
        columns = f"{({**TABLES, **DERIVED})[table]}, {LOAD} STRING" + (f", {SLICE} INT" if sliced else "")
        layout = (f" PARTITIONED BY ({', '.join([*SLICED[table], SLICE])})" if sliced else "") + (f" CLUSTERED BY ({key}) INTO {buckets} BUCKETS" if key else "")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout} LOCATION '{place}'")

    def buckets_of(self, table: str) -> int:
        """The number of buckets that the table was made with."""
        if table not in self._buckets_of:
            self._buckets_of[table] = int(self._about(table, "Num Buckets"))
        return self._buckets_of[table]

    def _about(self, table: str, what: str) -> str:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)}").filter(F.col("col_name") == what)
        return rows.first()["data_type"]

    def slice_of(self, table: str, key: Column | str) -> Column:
        """The slice of a key: as many slices as divide the buckets, so each bucket lies in one slice."""
        buckets = self.buckets_of(table)
        slices = next(n for n in range(min(buckets, MOST_SLICES), 0, -1) if buckets % n == 0)
        return F.pmod(F.hash(key), F.lit(slices))  # the hash that Spark buckets by

    def slices_with(self, keys: DataFrame, table: str) -> list[int]:
        """The slices that hold any of the keys."""
        found = keys.select(self.slice_of(table, BUCKETED_BY[table]).alias(SLICE)).distinct()
        return sorted(row[0] for row in found.collect())

    def read_slices(self, table: str, slices: list[int]) -> DataFrame:
        """The rows of some slices with the load each came with; other folders are not read."""
        return self.spark.table(self.name(table)).filter(F.col(SLICE).isin(slices)).drop(SLICE)

    def _insert(self, name: str, rows: DataFrame, table: str) -> None:
        if table in SLICED:
            rows = rows.withColumn(SLICE, self.slice_of(table, BUCKETED_BY[table]))
        columns = ", ".join(rows.columns)
        if table in BUCKETED_BY:
            # The shuffle hashes as bucketing does, so each task writes one bucket's file.
            rows = rows.repartition(self.buckets_of(table), BUCKETED_BY[table])
        self.spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)

    # ---- replacement --------------------------------------------------------

    def stage(self, rows: DataFrame, table: str, slices: list[int] | None = None) -> Generation:
        """Write rows as a generation that nobody reads yet. ``rows`` may read the table itself.

        With ``slices`` they are all rows that those slices are to have; else all rows of the table.
        """
        self.vacuum(table)
        new = _new_name()
        staging, place = self.name(f"{table}_{new}"), f"{self.root}/{table}/{new}"
        self._create(staging, table, place, self.buckets_of(table) if table in BUCKETED_BY else 0)
        try:
            self._insert(staging, rows, table)
        except BaseException:
            self.spark.sql(f"DROP TABLE {staging}")  # its files go with the next vacuum
            raise
        return Generation(table, staging, place, slices, self.spark.table(staging).drop(LOAD, SLICE))

    def publish(self, *generations: Generation) -> None:
        """Make generations current: one change in the catalogue for a table, or for each slice of the facts.

        The former files stay until the table is staged or vacuumed again, for readers that have begun.
        """
        for new in generations:
            name = self.name(new.table)
            if new.table in SLICED:
                filled, there = self._partitions(new.staging), self._partitions(name)
                for part in sorted(filled):
                    verb = "" if part in there else "ADD "
                    to = "SET LOCATION" if part in there else "LOCATION"
                    self.spark.sql(f"ALTER TABLE {name} {verb}PARTITION ({part.replace('/', ', ')}) {to} '{new.place}/{part}'")
                for part in sorted(there - filled):
                    if new.slices is None or int(part.rpartition("=")[2]) in new.slices:
                        self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({part.replace('/', ', ')})")
            else:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{new.place}'")
            self.spark.sql(f"DROP TABLE {new.staging}")  # the name; its files are the table's now
            self.spark.catalog.refreshTable(name)

    def _partitions(self, name: str) -> set[str]:
        """As their folders are called, for example ``region_id=1/slice=7``."""
        return {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def refresh(self, rows: DataFrame, table: str, slices: list[int] | None = None) -> None:
        """Replace the table's rows, or those of some slices; if writing fails, the former rows stay."""
        self.publish(self.stage(rows, table, slices))

    def compact(self, table: str) -> None:
        """Rewrite the table, so that many small appends become one file per bucket again."""
        self.refresh(self.spark.table(self.name(table)).drop(SLICE), table)

    def vacuum(self, table: str) -> None:
        """Delete the folders that the table doesn't read: former generations, and what failed writes left."""
        top, file_system = hadoop_path(self.spark, f"{self.root}/{table}")
        if not file_system.exists(top):
            return
        folders = [status.getPath() for status in file_system.listStatus(top)]
        current = _folder(self._about(table, "Location"))
        if table not in SLICED:
            unused = [folder for folder in folders if _folder(folder.toString()) != current]
        elif len(folders) == 1:
            return  # nothing was replaced yet
        else:
            used = {_folder(name.rsplit("/", 1)[0]) for name in self.spark.table(self.name(table)).inputFiles()}
            unused = []
            for folder in folders:
                parts = [folder]
                for column in [*SLICED[table], SLICE]:
                    below = [s.getPath() for part in parts for s in file_system.listStatus(part)]
                    parts = [path for path in below if path.getName().startswith(f"{column}=")]
                gone = [part for part in parts if _folder(part.toString()) not in used]
                # The table's own folder stays, for slices to come.
                unused += gone if len(gone) < len(parts) or _folder(folder.toString()) == current else [folder]
        for folder in unused:
            file_system.delete(folder, True)

    # ---- appending ----------------------------------------------------------

    def append(self, rows: DataFrame, table: str, load_id: str | None = None) -> None:
        """Add rows; columns that ``rows`` lacks take their defaults.

        With a ``load_id`` the rows are added once, however often the same load is repeated and wherever it was
        interrupted: the ledger has a line before the rows are written and one after. A repeat of a load that
        ended adds nothing. A repeat of one that was interrupted looks for rows of that load: all of them are
        left as they are, a part of them goes first.
        """
        if load_id is None:
            self._insert(self.name(table), rows, table)
            return
        states = {row["state"] for row in self.loads(table).filter(F.col(LOAD) == load_id).select("state").distinct().collect()}
        if DONE in states:
            return
        if BEGUN not in states:
            self.begin(load_id, table)
        elif present := self.spark.table(self.name(table)).filter(F.col(LOAD) == load_id).count():
            if present == rows.count():
                self._record(load_id, table, DONE)
                return
            self._withdraw(load_id, table)
        self._insert(self.name(table), rows.withColumn(LOAD, F.lit(load_id)), table)
        self._record(load_id, table, DONE)

    def begin(self, load_id: str, table: str) -> None:
        """Note that a load begins to write; ``append`` does so itself."""
        self._record(load_id, table, BEGUN)

    @contextmanager
    def noted(self, table: str) -> Iterator[None]:
        """Note in the ledger that work on a table begins and, unless it fails, that it ended."""
        work = uuid.uuid4().hex
        self._record(work, table, BEGUN)
        yield
        self._record(work, table, DONE)

    def _withdraw(self, load_id: str, table: str) -> None:
        """Take out the rows of a load: only the slices that have any are rewritten."""
        rows = self.spark.table(self.name(table))
        slices = None
        if table in SLICED:
            slices = sorted(row[0] for row in rows.filter(F.col(LOAD) == load_id).select(SLICE).distinct().collect())
            rows = rows.filter(F.col(SLICE).isin(slices)).drop(SLICE)
        self.refresh(rows.filter(~F.col(LOAD).eqNullSafe(load_id)), table, slices)

    def loads(self, table: str | None = None) -> DataFrame:
        """The ledger: a line for each load that began and one for each that ended, by table."""
        columns = ", ".join(" ".join(column.split()[:2]) for column in LEDGER.split(", "))
        if not self.spark.catalog.tableExists(self.name("load_ledger")):
            return self.spark.createDataFrame([], columns)
        lines = self.spark.table(self.name("load_ledger"))
        return lines if table is None else lines.filter(F.col("table_name") == table)

    def _record(self, load_id: str, table: str, state: str) -> None:
        name = self.name("load_ledger")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER}) USING parquet")
        self.spark.sql(
            f"INSERT INTO {name} (load_id, table_name, state) VALUES (:load, :table, :state)",
            {"load": load_id, "table": table, "state": state})

    def counts(self, tables: list[str] | None = None) -> DataFrame:
        return row_counts({t: self.table(t) for t in tables or list(TABLES)})


def _new_name() -> str:
    return f"g{uuid.uuid4().hex}"


def _folder(path: str) -> str:
    """A path without its scheme, to compare."""
    return "/" + path.split(":", 1)[-1].strip("/")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
