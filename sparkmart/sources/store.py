"""Tables on plain Parquet: loads, versions, the state rows and catalog views.

Large tables (bronze, silver, fact) hold one folder per load or part; each write goes to a folder
of its own and counts once a list that names the live folders is written. Small tables (dimensions,
state, the lists) get a new version folder per commit and readers take the newest complete one. So
no folder is overwritten or deleted while it is live, and a reader keeps what it started with until
the second commit after. The source table holds one folder per landed file, replaced as a whole.
One writer per store is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sparkmart.schema import LIVE, WATERMARK
from sparkmart.sources.files import empty_table
from sparkmart.sources.staging import CODEC

FIRST_LOAD = "0"  # folder name of the load that starts at the empty bound


def load_id(lo: str) -> str:
    """Folder key of the load above bound ``lo``; sorts like the bounds themselves."""
    return lo or FIRST_LOAD


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._lists: dict[str, list[tuple[str, str, str]]] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # file system -------------------------------------------------------------

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._hadoop_path(path).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._hadoop_path(path))

    def _children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._hadoop_path(path))]

    def children(self, table: str) -> list[str]:
        return self._children(self.path(table))

    # live folders --------------------------------------------------------------

    def live(self, name: str) -> list[tuple[str, str, str]]:
        """(table, part, folder) of the newest list ``name``, a row per live folder."""
        path = self.current_path(f"live/{name}")
        return [] if path is None else self._entries(path)

    def _entries(self, path: str) -> list[tuple[str, str, str]]:
        # A version never changes once it is complete.
        if path not in self._lists:
            self._lists[path] = [tuple(r) for r in self.spark.read.schema(LIVE).parquet(path).collect()]
        return self._lists[path]

    def new_part(self, name: str, table: str, part: str) -> str:
        """Folder for the next write of a part. A retry after a crash gets the same one again."""
        return f"{part}/r{max(self._versions(f'live/{name}'), default=0) + 1:08d}"

    def list_live(self, name: str, entries: Sequence[tuple[str, str, str]]) -> None:
        """Commits the list; folders that neither it nor the one before names are deleted."""
        table = f"live/{name}"
        self.commit(self.spark.createDataFrame([tuple(e) for e in entries], LIVE).coalesce(1), table)
        paths = [self._version_path(table, v) for v in self._versions(table)]
        complete = [p for p in paths if self.exists(f"{p}/_SUCCESS")]
        kept = {e for p in complete[-2:] for e in self._entries(p)} if len(complete) > 2 else set()
        for path in complete[:-2]:
            for of, _, folder in set(self._entries(path)) - kept:
                self.drop(f"{of}/{folder}")
            self.drop(path.removeprefix(f"{self.root}/"))

    def read_folders(self, table: str, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path(table)}/{f}" for f in sorted(folders)])

    # loads: one folder per load ----------------------------------------------

    def write_load(self, df: DataFrame, table: str, lo: str) -> None:
        """Adds or replaces the load that starts at ``lo``."""
        self._write_load(df, table, lo, [e for e in self.live(table) if e[1] != load_id(lo)])

    def write_loads_anew(self, df: DataFrame, table: str) -> None:
        """Replaces the whole table by one first load; ``df`` may read it."""
        self._write_load(df, table, "", [])

    def _write_load(self, df: DataFrame, table: str, lo: str, others: list[tuple[str, str, str]]) -> None:
        folder = self.new_part(table, table, f"load={load_id(lo)}")
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path(table)}/{folder}")
        self.list_live(table, [*others, (table, load_id(lo), folder)])

    def drop(self, table: str) -> None:
        path = self.path(table)
        self._fs(path).delete(self._hadoop_path(path), True)

    def read_loads(
        self, table: str, schema: StructType, since: str | None = None, before: str | None = None
    ) -> DataFrame:
        """All loads, or those that start at ``since`` or later and below ``before``."""
        chosen = [
            folder for _, load, folder in self.live(table)
            if (since is None or load >= load_id(since)) and (before is None or load < before)
        ]
        return self.read_folders(table, chosen, schema)

    def live_path(self, table: str) -> str:
        """The live folders of a table of loads as one path."""
        return self.glob(table, [folder for _, _, folder in self.live(table)])

    def glob(self, table: str, folders: Sequence[str]) -> str:
        return f"{self.path(table)}/" + (folders[0] if len(folders) == 1 else "{" + ",".join(sorted(folders)) + "}")

    def write_partitions(self, df: DataFrame, table: str, columns: Sequence[str]) -> None:
        """Replaces the partitions present in ``df`` and keeps all others.

        Spark writes aside and swaps the folders at commit, so ``df`` may read the table.
        """
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(*columns)
            .parquet(self.path(table))
        )

    def partition_values(self, table: str, column: str) -> list[str]:
        """Values of the partition column that have a folder."""
        names = self._children(self.path(table))
        return [n[len(column) + 1 :] for n in names if n.startswith(f"{column}=")]

    def read_partitions(self, table: str, schema: StructType) -> DataFrame:
        """A table of parts: the live ones where a list names them, else all that are there."""
        listed = [folder for name, _, folder in self.live("gold") if name == table]
        if listed:
            return self.read_folders(table, listed, schema)
        if not self.exists(self.path(table)):
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)

    # versions: a new folder per commit ---------------------------------------

    def _versions(self, table: str) -> list[int]:
        return sorted(int(n[2:]) for n in self._children(self.path(table)) if n.startswith("v="))

    def _version_path(self, table: str, version: int) -> str:
        return f"{self.path(table)}/v={version:08d}"

    def current_path(self, table: str) -> str | None:
        """Folder of the newest version that was written to its end."""
        for version in reversed(self._versions(table)):
            path = self._version_path(table, version)
            if self.exists(f"{path}/_SUCCESS"):
                return path
        return None

    def read_version(self, table: str, schema: StructType) -> DataFrame:
        path = self.current_path(table)
        if path is None:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    def commit(self, df: DataFrame, table: str) -> DataFrame:
        """Writes the next version and returns it as stored."""
        version = max(self._versions(table), default=0) + 1
        path = self._version_path(table, version)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_old_versions(self, table: str, keep: int = 2, but: Sequence[str] = ()) -> None:
        """Deletes versions nobody reads any more; the newest ``keep`` stay, and folders in ``but``."""
        for version in self._versions(table)[:-keep]:
            path = self._version_path(table, version)
            if path.rpartition("/")[2] not in but:
                self._fs(path).delete(self._hadoop_path(path), True)

    # state -------------------------------------------------------------------

    def read_state(self, name: str) -> DataFrame:
        return self.read_version(f"state/{name}", WATERMARK)

    def write_state(self, state: DataFrame, name: str) -> None:
        self.commit(state, f"state/{name}")

    # catalog -----------------------------------------------------------------

    def create_database(self, database: str) -> None:
        """Creates the namespace below the store; running it again is harmless."""
        location = self.path(f"{database}.db")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")

    def publish(self, database: str, table: str, path: str, columns: Sequence[str]) -> None:
        """Points the catalog name at ``path``; bookkeeping columns stay hidden."""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{table} AS "
            f"SELECT {', '.join(columns)} FROM parquet.`{path}`"
        )
