"""The store tables as Parquet folders, and the JDBC way in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.relate import set_flag, with_new_ids
from reviewloom.schemas import TABLES

#: Codec of the tables' files: texts take a third less than with Spark's default.
CODEC = "zstd"


class FeedbackStore:
    """``catalogs``, ``products``, ``reviews``, ``analysis`` and ``captured`` below one shared folder.

    Rows are appended. What changes (flags of ``catalogs``, products and reviews that grow, ``analysis``)
    is written as a new version folder; readers take the newest version that was written to its end,
    of ``analysis`` the newest whose number a version of ``catalogs`` has.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create(self) -> None:
        """Create the tables that do not exist yet."""
        for name, schema in TABLES.items():
            if self._versions(name) == []:
                empty = self.spark.createDataFrame([], schema)
                empty.write.mode("ignore").option("compression", CODEC).parquet(self._path(name, 0))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(self._path(name, self._current(name)))

    def next_version(self, name: str) -> int:
        return self._current(name) + 1

    def replace(self, name: str, rows: DataFrame, version: int | None = None) -> None:
        """Make ``rows``, cast to the table's types, the table's content, as a new version."""
        version = self.next_version(name) if version is None else version
        conform(rows, TABLES[name]).write.mode("overwrite").option("compression", CODEC).parquet(self._path(name, version))

    def replace_numbered(self, name: str, rows: DataFrame, id_column: str, order: list[str], version: int) -> None:
        """Stored rows and new ones, with new ids after the stored ones, as the given version."""
        stored = self.read(name)
        new = conform(with_new_ids(rows, order, id_column, stored), TABLES[name])
        self.replace(name, stored.unionByName(new), version)

    def exchange_numbered(
        self, name: str, keys: DataFrame, key: str, rows: DataFrame, id_column: str, order: list[str],
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """New version in which ``rows``, with new ids, stand for the stored rows of ``keys``; ``finish`` as in :meth:`append_numbered`."""
        stored = self.read(name)
        numbered = with_new_ids(rows, order, id_column, stored)
        new = conform(numbered if finish is None else finish(numbered), TABLES[name])
        self.replace(name, stored.join(keys, key, "left_anti").select(*new.columns).unionByName(new))

    def _current(self, name: str) -> int:
        versions = self._versions(name)
        if name == "analysis":
            versions = [v for v in versions if v in self._versions("catalogs")]
        return versions[-1]

    def append(self, name: str, rows: DataFrame) -> None:
        """Append rows, cast to the table's types. A value that cannot be cast fails the job."""
        conform(rows, TABLES[name]).write.mode("append").option("compression", CODEC).parquet(self._path(name, self._current(name)))

    def write_batch(self, name: str, rows: DataFrame, batch: str) -> None:
        """Add a folder ``batch=<batch>`` of rows, cast to the table's types; the same batch again takes its place."""
        conform(rows, TABLES[name]).write.mode("overwrite").option("compression", CODEC).parquet(f"{self._path(name, self._current(name))}/batch={batch}")

    def read_batches(self, name: str, *more: Column) -> DataFrame:
        """Rows of all batches that were written to their end, with further columns such as file metadata."""
        folders = [f"{self._path(name, self._current(name))}/batch={b}" for b in self.batches(name)]
        if not folders:
            return self.read(name).select("*", *more)
        return self.spark.read.schema(TABLES[name]).parquet(*folders).select(*TABLES[name].names, *more)

    def batches(self, name: str) -> list[str]:
        """Names of a table's finished batches."""
        return self._finished(self._path(name, self._current(name)))

    def append_numbered(
        self, name: str, rows: DataFrame, id_column: str, order: list[str], finish: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Append rows with new ids, in the given order, after the stored ones.

        ``finish`` adds what is derived from each row after the numbering, which reads its rows twice and sorts them as they are.
        """
        numbered = with_new_ids(rows, order, id_column, self.read(name))
        self.append(name, numbered if finish is None else finish(numbered))

    def flag_catalogs(self, ids: DataFrame, flag: str, value: bool = True) -> None:
        version = self.next_version("catalogs")
        if flag != "analyzed" or not value:  # a number that an unfinished analysis has taken stays without catalogues
            taken = self._versions("analysis")
            while version in taken:
                version += 1
        self.replace("catalogs", set_flag(self.read("catalogs"), ids, flag, value), version)

    def register_catalogs(self, links: DataFrame, order: str = "link_order") -> None:
        """Add the links that are not stored yet, not collected and not analysed."""
        known = self.read("catalogs").select("catalog_link").distinct()
        new = (
            links.groupBy("catalog_link").agg(F.min(order).alias(order))
            .join(known, "catalog_link", "left_anti")
            .withColumns({"collected": F.lit(False), "analyzed": F.lit(False)})
        )
        self.append_numbered("catalogs", new, "catalog_id", [order, "catalog_link"])

    def reopen(self, ids: DataFrame) -> None:
        """Catalogues that grow are not analysed any more. Nothing is written if none of them was."""
        done = self.read("catalogs").filter("analyzed").join(ids, "catalog_id", "left_semi")
        if not done.isEmpty():
            self.flag_catalogs(ids, "analyzed", False)

    def finished_runs(self) -> list[int]:
        """Numbers of the analyses that ended: those that ``analysis`` and ``catalogs`` both have."""
        return sorted({*self._versions("analysis")} & {*self._versions("catalogs")} - {0})

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def _versions(self, name: str) -> list[int]:
        """Versions whose job has finished, oldest first."""
        return sorted(map(int, self._finished(f"{self.root}/{name}")))

    def _finished(self, path: str) -> list[str]:
        """Values of the folders ``key=value`` below a path whose job has finished."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        found = [str(status.getPath().toString()) for status in fs.listStatus(folder) if status.isDirectory()]
        done = [p for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS"))]
        return sorted(p.rsplit("=", 1)[1] for p in done)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_jdbc(
    spark: SparkSession, url: str, table: str, id_column: str, partitions: int, **options: str
) -> DataFrame:
    """Read a table of an existing database in ``partitions`` id ranges (its driver jar must be present)."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    bounds = reader.option("query", f"SELECT min({id_column}) AS lo, max({id_column}) AS hi FROM {table}").load().first()
    if bounds["lo"] is None:
        return reader.option("dbtable", table).load()
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", id_column)
        .option("lowerBound", bounds["lo"])
        .option("upperBound", bounds["hi"])
        .option("numPartitions", partitions)
        .load()
    )
