"""The set of databases whose changes are not published."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DENYLIST
from ..sources.versions import Versions


def applied(denylist: DataFrame, edits: DataFrame) -> DataFrame:
    """entries after edits (seq, verb add or remove, entry), each entry's last edit deciding."""
    last = edits.groupBy("entry").agg(F.max_by("verb", "seq").alias("verb"))
    both = denylist.select("entry").distinct().join(last, "entry", "full_outer")
    return both.where(F.coalesce(F.col("verb"), F.lit("add")) == "add").select("entry")


def states(edits: DataFrame) -> DataFrame:
    """(entry, enabled 1 or 0) of edited entries only."""
    return edits.groupBy("entry").agg(F.max_by((F.col("verb") == "add").cast("int"), "seq").alias("enabled"))


class FolderTable:
    """Entries in a folder of versions, which a running service reads anew for each micro-batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, path)

    def load(self) -> set[str]:
        return set(json.loads(self.versions.get() or "[]"))

    def add(self, entry: str) -> None:
        self.versions.put(json.dumps(sorted(self.load() | {entry})))

    def remove(self, entry: str) -> None:
        self.versions.put(json.dumps(sorted(self.load() - {entry})))


class JdbcTable:
    """Entries in a database's table (entry varchar(255), unique), made if it is missing; by the drivers on Spark's class path."""

    def __init__(self, spark: SparkSession, url: str, table: str = "denylist"):
        self.drivers, self.url, self.table = spark.sparkContext._jvm.java.sql.DriverManager, url, table
        try:
            self.load()
        except Exception:  # noqa: BLE001  a connection that fails, fails again here
            self._run(f"CREATE TABLE {table} (entry VARCHAR(255) NOT NULL UNIQUE)")

    def _run(self, sql: str, *values: str, read: bool = False) -> list[str]:
        connection = self.drivers.getConnection(self.url)
        try:
            statement = connection.prepareStatement(sql)
            for i, v in enumerate(values, 1):
                statement.setString(i, v)
            if not read:
                statement.executeUpdate()
                return []
            rows, out = statement.executeQuery(), []
            while rows.next():
                out.append(rows.getString(1))
            return out
        finally:
            connection.close()

    def load(self) -> set[str]:
        return set(self._run(f"SELECT entry FROM {self.table}", read=True))

    def add(self, entry: str) -> None:
        if not self._run(f"SELECT entry FROM {self.table} WHERE entry = ?", entry, read=True):
            self._run(f"INSERT INTO {self.table} (entry) VALUES (?)", entry)

    def remove(self, entry: str) -> None:
        self._run(f"DELETE FROM {self.table} WHERE entry = ?", entry)


class Denylist:
    """A denylist with a table behind it: a folder, a database (jdbc:...), or none.

    Memory changes first, then the table; a failed write is raised and memory stays changed.  An
    id that is empty or has a slash is no entry.  gauges holds 1 or 0 for each entry that was put
    or deleted here.
    """

    def __init__(self, spark: SparkSession, url: str | None = None):
        self.spark = spark
        self.table = None if not url else JdbcTable(spark, url) if url.startswith("jdbc:") else FolderTable(spark, url)
        self.entries: set[str] = self.table.load() if self.table else set()
        self.gauges: dict[str, int] = {}

    def refresh(self) -> None:
        """Entries as the table has them now, other services' edits included; what cannot be read stays as it was."""
        if self.table is not None:
            try:
                self.entries = self.table.load()
            except Exception:  # noqa: BLE001  a list that cannot be read does not stop the stream
                return

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame([(x,) for x in sorted(self.entries)], DENYLIST)

    def list(self) -> list[str]:
        return sorted(self.entries)

    def handle(self, verb: str, path: str) -> tuple[int, object]:
        """(status, body) of a request: GET /denylist, and GET, PUT or DELETE /denylist/<id>."""
        parts = path.removeprefix("/").split("/")
        if verb == "GET" and parts in (["denylist"], ["denylist", ""]):
            return 200, self.list()
        if len(parts) != 2 or parts[0] != "denylist" or not parts[1] or verb not in ("GET", "PUT", "DELETE"):
            return 404, None
        entry = parts[1]
        if verb == "GET":
            return (200, entry) if entry in self.entries else (404, None)
        try:
            if verb == "PUT":
                return (204, None) if not self.add(entry) else (201, None)
            self.remove(entry)
            return 204, None
        except Exception as e:  # noqa: BLE001
            return 500, str(e)

    def add(self, entry: str) -> bool:
        """Whether it is new."""
        if entry in self.entries:
            return False
        self.entries.add(entry)
        self.gauges[entry] = 1
        if self.table is not None:
            self.table.add(entry)
        return True

    def remove(self, entry: str) -> None:
        if entry in self.entries:
            self.entries.discard(entry)
            self.gauges[entry] = 0
            if self.table is not None:
                self.table.remove(entry)
