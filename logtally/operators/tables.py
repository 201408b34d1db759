"""The summary as a catalog table that SQL users can select from.

The table is external. New content is staged in a folder of its own, and once it is whole the catalog is told to look there,
a change of metadata only: at no moment is the table empty or half written, and what died half-way is never read. The folder
before stays until the next change, for queries that are still reading it. One process at a time may change the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.counts import as_text
from logtally.operators.ledger import CountLedger
from logtally.operators.summary import _quoted, recount
from logtally.spec import SummarySpec
from logtally.storage import Files


class SummaryTable:
    def __init__(self, spark: SparkSession, spec: SummarySpec, root: str, name: str | None = None) -> None:
        self.spark = spark
        self.spec = spec
        self.root = root.rstrip("/")
        self.name = name or spec.table
        self.files = Files(spark, self.root)

    @property
    def _sql_name(self) -> str:
        return ".".join(_quoted(part) for part in self.name.split("."))

    def create(self) -> None:
        """Create the table, empty, if it does not exist."""
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"{_quoted(name)} STRING" for name in self.spec.output_columns)
            folder = self._staged(self.spark.createDataFrame([], self.spec.summary_schema()))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._sql_name} ({columns}) USING parquet LOCATION {_text(folder)}")

    def read(self) -> DataFrame:
        """``SELECT *``."""
        return self.spark.table(self.name)

    def show(self, rows: int = 20) -> None:
        self.read().show(rows, truncate=False)

    def insert(self, counts: DataFrame) -> None:
        """Append rows; columns go by name and become text."""
        self._as_rows(counts).write.insertInto(self.name)

    def insert_from(self, view: str) -> None:
        """Append the summary columns of a registered view."""
        self.insert(self.spark.table(view))

    def recounted(self) -> DataFrame:
        """The table with the rows of each group added up."""
        return recount(self.read(), self.spec)

    def fold(self, counts: DataFrame) -> None:
        """Add one batch's counts to the totals. For a stream use the ledger: this rewrites the table each time."""
        self.replace(recount(self.read().unionByName(self._as_rows(counts)), self.spec))

    def publish(self, ledger: CountLedger) -> None:
        """Replace the content with the ledger's totals."""
        self.replace(ledger.summary())

    def replace(self, counts: DataFrame) -> None:
        """Stage new content, then swap it in."""
        before = self._location()
        after = self._staged(self._as_rows(counts))
        self.spark.sql(f"ALTER TABLE {self._sql_name} SET LOCATION {_text(after)}")
        self.spark.catalog.refreshTable(self._sql_name)
        for name in self.files.children(self.root):
            if name not in (before.rsplit("/", 1)[1], after.rsplit("/", 1)[1]):
                self.files.delete(f"{self.root}/{name}")

    def truncate(self) -> None:
        self.replace(self.spark.createDataFrame([], self.spec.summary_schema()))

    def drop(self) -> None:
        """Remove the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._sql_name}")
        self.files.delete(self.root)

    def _as_rows(self, counts: DataFrame) -> DataFrame:
        return counts.select(*[as_text(F.col(_quoted(name))).alias(name) for name in self.spec.output_columns])

    def _staged(self, rows: DataFrame) -> str:
        folder = f"{self.root}/content-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def _location(self) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._sql_name}")
        return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _text(path: str) -> str:
    """As a SQL text literal."""
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def append_all(spark: SparkSession, view: str, table: str) -> None:
    """Append every column of a view to a table of the same shape."""
    spark.table(view).write.insertInto(table)
