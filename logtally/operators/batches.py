"""A parquet table of micro-batches, one partition each, written by dynamic partition overwrite.

The partition columns are ``run_id, first_batch, batch_id``. A micro-batch is the partition ``(run, n, n)``: writing it again
replaces it and nothing else, and what is there is whole, for Spark moves a partition into place when all of it is written.
Every partition has one row more that is no content (``is_row``), so that one without content is there, too.

Old partitions are merged by an ordinary rewrite into ``(run, first, last)``, under a name that did not exist before. From
then on the partitions it spans are left out by readers; they are removed by a later merge, once readers that listed them
before should be done. A merge that dies leaves either nothing or a whole partition.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from logtally.storage import Files, literal

# A merge also takes in the partition before, if that is at most this many times the size of what is being merged. Every
# row is then rewritten only about log(total) times, while few partitions remain to be added up by a reader.
MERGE_FACTOR = 2

_RUN_ID = re.compile(r"[A-Za-z0-9_.-]+")
_PLACE = re.compile(r"/run_id=([^/]+)/first_batch=(\d+)/batch_id=(\d+)/")
_IS_ROW = "is_row"
_PARTITION = (StructField("run_id", StringType()), StructField("first_batch", LongType()), StructField("batch_id", LongType()))


class Part(NamedTuple):
    run_id: str
    first: int
    last: int

    def spans(self, other: Part) -> bool:
        return self != other and self.run_id == other.run_id and self.first <= other.first and other.last <= self.last

    @property
    def folder(self) -> str:
        return f"run_id={self.run_id}/first_batch={self.first}/batch_id={self.last}"


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, content: StructType) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.content = content
        if taken := {_IS_ROW, *(f.name for f in _PARTITION)} & {name.lower() for name in content.fieldNames()}:
            raise ValueError(f"{sorted(taken)} are names that the table has for itself")
        self.schema = StructType([*content.fields, *_PARTITION])
        self._stored = StructType([*content.fields, StructField(_IS_ROW, BooleanType()), *_PARTITION])
        self.files = Files(spark, self.path)

    def write(self, rows: DataFrame, part: Part, order: Sequence[str] = ()) -> None:
        """Put rows in place as this partition, in ranges of ``order``, so that a filter on it skips files and row groups."""
        if not _RUN_ID.fullmatch(part.run_id):
            raise ValueError(f"run ids are letters, digits, '_', '.' and '-', got {part.run_id!r}")
        if not 0 <= part.first <= part.last:
            raise ValueError(f"batch ids start at 0, got {part.first} to {part.last}")
        names = self.content.fieldNames()
        nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in self.content]
        content = rows.select(*[F.col(_quoted(n)) for n in names], F.lit(True).alias(_IS_ROW))
        placed = content.union(self.spark.range(1).select(*nothing, F.lit(False)))
        for field, value in zip(_PARTITION, part, strict=True):
            placed = placed.withColumn(field.name, F.lit(value).cast(field.dataType))
        if order:
            # The writer wants the partition columns first and would sort once more.
            placed = placed.repartitionByRange(*order).sortWithinPartitions(*[field.name for field in _PARTITION], *order)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*[field.name for field in _PARTITION]).parquet(self.path)

    def parts(self) -> list[Part]:
        """Every partition there is, by run and batch."""
        if not self.files.exists(self.path):
            return []
        listed = self.spark.read.schema(self._stored).parquet(literal(self.path)).inputFiles()
        places = {match.groups() for name in listed if (match := _PLACE.search(unquote(name)))}
        return sorted((Part(run_id, int(first), int(last)) for run_id, first, last in places), key=lambda p: (p.run_id, p.last, p.first))

    def live(self) -> list[Part]:
        """The partitions that no other one spans."""
        parts = self.parts()
        kept = [p for p in parts if not any(other.spans(p) for other in _near(parts, p))]
        for before, after in zip(kept, kept[1:], strict=False):
            if before.run_id == after.run_id and after.first <= before.last:
                raise RuntimeError(f"{self.path}: {before} and {after} overlap; only one process may merge")
        return kept

    def read(self, parts: Iterable[Part]) -> DataFrame:
        """The content of these partitions, with the partition columns."""
        paths = [literal(f"{self.path}/{part.folder}") for part in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self._stored).option("basePath", self.path)
        return reader.parquet(*paths).where(_IS_ROW).select(*[_quoted(n) for n in self.schema.fieldNames()])

    def merge(
        self, join: Callable[[DataFrame], DataFrame], order: Sequence[str] = (), *, full: bool = False, keep_seconds: float = 0
    ) -> list[Part]:
        """Rewrite the younger ones of each run's consecutive partitions as one; ``full`` takes them all. Returns the new ones.

        ``join`` makes one table of the rows of several partitions. Partitions that an earlier merge spans are removed first,
        if that merge was ``keep_seconds`` ago.
        """
        parts = self.parts()
        for old in parts:
            over = [p for p in parts if p.spans(old)]
            if over and max(self.files.age_seconds(f"{self.path}/{p.folder}") for p in over) >= keep_seconds:
                self.files.delete(f"{self.path}/{old.folder}")
        made = []
        for row in _consecutive(self.live()):
            taken = self._younger(row, full)
            if len(taken) > 1:
                made.append(Part(taken[0].run_id, taken[0].first, taken[-1].last))
                self.write(join(self.read(taken)), made[-1], order)
        return made

    def _younger(self, parts: list[Part], full: bool) -> list[Part]:
        """The last partitions, as far back as each is a single batch or not much larger than what comes behind it."""
        size, k = 0, len(parts)
        while k and (full or parts[k - 1].first == parts[k - 1].last or self._size(parts[k - 1]) <= MERGE_FACTOR * size):
            k -= 1
            size += self._size(parts[k])
        return parts[k:]

    def _size(self, part: Part) -> int:
        return self.files.size(f"{self.path}/{part.folder}")


def _consecutive(parts: list[Part]) -> list[list[Part]]:
    """Partitions in rows without a gap. A batch that is missing may still come, so nothing is merged across it."""
    rows: list[list[Part]] = []
    for part in parts:
        if rows and rows[-1][-1].run_id == part.run_id and rows[-1][-1].last + 1 == part.first:
            rows[-1].append(part)
        else:
            rows.append([part])
    return rows


def _near(parts: list[Part], part: Part) -> list[Part]:
    """Merged partitions of the same run; single batches span nothing."""
    return [p for p in parts if p.first < p.last and p.run_id == part.run_id]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
