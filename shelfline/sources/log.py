"""What was read off page snapshots, appended batch by batch and folded now and then.

Every row belongs to a snapshot, known by ``url`` and the columns of ``VERSION``; of several snapshots of an address the
newest counts, whichever batch brought it. A reader looks at the last fold, which holds the newest snapshots only, and at
the batches after it, so its cost follows the live pages and a short tail, not the history.

A batch is written below the next free number and becomes valid by one appended row that names it, when its rows and versions
are complete. The row also holds the writer's own name for the batch, so a replay of a valid batch does nothing, and what a
crash left of another is written over. A fold becomes valid in the same way; a reader that began before goes on with the older one.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .snapshots import VERSION

VERSION_DDL = "fetched_at timestamp, status int, body_hash bigint"
#: Batches after which a writer folds.
FOLD_EVERY = 20
_FOLDS, _BATCHES = "gen bigint, upto bigint", "seq bigint, name string"


def newest_versions(versions: DataFrame) -> DataFrame:
    """One row per address ``url, VERSION``: the latest fetch (unknown times last), then the smallest status and body hash."""
    order = [F.col("fetched_at").desc_nulls_last(), F.col("status").asc_nulls_last(), F.col("body_hash")]
    ranked = versions.select("url", *VERSION).withColumn("_rank", F.row_number().over(Window.partitionBy("url").orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def of_versions(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows that belong to the snapshots ``url, VERSION``."""
    left, right = rows.alias("r"), versions.alias("v")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"v.{c}")) for c in VERSION]
    return left.join(right, [F.col("r.url") == F.col("v.url"), *same], "left_semi")


class PageLog:
    """Tables of rows read off pages, below one folder. ``tables`` gives the columns of each beside ``url`` and ``VERSION``."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]):
        self.spark, self.root = spark, root
        self.ddl = {name: f"url string, {VERSION_DDL}" + (f", {ddl}" if ddl else "") for name, ddl in {**tables, "versions": ""}.items()}

    def _table(self, path: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(os.path.join(self.root, path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def folded(self) -> tuple[int, int]:
        """Number of the last fold and the last batch in it; -1 without any."""
        last = self._table("folds", _FOLDS).orderBy(F.desc("gen")).limit(1).collect()
        return (last[0]["gen"], last[0]["upto"]) if last else (-1, -1)

    def append(self, name: str, rows: dict[str, DataFrame], versions: DataFrame) -> bool:
        """Write a batch, known to its writer as ``name``: its rows by table and the versions of its pages.

        False if the batch is valid already.
        """
        done = self._table("batches", _BATCHES).agg(F.max("seq").alias("last"), F.count_if(F.col("name") == name).alias("same")).first()
        if done["same"]:
            return False
        seq = 0 if done["last"] is None else done["last"] + 1
        for table, frame in {**rows, "versions": versions}.items():
            columns = [f.split()[0] for f in _columns(self.ddl[table])]
            frame.select(*columns).write.mode("overwrite").parquet(os.path.join(self.root, "tail", table, f"seq={seq}"))
        self._add("batches", (seq, name), _BATCHES)
        return True

    def _add(self, path: str, row: tuple, ddl: str) -> None:
        self.spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(os.path.join(self.root, path))

    def holds_any(self) -> bool:
        return bool(self._table("batches", _BATCHES).limit(1).collect())

    def batches(self) -> list[int]:
        """Numbers of the valid batches after the last fold, FOLD_EVERY or so of them."""
        return self._after(self.folded()[1])

    def _after(self, upto: int) -> list[int]:
        return sorted(r["seq"] for r in self._table("batches", _BATCHES).filter(F.col("seq") > upto).collect())

    def rows(self, name: str) -> DataFrame:
        """All rows of a table at hand: those of the last fold and of the batches after it."""
        gen, upto = self.folded()
        found = self._table(os.path.join("base", str(gen), name), self.ddl[name]) if gen >= 0 else self.spark.createDataFrame([], self.ddl[name])
        tail = self._after(upto)
        if not tail:
            return found
        parts = self._table(os.path.join("tail", name), f"{self.ddl[name]}, seq bigint").filter(F.col("seq").isin(tail)).drop("seq")
        return found.unionByName(parts) if gen >= 0 else parts

    def versions(self) -> DataFrame:
        """The newest snapshot of every address, failed ones too."""
        return newest_versions(self.rows("versions"))

    def live(self, name: str) -> DataFrame:
        """Rows of the newest snapshots, of the addresses whose newest snapshot did not fail."""
        return of_versions(self.rows(name), self.versions().filter("status = 200"))

    def fold(self) -> int:
        """Write the newest versions and their rows as a new base and make it valid; returns its number."""
        gen, tail = self.folded()[0], self.batches()
        if not tail:
            return gen
        for name in self.ddl:
            rows = self.versions() if name == "versions" else self.live(name)
            rows.write.mode("overwrite").parquet(os.path.join(self.root, "base", str(gen + 1), name))
        self._add("folds", (gen + 1, max(tail)), _FOLDS)
        return gen + 1


def _columns(ddl: str) -> list[str]:
    """The top-level fields of a DDL text."""
    depth, start, out = 0, 0, []
    for at, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[start:at].strip())
            start = at + 1
    return out
