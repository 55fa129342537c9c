"""Published tables: stored by key, pruned by range bucket, replaced at once (SNK1-SNK5).

A table is two catalog entries of one database. ``name__<snapshot>`` is an external
table over one snapshot's folder: bucketed by its key and sorted by its cluster columns,
or clustered by range, and partitioned by the integer-range bucket of its year. ``name`` is
a view of it with the texts of the table and its columns. Names, schemas and texts are
kept in the session's catalog, so a database is addressed by name from SQL.

* **Full refresh**: a new snapshot is written beside the old one, and replacing the view
  is the commit. A job that fails halfway leaves the view, and with it the old rows, alone.
* **Refresh of some partitions**: the new folder of a partition is written beside the old
  one and ``SET LOCATION`` commits it, a partition at a time. Files of other partitions are
  not touched, and a partition without rows is dropped.
* **Increments and upkeep**: rows can be added to a table; :meth:`Warehouse.compact` rewrites
  the partitions that have gathered many files, sorted again, and leaves the others alone.
* **Reading by year**: :func:`year_predicate` adds the matching predicate on the bucket
  to any comparison with the year, so only its partitions are listed and read.
* **Counted tests**: what a write can count, not-NULL and accepted values, it counts
  while writing, per partition, and keeps in the view's properties.
* **Joins by key**: tables of one warehouse with one key share the number of buckets, so
  joins and groupings by key need no exchange. Rows without a key never match; they are
  written as they come, in files of their own, not by one task.

A superseded snapshot is kept until the next commit, for readers that have begun.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlab.functions.bands import lit
from cohortlab.functions.sql import project, q
from cohortlab.sinks.tables import clustered, range_bucket

BUCKET = "cycle_bucket"
# The integer range of the reference's partitions and the buckets it gives (0 and LAST: overflow).
START, END, STEP = 2003, 2019, 2
LAST = (END - START) // STEP + 1
# Stored bytes and rows that one bucket of a keyed table should hold at most. A task sorts a
# bucket's decoded rows, which say more about its memory than their compressed bytes.
BUCKET_BYTES = 64 << 20
BUCKET_ROWS = 500_000
ROWS = "rows"


@dataclass(frozen=True)
class Layout:
    """How a table is stored, described and tested."""

    key: str | None = None
    cluster: Sequence[str] = ()
    year: str | None = None
    comment: str = ""
    columns: Mapping[str, str] = field(default_factory=dict)
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    row_group_bytes: int | None = None

    def counted(self) -> dict[str, str]:
        """Name of each test that a write counts -> its predicate for a failing row."""
        out = {f"not_null|{c}": f"{q(c)} IS NULL" for c in self.not_null}
        for c, values in self.accepted.items():
            out[f"accepted_values|{c}"] = f"{q(c)} IS NOT NULL AND {q(c)} NOT IN ({', '.join(lit(v) for v in values)})"
        return out


# ------------------------------------------------------------ reading by year
def bucket_of(year: int) -> int:
    return min(max((year - START) // STEP + 1, 0), LAST)


def year_predicate(year: str, op: str, value=None, bucket: str = BUCKET) -> str:
    """``year op value`` as SQL text with the predicate on the bucket that it implies.

    ``op``: =, <=>, <>, <, <=, >, >=, in, between, is null or is not null. The bucket
    grows with the year and only a NULL year has a NULL bucket, so each comparison
    carries over; the overflow buckets at both ends hold several years.
    """
    y, b, op = q(year), q(bucket), op.lower()
    if op == "is null" or (op == "<=>" and value is None):
        return f"({b} IS NULL AND {y} IS NULL)"
    if op == "is not null":
        return f"({b} IS NOT NULL AND {y} IS NOT NULL)"
    if op == "in":
        known = sorted({int(v) for v in value if v is not None})
        if not known:
            return "false"
        buckets = sorted({bucket_of(v) for v in known})
        return f"({b} IN ({', '.join(map(str, buckets))}) AND {y} IN ({', '.join(map(str, known))}))"
    if op == "between":
        low, high = map(int, value)
        return f"({b} BETWEEN {bucket_of(low)} AND {bucket_of(high)} AND {y} BETWEEN {low} AND {high})"
    if value is None:
        return "cast(null as boolean)"
    value = int(value)
    if op == "<>":
        return f"({b} IS NOT NULL AND {y} <> {value})"
    # the neighbouring year decides whether the whole bucket of an open bound can go
    edge = {"<": bucket_of(value - 1), ">": bucket_of(value + 1)}.get(op, bucket_of(value))
    sign = {"=": "=", "<=>": "=", "<": "<=", "<=": "<=", ">": ">=", ">=": ">="}[op]
    return f"({b} {sign} {edge} AND {y} {op} {value})"


# ------------------------------------------------------------ joins by key
def star_join(fact: DataFrame, dims: Sequence[DataFrame], key: str, columns: Iterable[str], fact_alias: str = "d",
              dim_aliases: Sequence[str] = (), where: str = "", keyless: bool = True) -> DataFrame:
    """Left joins of ``fact`` to ``dims`` by one key, for tables stored by that key.

    The sides meet bucket by bucket as hash joins: no exchange, no sort, and a build side
    is one bucket of a dimension, whose size the warehouse bounds. Rows of ``fact``
    without a key match nothing: they bypass the joins, with NULL for every column of a
    dimension, wherever they are stored (``keyless`` says that there are some).
    """
    columns = list(columns)
    names = list(dim_aliases) or [f"d{i}" for i in range(len(dims))]
    joins = "".join(f"\nLEFT JOIN {{{n}}} {n} ON {fact_alias}.{q(key)} = {n}.{q(key)}" for n in names)
    hint = f"/*+ SHUFFLE_HASH({', '.join(names)}) */ " if names else ""
    body = ",\n  ".join(columns).replace("{", "{{").replace("}", "}}")
    text = f"SELECT {hint}\n  {body}\nFROM {{{fact_alias}}} {fact_alias}{joins}\nWHERE {where or 'true'}"
    spark, sides = fact.sparkSession, dict(zip(names, dims))
    if not keyless:
        return spark.sql(text, **{fact_alias: fact}, **sides)
    matched = spark.sql(f"{text}\n  AND {fact_alias}.{q(key)} IS NOT NULL", **{fact_alias: fact}, **sides)
    nothing = {n: d.where("1 = 0") for n, d in sides.items()}  # planned away: the rows pass by
    bypass = spark.sql(f"{text}\n  AND {fact_alias}.{q(key)} IS NULL", **{fact_alias: fact}, **nothing)
    return matched.unionByName(bypass)


# ------------------------------------------------------------ the warehouse
class Warehouse:
    """The published tables of one database under one folder."""

    def __init__(self, spark: SparkSession, database: str, root: str, buckets: int) -> None:
        self.spark, self.database, self.root, self.buckets = spark, database, root.rstrip("/"), buckets
        self.layouts: dict[str, Layout] = {}
        self.current: dict[str, str] = {}  # name -> snapshot table
        self.former: dict[str, str] = {}
        self.folders: dict[str, list[str]] = {}  # snapshot table -> folders written for it
        self.shared: set[str] = set()  # tables whose files a clone reads as well
        self.lock = threading.RLock()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(database)} LOCATION '{self.root}/_database'")

    # -- names
    def sql_name(self, name: str) -> str:
        return f"{q(self.database)}.{q(name)}"

    def snapshot(self, name: str) -> str:
        return self.sql_name(self.current[name])

    def table(self, name: str) -> DataFrame:
        """The table as published: the view, without the bucket column."""
        return self.spark.table(self.sql_name(name))

    def stored(self, name: str) -> DataFrame:
        """The snapshot behind the view, with the bucket column."""
        return self.spark.table(self.snapshot(name))

    def read(self, name: str, *conditions: tuple) -> DataFrame:
        """Rows whose year meets all ``conditions`` ((op, value) pairs), from their partitions only."""
        df, year = self.stored(name), self.layouts[name].year
        if conditions:
            df = df.where(" AND ".join(year_predicate(year, *c) for c in conditions))
        return df.drop(BUCKET)

    def cycle(self, name: str, buckets: Sequence[int | None]) -> DataFrame:
        """The stored rows of some partitions."""
        return self.stored(name).where(_among(buckets))

    # -- writing
    def publish(self, name: str, df: DataFrame, layout: Layout, aligned: bool = False) -> DataFrame:
        """Full refresh: write a new snapshot, then show it; returns the published table.

        ``aligned``: ``df`` comes out of joins or groupings by the key over tables of this
        warehouse, so its tasks hold whole buckets already.
        """
        columns = df.columns
        table, path = self._fresh(name)
        counts = self._write(df, table, path, layout, aligned)
        with self.lock:
            self.folders[table] = [path]
            self.layouts[name] = layout
            self._show(name, table, columns, layout, counts)
            gone, self.former[name] = self.former.get(name), self.current.get(name)
            self.current[name] = table
        if gone:
            self._drop(gone)
        return self.table(name)

    def replace(self, name: str, df: DataFrame, buckets: Sequence[int | None], aligned: bool = False,
                files: int | None = None) -> DataFrame:
        """Replace the partitions ``buckets`` by the rows of ``df``, which lie in them.

        ``files``: at most so many for the rows of a clustered table.
        """
        layout = self.layouts[name]
        table, path = self._fresh(name)
        counts = self._write(df, table, path, layout, aligned, files)
        written = {_value(r[0]) for r in self.spark.sql(f"SHOW PARTITIONS {self.sql_name(table)}").collect()}
        if written - set(buckets):
            raise ValueError(f"{name}: rows outside of the partitions to replace: {sorted(map(str, written - set(buckets)))}")
        mine = self.snapshot(name)
        here = {_value(r[0]) for r in self.spark.sql(f"SHOW PARTITIONS {mine}").collect()}
        for b in buckets:
            spec = f"PARTITION ({BUCKET} = {'null' if b is None else b})"
            if b not in written:
                if b in here:
                    self.spark.sql(f"ALTER TABLE {mine} DROP {spec}")
                continue
            place = f"{path}/{BUCKET}={'__HIVE_DEFAULT_PARTITION__' if b is None else b}"
            self.spark.sql(f"ALTER TABLE {mine} {spec} SET LOCATION '{place}'" if b in here
                           else f"ALTER TABLE {mine} ADD {spec} LOCATION '{place}'")
        self.spark.catalog.refreshTable(mine)
        self.spark.sql(f"DROP TABLE {self.sql_name(table)}")  # an external table: its files stay
        self.folders[self.current[name]].append(path)
        kept = {k: v for k, v in self._counts(name).items() if _owner(k) not in set(buckets)}
        self._set_counts(name, kept | {k: v for k, v in counts.items() if _owner(k) in set(buckets)})
        return self.table(name)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to the partitions they lie in; the files of one increment appear together."""
        if name in self.shared:
            raise ValueError(f"{name}: a clone reads the same files; refresh its partitions instead")
        layout = self.layouts[name]
        out, seen, names = self._observed(self._laid_out(df, layout, False), layout)
        stored = self.stored(name)
        out.select(*[q(c) for c in stored.columns]).write.insertInto(self.snapshot(name))
        self.spark.catalog.refreshTable(self.snapshot(name))
        counts = self._counts(name)
        for key, n in self._seen(seen, names).items():
            counts[key] = counts.get(key, 0) + n
        self._set_counts(name, counts)

    def files(self, name: str) -> dict[int | None, list[str]]:
        """Partition -> its files (None also for a table without partitions)."""
        out: dict[int | None, list[str]] = {}
        for f in self.stored(name).inputFiles():
            folder = f.rsplit("/", 2)[1]
            out.setdefault(_value(folder) if folder.startswith(f"{BUCKET}=") else None, []).append(f)
        return out

    def compact(self, name: str, most: int | None = None) -> list[int | None]:
        """Rewrite, in the table's order, the partitions with more than ``most`` files.

        ``most``: by default one file per bucket, or four for a clustered table. Readers that
        have begun keep the old files until the next full refresh. Returns the partitions.
        """
        layout = self.layouts[name]
        if not layout.year:
            raise ValueError(f"{name} has no partitions; a full refresh rewrites it")
        most = most or (self.buckets if layout.key else 4)
        crowded = [b for b, files in self.files(name).items() if len(files) > most]
        for b in crowded:  # a partition's rows at a time, each in one distributed job
            self.replace(name, self.cycle(name, [b]).drop(BUCKET), [b], files=None if layout.key else most)
        return crowded

    def clone(self, database: str, root: str) -> "Warehouse":
        """The same tables under another name, sharing all files: only entries are copied.

        The clone reads the files until this warehouse has refreshed a table twice.
        """
        other = Warehouse(self.spark, database, root, self.buckets)
        for name, layout in self.layouts.items():
            source = self.snapshot(name)
            table, path = other._fresh(name)
            df = self.stored(name)
            fields = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
            text = f"CREATE TABLE {other.sql_name(table)} ({fields}) USING parquet"
            if layout.year:
                text += f" PARTITIONED BY ({BUCKET})"
            if layout.key:
                text += f" CLUSTERED BY ({q(layout.key)}) SORTED BY ({', '.join(map(q, layout.cluster or [layout.key]))}) INTO {self.buckets} BUCKETS"
            own = path if layout.year else self._location(source)
            self.spark.sql(f"{text} LOCATION '{own}'")
            for r in self.spark.sql(f"SHOW PARTITIONS {source}").collect() if layout.year else ():
                b = _value(r[0])
                spec = f"PARTITION ({BUCKET} = {'null' if b is None else b})"
                self.spark.sql(f"ALTER TABLE {other.sql_name(table)} ADD {spec} LOCATION '{self._location(source, spec)}'")
            self.spark.catalog.refreshTable(other.sql_name(table))
            other.layouts[name], other.current[name], other.folders[table] = layout, table, []
            other.shared.add(name)
            self.shared.add(name)
            other._show(name, table, [c for c in df.columns if c != BUCKET], layout, self._counts(name))
        return other

    def _fresh(self, name: str) -> tuple[str, str]:
        mark = uuid.uuid4().hex[:10]
        return f"{name}__{mark}", f"{self.root}/{name}/{mark}"

    def _laid_out(self, df: DataFrame, layout: Layout, aligned: bool, files: int | None = None) -> DataFrame:
        """``df`` with its bucket column, its rows dealt as the layout stores them."""
        if layout.year:
            df = project(df, [*[q(c) for c in df.columns if c != BUCKET], f"{range_bucket(q(layout.year), START, END, STEP)} AS {BUCKET}"])
        if layout.key and not aligned:
            # rows without a key stay where they are; one hash bucket would hold them all
            # by number: a plain repartition of a table bucketed alike is planned away, and its buckets with it
            bucket = F.expr(f"pmod(hash({q(layout.key)}), {self.buckets})")
            df = (df.where(f"{q(layout.key)} IS NOT NULL").repartitionById(self.buckets, bucket)
                  .unionByName(df.where(f"{q(layout.key)} IS NULL")))
        elif not layout.key and layout.cluster:
            df = clustered(df, [BUCKET] if layout.year else [], layout.cluster, files)
        return df

    def _observed(self, df: DataFrame, layout: Layout) -> tuple[DataFrame, Observation, dict[str, str]]:
        """``df`` that counts its tests while it is written, per partition; metric -> ``test|partition``."""
        seen, names, metrics = Observation(), {}, []
        parts = [*range(LAST + 1), None] if layout.year else [None]
        for i, (test, failing) in enumerate({ROWS: "true", **layout.counted()}.items()):
            for b in parts:
                where = failing if not layout.year else f"({failing}) AND {BUCKET} <=> {'null' if b is None else b}"
                names[f"m{i}_{'n' if b is None else b}"] = f"{test}|{'' if b is None else b}"
                metrics.append(F.expr(f"count_if({where})").alias(f"m{i}_{'n' if b is None else b}"))
        return df.observe(seen, *metrics), seen, names

    def _seen(self, seen: Observation, names: Mapping[str, str]) -> dict[str, int]:
        got = seen.get
        return {key: int(got[n]) for n, key in names.items() if got[n]}

    def _write(self, df: DataFrame, table: str, path: str, layout: Layout, aligned: bool,
               files: int | None = None) -> dict[str, int]:
        df, seen, names = self._observed(self._laid_out(df, layout, aligned, files), layout)
        w = df.write.format("parquet").option("path", path).option("partitionOverwriteMode", "static")
        if layout.row_group_bytes:
            w = w.option("parquet.block.size", layout.row_group_bytes)
        if layout.year:
            w = w.partitionBy(BUCKET)
        if layout.key:
            w = w.bucketBy(self.buckets, layout.key).sortBy(*(layout.cluster or [layout.key]))
        try:
            w.saveAsTable(self.sql_name(table))
        except Exception:
            self._remove(path)  # nothing refers to it
            raise
        return self._seen(seen, names)

    def _show(self, name: str, table: str, columns: Sequence[str], layout: Layout, counts: Mapping[str, int]) -> None:
        """Commit: the view ``name`` reads ``table`` from now on."""
        listed = ", ".join(q(c) + (f" COMMENT {lit(layout.columns[c])}" if c in layout.columns else "") for c in columns)
        text = f" COMMENT {lit(layout.comment)}" if layout.comment else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.sql_name(name)} ({listed}){text} "
                       f"TBLPROPERTIES ('counted' = {lit(json.dumps(dict(counts)))}) "
                       f"AS SELECT {', '.join(map(q, columns))} FROM {self.sql_name(table)}")

    # -- counted tests
    def _counts(self, name: str) -> dict[str, int]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.sql_name(name)}").collect()
        return json.loads({r["key"]: r["value"] for r in rows}.get("counted", "{}"))

    def _set_counts(self, name: str, counts: Mapping[str, int]) -> None:
        self.spark.sql(f"ALTER VIEW {self.sql_name(name)} SET TBLPROPERTIES ('counted' = {lit(json.dumps(dict(counts)))})")

    def counted(self, name: str) -> dict[str, int]:
        """Test (``check|column``, or ``rows``) -> failing rows, over all partitions."""
        out = dict.fromkeys([ROWS, *self.layouts[name].counted()], 0)
        for k, v in self._counts(name).items():
            out[k.rsplit("|", 1)[0]] += v
        return out

    # -- files
    def _location(self, table: str, spec: str = "") -> str:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {table} {spec}").collect()
        return [r["data_type"] for r in rows if r["col_name"] == "Location"][0]

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def _drop(self, table: str) -> None:
        """Forget a superseded snapshot and remove the folders written for it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.sql_name(table)}")
        for path in self.folders.pop(table, ()):
            self._remove(path)

    def drop(self) -> None:
        """Remove the database, its entries and its files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {q(self.database)} CASCADE")
        self._remove(self.root)


def _among(buckets: Sequence[int | None]) -> str:
    known = [str(b) for b in buckets if b is not None]
    parts = [f"{BUCKET} IN ({', '.join(known)})"] if known else []
    if None in buckets:
        parts.append(f"{BUCKET} IS NULL")
    return "(" + " OR ".join(parts or ["false"]) + ")"


def _value(partition: str) -> int | None:
    text = partition.split("=", 1)[1]
    return None if text in ("__HIVE_DEFAULT_PARTITION__", "null") else int(text)


def _owner(count_key: str) -> int | None:
    text = count_key.rsplit("|", 1)[1]
    return int(text) if text else None


def bucket_number(stored_bytes: int, least: int = 4, rows: int = 0) -> int:
    """Buckets for keyed tables of which the largest has so many stored bytes and rows."""
    return max(least, -(-stored_bytes // BUCKET_BYTES), -(-rows // BUCKET_ROWS))
