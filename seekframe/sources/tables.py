"""Document tables in the session's catalog.

A table is an ordinary partitioned Spark table: ``CREATE TABLE IF NOT EXISTS``,
``DROP TABLE IF EXISTS`` and ``ALTER TABLE ... ADD COLUMNS`` manage it, a create
appends, and rows lie in buckets, partitions by a hash of ``_id``.  Their number
is a property of the table, set from the expected size when it is created, so
that a bucket stays near ``BUCKET_BYTES``.  Updates and deletes read the touched
buckets only, stage their new rows in the shared folder, and put them in by
dynamic partition overwrite; files of other buckets stay as they are, and a
bucket that is left without documents is dropped.  Writes are rebalanced by
bucket: Spark splits large buckets over tasks and joins small ones, so neither a
hot bucket nor the number of buckets bounds a task.

Calls take effect before they return, so a later read sees them.  One writer
per table: plain files give no isolation between concurrent writers, which
takes a table format.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import mutate
from ..operators.search import matching
from ..session import staged
from .index import Index
from .mapping import Mapping

BUCKET = "_bucket"
#: What a bucket should hold: what one changed document costs to rewrite at most.
BUCKET_BYTES = 1 << 30
MOST_BUCKETS = 1 << 16
_PROPERTY = "seekframe.buckets"


class DocumentTable:
    """A document table (index) of the catalog."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, location: str | None = None):
        """``buckets`` counts where the table does not exist yet and no size is expected."""
        self.spark = spark
        self.name = name
        self.location = location
        self._buckets = buckets

    @property
    def buckets(self) -> int:
        if self.exists():
            known = dict(self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect())
            return int(known.get(_PROPERTY, self._buckets))
        return self._buckets

    # ---- lifecycle ------------------------------------------------------
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, schema: T.StructType | Mapping, expected_bytes: int | None = None) -> bool:
        """Create the table if absent; returns False when it already existed."""
        if self.exists():
            return False
        if expected_bytes is not None:
            self._buckets = min(max(-(-expected_bytes // BUCKET_BYTES), 1), MOST_BUCKETS)
        st = schema.to_struct_type() if isinstance(schema, Mapping) else schema
        fields = [T.StructField("_id", T.StringType())] + [f for f in st.fields if f.name != "_id"]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        at = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {BUCKET} INT) USING parquet "
                       f"PARTITIONED BY ({BUCKET}){at} TBLPROPERTIES ('{_PROPERTY}' = '{self._buckets}')")
        return True

    def drop(self) -> bool:
        """Remove the table if present; returns False when there was none."""
        was = self.exists()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return was

    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.spark.table(self.name).schema.fields if f.name != BUCKET])

    def put_mapping(self, fields: T.StructType | Mapping) -> T.StructType:
        """Add fields; existing ones are kept (additive evolution). Old rows read null."""
        add = fields.to_struct_type() if isinstance(fields, Mapping) else fields
        names = set(self.schema().fieldNames())
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in add.fields if f.name not in names]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(new)})")
        return self.schema()

    # ---- read -----------------------------------------------------------
    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(BUCKET)

    def index(self, mapping: Mapping | None = None, text=()) -> Index:
        return Index(self.read(), mapping, name=self.name, text=text)

    def get(self, _id: str) -> dict | None:
        rows = self.read().filter((F.col("_id") == str(_id))).limit(1).collect()
        return rows[0].asDict(recursive=True) if rows else None

    # ---- write ----------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("_id"), F.lit(self.buckets)).cast("int")

    def _stage(self, df: DataFrame) -> DataFrame:
        return staged(df, "table")

    def _touched(self, ids: DataFrame) -> list[int]:
        """Buckets that hold any of the ids; at most ``buckets`` numbers."""
        return [r["b"] for r in ids.select(self._bucket().alias("b")).distinct().collect()]

    def _replace(self, new: DataFrame, touched: list[int]) -> None:
        """Put the staged rows ``new`` in place of the touched buckets."""
        if not touched:
            return
        rows = conform_to_schema(new, self.schema()).select(*[f"`{f}`" for f in self.schema().fieldNames()])
        rows = self._stage(rows.withColumn(BUCKET, self._bucket()))
        left = {r[BUCKET] for r in rows.select(BUCKET).distinct().collect()}
        mode = "spark.sql.sources.partitionOverwriteMode"     # inserts into tables take it from the session only
        was = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            self._balanced(rows).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(mode, was)
        empty = [b for b in touched if b not in left]
        if empty:
            parts = ", ".join(f"PARTITION ({BUCKET} = {b})" for b in empty)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {parts}")
        self.spark.catalog.refreshTable(self.name)

    def _balanced(self, rows: DataFrame) -> DataFrame:
        """Rows in the table's column order, dealt by bucket into tasks of a bounded size."""
        names = self.spark.table(self.name).columns
        return rows.select(*[f"`{c}`" for c in names]).hint("rebalance", BUCKET)

    def _apply(self, mutation, changes: DataFrame) -> DataFrame:
        """Run a mutation over the buckets that its ids touch; its status is kept before the table changes."""
        changes = self._stage(changes)
        touched = self._touched(changes)
        base = self.spark.table(self.name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        mut = mutation(base, changes)
        status = self._stage(mut.status)
        self._replace(mut.new, touched)
        return status

    def bulk_create(self, docs: DataFrame) -> DataFrame:
        """Append documents; the status names the ids that were written."""
        empty = self.spark.createDataFrame([], self.schema())
        staged = self._stage(mutate.with_ids(docs))
        mut = mutate.bulk_create(empty, staged)
        rows = conform_to_schema(mut.new, self.schema()).select(*[f"`{f}`" for f in self.schema().fieldNames()])
        self._balanced(rows.withColumn(BUCKET, self._bucket())).write.mode("append").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return mut.status

    def bulk_update(self, changes: DataFrame) -> DataFrame:
        return self._apply(mutate.bulk_update, changes)

    def bulk_upsert(self, changes: DataFrame) -> DataFrame:
        return self._apply(mutate.bulk_upsert, changes)

    def bulk_delete(self, ids: DataFrame) -> DataFrame:
        return self._apply(mutate.bulk_delete, ids)

    def bulk_mixed(self, changes: DataFrame) -> DataFrame:
        return self._apply(mutate.bulk_mixed, changes)

    def delete_by_query(self, query, mapping: Mapping | None = None) -> int:
        """Delete the matching documents; returns how many."""
        hits = self._stage(matching(self.index(mapping), query, with_score=False).select("_id"))
        self._apply(mutate.bulk_delete, hits)
        return hits.count()

    def update(self, _id: str, doc: dict) -> None:
        """Single partial update; raises when the id does not exist."""
        ch = _align_change_types(mutate.changes_frame(self.spark, [{"_id": _id, "doc": doc}]), self.schema())
        if self.get(_id) is None:
            raise KeyError(f"document {_id} not found in {self.name}")
        self.bulk_update(ch)

    def delete(self, _id: str) -> None:
        self.bulk_delete(self.spark.createDataFrame([(0, str(_id))], "seq long, _id string"))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as table ``name`` in ``buckets`` files by ``key``, each sorted: joins and groupings of such
    tables by the key need no exchange.  ``path`` puts the files outside the warehouse."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    # one task a bucket, so that a bucket is one file
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def _align_change_types(ch: DataFrame, schema: T.StructType) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    return ch.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in ch.columns])


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order (missing ones null), then any extra columns."""
    have = set(df.columns)
    cols = [F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*cols, *extra)


def add_columns(df: DataFrame, fields: T.StructType | Mapping) -> DataFrame:
    """In-memory form of put_mapping: new columns appear as null for existing rows."""
    add = fields.to_struct_type() if isinstance(fields, Mapping) else fields
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in add.fields if f.name not in have])
