"""Bulk document mutation as pure DataFrame functions.

Every function maps ``(base, changes) -> Mutation(new, status)``; nothing is
written here (see :mod:`seekframe.sources.tables` for the versioned sink).

Change frames
-------------
* update / upsert: ``seq BIGINT, _id STRING, _set ARRAY<STRING>, <fields...>``.
  ``_set`` lists the fields a change assigns, so an explicit null differs
  from "not given".  When ``_set`` is absent every non-null field counts.
* delete: ``seq BIGINT, _id STRING``.

Repeated ids in one bulk collapse per field to the last setter
(``max_by(value, seq)`` over the changes that set it).  ``max_by`` is a
partial aggregate, so a hot id holding a third of a change set is combined
map-side before the shuffle.

``seq`` orders the changes of one id and is required wherever an id may repeat.

Scale: joins carry no hints; Spark broadcasts a change set whose size allows it,
and otherwise sorts and merges, splitting skewed partitions.  Building a
mutation starts no job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clauses import Context, compile_clause, prepare
from ..sources.index import Index

RESERVED = ("seq", "_id", "_set", "op")


@dataclass
class Mutation:
    new: DataFrame          # the table after the change
    status: DataFrame       # one row per input item: seq, op, _id, status, error
    observation: Observation | None = None

    def errors(self) -> DataFrame:
        """One row: ``errors`` = any item failed."""
        return self.status.agg(F.coalesce(F.bool_or(F.col("error").isNotNull()), F.lit(False)).alias("errors"))


def _fields(changes: DataFrame) -> list[str]:
    return [c for c in changes.columns if c not in RESERVED]


def _with_set(changes: DataFrame) -> DataFrame:
    if "_set" in changes.columns:
        return changes
    flags = [F.when(_get(path).isNotNull(), F.lit(path)) for path, _ in _paths(changes)]
    return changes.withColumn("_set", F.filter(F.array(*flags), lambda x: x.isNotNull()))


def _with_seq(changes: DataFrame) -> DataFrame:
    if "seq" not in changes.columns:
        raise ValueError("changes need a seq column, which says which of several changes of one id comes last")
    return changes


def collapse(changes: DataFrame) -> DataFrame:
    """One row per ``_id``: for each path (a field, or ``field.sub`` down a
    struct) that any change may set, the value of the last change that sets it
    (``__new__<path>``), the ``seq`` of that change (``__at__<path>``), and the
    last ``seq`` of all.

    ``_set`` names fields or dotted paths; naming a struct sets it field by
    field, so what a change does not name survives.
    """
    ch = _with_set(_with_seq(changes))
    aggs: list[Column] = [F.max("seq").alias("__seq")]
    for path, parents in _paths(ch):
        setter = F.arrays_overlap("_set", F.array(*[F.lit(p) for p in parents]))
        at = F.when(setter, F.col("seq"))
        aggs.append(F.max_by(_get(path), at).alias(f"__new__{path}"))
        aggs.append(F.max(at).alias(f"__at__{path}"))
    return ch.groupBy("_id").agg(*aggs)


def _get(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def _leaves(name: str, dt: T.DataType) -> list[str]:
    if isinstance(dt, T.StructType):
        return [x for f in dt.fields for x in _leaves(f"{name}.{f.name}", f.dataType)]
    return [name]


def _paths(changes: DataFrame) -> list[tuple[str, list[str]]]:
    """Every leaf path of the change fields with the names under which it may be set: itself and its parents."""
    out = []
    for f in _fields(changes):
        for leaf in _leaves(f, changes.schema[f].dataType):
            parts = leaf.split(".")
            out.append((leaf, [".".join(parts[:i + 1]) for i in range(len(parts))]))
    return out


def _apply(base: DataFrame, changes: DataFrame, upsert: bool) -> DataFrame:
    """Base rows with the changes applied, and with ``upsert`` the rows whose id is new: one join by ``_id``."""
    return _merge(base.join(collapse(changes), "_id", "full" if upsert else "left"), base, changes)


def _merge(joined: DataFrame, base: DataFrame, changes: DataFrame) -> DataFrame:
    fields = _fields(changes)
    out: list[Column] = []
    for c in base.columns:
        old = base.schema[c].dataType
        if c == "_id" or c not in fields:
            out.append(F.col(f"`{c}`"))
        else:
            out.append(_value(c, F.col(f"`{c}`"), old, changes.schema[c].dataType).alias(c))
    for f in fields:
        if f not in base.columns:
            dt = changes.schema[f].dataType
            out.append(_value(f, F.lit(None).cast(dt), dt, dt).alias(f))
    return joined.select(*out)


def _value(path: str, old: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Old value with what the changes set below ``path``; struct fields that no change names stay."""
    if not isinstance(new_type, T.StructType):
        return F.when(F.col(f"`__at__{path}`").isNotNull(), F.col(f"`__new__{path}`")).otherwise(old)
    if not isinstance(old_type, T.StructType):
        raise TypeError(f"{path}: a struct cannot be merged into {old_type.simpleString()}")
    new = {f.name: f.dataType for f in new_type.fields}
    have = {f.name: f.dataType for f in old_type.fields}
    parts = [(_value(f"{path}.{n}", old.getField(n), dt, new[n]) if n in new else old.getField(n)).alias(n)
             for n, dt in have.items()]
    parts += [_value(f"{path}.{n}", F.lit(None).cast(dt), dt, dt).alias(n) for n, dt in new.items() if n not in have]
    touched = F.lit(False)
    for leaf in _leaves(path, new_type):
        touched |= F.col(f"`__at__{leaf}`").isNotNull()
    return F.when(old.isNotNull() | touched, F.struct(*parts))


def _status(changes: DataFrame, base: DataFrame, op: str, ok: int, missing: int | None,
            missing_error: str | None, new_status: int | None = None) -> DataFrame:
    ch = changes
    ids = ch.select("_id").distinct()
    found = base.select("_id").join(ids, "_id", "left_semi").withColumn("__found", F.lit(True))
    j = ch.select("seq", "_id").join(found, "_id", "left")
    hit = F.coalesce(F.col("__found"), F.lit(False))
    if new_status is not None:
        status = F.when(hit, F.lit(ok)).otherwise(F.lit(new_status))
        error = F.lit(None).cast("string")
    else:
        status = F.when(hit, F.lit(ok)).otherwise(F.lit(missing))
        error = F.when(hit, F.lit(None).cast("string")).otherwise(F.lit(missing_error))
    return j.select("seq", F.lit(op).alias("op"), "_id", status.alias("status"), error.alias("error"))


def bulk_update(base: DataFrame, changes: DataFrame) -> Mutation:
    """Partial update; ids missing from ``base`` are reported 404 and skipped."""
    ch = _with_seq(changes)
    new = _apply(base, ch, upsert=False)
    return Mutation(new, _status(ch, base, "update", 200, 404, "document_missing_exception"))


def bulk_upsert(base: DataFrame, changes: DataFrame) -> Mutation:
    """Update existing ids, insert the others (``doc_as_upsert``)."""
    ch = _with_seq(changes)
    new = _apply(base, ch, upsert=True)
    return Mutation(new, _status(ch, base, "update", 200, None, None, new_status=201))


def bulk_delete(base: DataFrame, ids: DataFrame) -> Mutation:
    """Remove documents by id; unknown ids are a no-op reported ``not_found`` (404, no error)."""
    ch = ids.select(F.col("seq") if "seq" in ids.columns else F.lit(None).cast("long").alias("seq"), "_id")
    new = base.join(ch.select("_id").distinct(), "_id", "left_anti")
    status = _status(ch, base, "delete", 200, 404, None)
    return Mutation(new, status)


def with_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with an ``_id``: the given one, else a random UUID.

    The ids are non-deterministic: write the frame once and go on from what was written.
    """
    given = F.col("_id").cast("string") if "_id" in docs.columns else F.lit(None).cast("string")
    return docs.withColumn("_id", F.coalesce(given, F.uuid()))


def bulk_create(base: DataFrame, docs: DataFrame) -> Mutation:
    """Append documents; ids as :func:`with_ids` gives them."""
    d = with_ids(docs if "seq" in docs.columns else docs.withColumn("seq", F.lit(None).cast("long")))
    new = base.unionByName(d.drop("seq", "_set", "op"), allowMissingColumns=True)
    status = d.select("seq", F.lit("create").alias("op"), "_id", F.lit(201).alias("status"),
                      F.lit(None).cast("string").alias("error"))
    return Mutation(new, status)


def bulk_mixed(base: DataFrame, changes: DataFrame) -> Mutation:
    """Upserts and deletes in one bulk (``op`` is ``upsert`` or ``delete``), each id's in the order of ``seq``.

    A delete wipes what came before it: an id whose last change is a delete
    goes, and changes after a delete start from an empty document.
    """
    ch = _with_seq(changes)
    wiped = F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("__wiped")
    last = ch.groupBy("_id").agg(wiped, F.max("seq").alias("__last"))
    kept = (ch.join(last.select("_id", "__wiped"), "_id").filter("op = 'upsert' AND (__wiped IS NULL OR seq > __wiped)")
            .drop("__wiped", "op"))
    # ids with a delete start anew
    rest = base.join(last.filter("__wiped IS NOT NULL").select("_id"), "_id", "left_anti")
    new = _apply(rest, kept, upsert=True)
    return Mutation(new, _status(ch.filter("op = 'upsert'"), base, "upsert", 200, None, None, new_status=201)
                    .unionByName(_status(ch.filter("op = 'delete'"), base, "delete", 200, 404, None)))


def delete_by_query(index: Index, query) -> Mutation:
    """Keep the rows that do not match; the deleted count is observed on the
    same pass (``mutation.observation.get['deleted']`` after an action)."""
    cols = [F.col(f"`{c}`") for c in index.df.columns]
    index = prepare(index, query)
    comp = compile_clause(query, Context(index))
    obs = Observation("delete_by_query")
    flagged = index.df.withColumn("__hit", F.coalesce(comp.matched, F.lit(False)))
    observed = flagged.observe(obs, F.count_if(F.col("__hit")).alias("deleted"))
    new = observed.filter(~F.col("__hit")).select(*cols)
    status = flagged.filter(F.col("__hit")).select(
        F.lit(None).cast("bigint").alias("seq"), F.lit("delete").alias("op"), "_id",
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"))
    return Mutation(new, status, obs)


def changes_frame(spark, rows: list[dict], schema: str | None = None) -> DataFrame:
    """Change frame from Python dicts ``{"_id": ..., "doc": {...}}`` (single calls, tests)."""
    out = []
    for i, r in enumerate(rows):
        doc = dict(r.get("doc") or {})
        out.append({"seq": int(r.get("seq", i)), "_id": str(r["_id"]), "_set": sorted(doc), **doc})
    return spark.createDataFrame(out, schema) if schema else spark.createDataFrame(out)
