"""Declared index schema: field specs, Spark types, and the conform job.

A :class:`Mapping` is a small driver-side description of an index (tens of
fields).  It gives

* the Spark ``StructType`` of the stored documents;
* per-field query semantics (text vs keyword, analysers, ``null_value`` ...)
  consumed by the clause compiler;
* :meth:`Mapping.conform`, a pure DataFrame -> (good, rejected) job that
  checks and converts incoming rows: ``try_cast`` / ``try_to_timestamp`` so
  dirty input becomes a rejected row instead of a failed stage.
"""

from __future__ import annotations

import copy
import fnmatch
from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.analysis import AnalyzerRegistry, analyzer_from_settings

NUMERIC_TYPES = {
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}
# Spark type of each custom type name accepted by ``Mapping.custom``.
CUSTOM_TYPES = {
    "geo_point": T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]),
}
DYNAMIC_VALUES = (True, False, "strict", "runtime")


@dataclass
class FieldSpec:
    """One declared field (or multi-field sub-field)."""

    type: str
    analyzer: str | None = None
    search_analyzer: str | None = None
    index: bool = True
    null_value: Any = None
    copy_to: list[str] = field(default_factory=list)
    ignore_above: int | None = None
    normalizer: str | None = None
    format: str | None = None
    coerce: bool = True
    enabled: bool = True
    dynamic: Any = None
    fields: dict[str, "FieldSpec"] = field(default_factory=dict)
    properties: dict[str, "FieldSpec"] = field(default_factory=dict)
    custom: dict | None = None

    @property
    def is_text(self) -> bool:
        return self.type == "text"

    @property
    def is_container(self) -> bool:
        return self.type in ("nested", "object")

    def spark_type(self) -> T.DataType:
        t = self.type
        if t in ("text", "keyword"):
            return T.StringType()
        if t == "date":
            return T.TimestampType()
        if t == "boolean":
            return T.BooleanType()
        if t in NUMERIC_TYPES:
            return NUMERIC_TYPES[t]
        if t == "disabled" or (t == "object" and not self.enabled):
            return T.StringType()
        if t == "object":
            return T.StructType([T.StructField(k, v.spark_type()) for k, v in self.properties.items()])
        if t == "nested":
            inner = T.StructType([T.StructField(k, v.spark_type()) for k, v in self.properties.items()])
            return T.ArrayType(inner)
        if t == "custom":
            name = (self.custom or {}).get("type")
            if name in CUSTOM_TYPES:
                return CUSTOM_TYPES[name]
            return T.StringType()
        raise ValueError(f"unknown field type {t}")

    def to_dict(self) -> dict:
        """The mapping entry as a plain dict (only options that differ from defaults)."""
        if self.type == "custom":
            return dict(self.custom or {})
        if self.type == "disabled":
            return {"type": "object", "enabled": False}
        out: dict[str, Any] = {"type": self.type}
        if self.type == "object" and not self.enabled:
            out["enabled"] = False
        for key, default in (("analyzer", None), ("search_analyzer", None), ("normalizer", None),
                             ("format", None), ("ignore_above", None), ("null_value", None)):
            v = getattr(self, key)
            if v is not default:
                out[key] = v
        if not self.index:
            out["index"] = False
        if not self.coerce:
            out["coerce"] = False
        if self.copy_to:
            out["copy_to"] = self.copy_to[0] if len(self.copy_to) == 1 else list(self.copy_to)
        if self.dynamic is not None:
            out["dynamic"] = self.dynamic
        if self.fields:
            out["fields"] = {k: v.to_dict() for k, v in self.fields.items()}
        if self.properties:
            out["properties"] = {k: v.to_dict() for k, v in self.properties.items()}
        return out


def _common(spec: FieldSpec, opts: dict) -> FieldSpec:
    """Options every field type accepts."""
    if opts.get("index") is False:
        # a text field with a keyword sub-field keeps the flag on the sub-field only
        if "exact" in spec.fields:
            spec.fields["exact"].index = False
        else:
            spec.index = False
    if opts.get("null_value") is not None:
        spec.null_value = opts["null_value"]
    if opts.get("copy_to") is not None:
        ct = opts["copy_to"]
        spec.copy_to = [ct] if isinstance(ct, str) else list(ct)
    for name, sub in (opts.get("fields") or {}).items():
        spec.fields[name] = sub if isinstance(sub, FieldSpec) else spec_from_dict(sub)
    return spec


def spec_from_dict(d: dict) -> FieldSpec:
    """FieldSpec from a mapping dict such as ``{"type": "keyword", "ignore_above": 256}``."""
    t = d.get("type", "object" if "properties" in d else None)
    if t in ("text", "keyword", "date", "boolean") or t in NUMERIC_TYPES:
        spec = FieldSpec(
            t,
            analyzer=d.get("analyzer"),
            search_analyzer=d.get("search_analyzer"),
            ignore_above=d.get("ignore_above"),
            normalizer=d.get("normalizer"),
            format=d.get("format"),
            coerce=d.get("coerce", True),
        )
        return _common(spec, {k: v for k, v in d.items()})
    if t in ("nested", "object"):
        spec = FieldSpec(t, enabled=d.get("enabled", True), dynamic=d.get("dynamic"))
        spec.properties = {k: spec_from_dict(v) for k, v in (d.get("properties") or {}).items()}
        return spec
    return FieldSpec("custom", custom=dict(d))


#: Field that holds what an object, or the index, has beside its declared fields.
MORE = "_more"


class Mapping:
    """Builder and holder of an index schema."""

    def __init__(self):
        self.properties: dict[str, FieldSpec] = {}
        self._dynamic: Any = None
        self.source_config: dict | None = None
        self.index_settings: dict = {}

    # ---- field declarations -------------------------------------------------
    def text(self, name: str, keyword: bool = False, analyzer: str | None = None,
             search_analyzer: str | None = None, ignore_above: int | None = None, **opts) -> "Mapping":
        spec = FieldSpec("text", analyzer=analyzer, search_analyzer=search_analyzer)
        if keyword:
            spec.fields["exact"] = FieldSpec("keyword", ignore_above=ignore_above)
        self.properties[name] = _common(spec, opts)
        return self

    def keyword(self, name: str, ignore_above: int | None = None, normalizer: str | None = None, **opts) -> "Mapping":
        spec = FieldSpec("keyword", ignore_above=ignore_above, normalizer=normalizer)
        self.properties[name] = _common(spec, opts)
        return self

    def date(self, name: str, format: str | None = None, **opts) -> "Mapping":
        self.properties[name] = _common(FieldSpec("date", format=format), opts)
        return self

    def boolean(self, name: str, **opts) -> "Mapping":
        self.properties[name] = _common(FieldSpec("boolean"), opts)
        return self

    def _numeric(self, name: str, kind: str, coerce: bool = True, **opts) -> "Mapping":
        self.properties[name] = _common(FieldSpec(kind, coerce=coerce), opts)
        return self

    def integer(self, name: str, **opts) -> "Mapping":
        return self._numeric(name, "integer", **opts)

    def long(self, name: str, **opts) -> "Mapping":
        return self._numeric(name, "long", **opts)

    def float(self, name: str, **opts) -> "Mapping":
        return self._numeric(name, "float", **opts)

    def double(self, name: str, **opts) -> "Mapping":
        return self._numeric(name, "double", **opts)

    def nested(self, name: str, build: Callable[["Mapping"], Any], dynamic: Any = None) -> "Mapping":
        inner = Mapping()
        build(inner)
        self.properties[name] = FieldSpec("nested", properties=inner.properties, dynamic=dynamic)
        return self

    def object(self, name: str, build: Callable[["Mapping"], Any] | None = None,
               enabled: bool = True, dynamic: Any = None) -> "Mapping":
        inner = Mapping()
        if build is not None:
            build(inner)
        self.properties[name] = FieldSpec("object", properties=inner.properties, enabled=enabled, dynamic=dynamic)
        return self

    def disabled(self, name: str) -> "Mapping":
        self.properties[name] = FieldSpec("disabled", enabled=False, index=False)
        return self

    def custom(self, name: str, mapping: dict) -> "Mapping":
        self.properties[name] = FieldSpec("custom", custom=dict(mapping))
        return self

    def dynamic(self, value: Any) -> "Mapping":
        if value not in DYNAMIC_VALUES:
            raise ValueError(f"dynamic must be one of {DYNAMIC_VALUES}")
        self._dynamic = value
        return self

    def source(self, enabled: bool | None = None, includes: list[str] | None = None,
               excludes: list[str] | None = None) -> "Mapping":
        self.source_config = {k: v for k, v in (("enabled", enabled), ("includes", includes),
                                                 ("excludes", excludes)) if v is not None}
        return self

    def settings(self, number_of_shards: int | None = None, analysis: dict | None = None,
                 max_ngram_diff: int | None = None, **other) -> "Mapping":
        if analysis is not None:
            limit = max_ngram_diff if max_ngram_diff is not None else 1
            for tname, tok in (analysis.get("tokenizer") or {}).items():
                if tok.get("type") == "ngram":
                    diff = int(tok.get("max_gram", 2)) - int(tok.get("min_gram", 1))
                    if diff > limit:
                        raise ValueError(
                            f"tokenizer {tname}: max_gram - min_gram = {diff} exceeds max_ngram_diff {limit}")
            self.index_settings["analysis"] = analysis
        if number_of_shards is not None:
            self.index_settings["number_of_shards"] = int(number_of_shards)
        if max_ngram_diff is not None:
            self.index_settings["max_ngram_diff"] = int(max_ngram_diff)
        self.index_settings.update(other)
        return self

    # ---- derived views ------------------------------------------------------
    @property
    def dynamic_policy(self) -> Any:
        return True if self._dynamic is None else _policy(self._dynamic)

    def policy_at(self, parts: list[str]) -> Any:
        """Policy for undeclared fields of the innermost declared level that the path passes."""
        policy, props = self.dynamic_policy, self.properties
        for p in parts:
            spec = props.get(p)
            if spec is None:
                break
            policy, props = _own_policy(spec, policy), spec.properties
        return policy

    def analyzers(self) -> AnalyzerRegistry:
        reg = AnalyzerRegistry()
        analysis = self.index_settings.get("analysis") or {}
        tokenizers = analysis.get("tokenizer") or {}
        for name, spec in (analysis.get("analyzer") or {}).items():
            reg.register(analyzer_from_settings(name, spec, tokenizers))
        return reg

    def merge(self, other: "Mapping") -> "Mapping":
        """Add another mapping's fields and analysis settings; what both declare must be declared alike."""
        for name, spec in other.properties.items():
            if self.properties.setdefault(name, spec) != spec:
                raise ValueError(f"field {name} is declared differently in the mappings to merge")
        for kind, entries in (other.index_settings.get("analysis") or {}).items():
            mine = self.index_settings.setdefault("analysis", {}).setdefault(kind, {})
            for name, entry in entries.items():
                if mine.setdefault(name, entry) != entry:
                    raise ValueError(f"analysis {kind} {name} is declared differently in the mappings to merge")
        return self

    def to_dict(self) -> dict:
        out: dict[str, Any] = {"mappings": {"properties": {k: v.to_dict() for k, v in self.properties.items()}}}
        if self._dynamic is not None:
            out["mappings"]["dynamic"] = self._dynamic
        if self.source_config is not None:
            out["mappings"]["_source"] = dict(self.source_config)
        if self.index_settings:
            out["settings"] = copy.deepcopy(self.index_settings)
        return out

    def to_struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(k, v.spark_type()) for k, v in self.properties.items()])

    def resolve(self, path: str) -> tuple[list[str], FieldSpec | None, str | None]:
        """Split a dotted path into (column path, spec, multi-field name).

        ``title.exact`` -> (['title'], <keyword spec>, 'exact');
        ``metadata.source`` -> (['metadata', 'source'], <spec>, None).
        Unknown paths return spec None (the caller falls back to the column type).
        """
        parts = path.split(".")
        props = self.properties
        col_path: list[str] = []
        spec: FieldSpec | None = None
        i = 0
        while i < len(parts):
            p = parts[i]
            if spec is not None and p in spec.fields and not spec.is_container:
                return col_path, spec.fields[p], p
            cur = props.get(p) if props is not None else None
            if cur is None:
                return parts, None, None
            col_path.append(p)
            spec = cur
            props = cur.properties if cur.is_container else None
            i += 1
        return col_path, spec, None

    def source_columns(self, columns: list[str]) -> list[str]:
        """Columns kept in ``_source`` under the include/exclude patterns."""
        cfg = self.source_config or {}
        if cfg.get("enabled") is False:
            return []
        keep = list(columns)
        if cfg.get("includes"):
            keep = [c for c in keep if any(fnmatch.fnmatchcase(c, p) for p in cfg["includes"])]
        if cfg.get("excludes"):
            keep = [c for c in keep if not any(fnmatch.fnmatchcase(c, p) for p in cfg["excludes"])]
        return keep

    @classmethod
    def infer(cls, schema: T.StructType, text: tuple[str, ...] | list[str] = (),
              dates_as: str = "date") -> "Mapping":
        """Mapping for an existing table: strings are keyword unless listed in ``text``."""
        m = cls()
        for f in schema.fields:
            m.properties[f.name] = _infer_spec(f.name, f.dataType, set(text), dates_as)
        return m

    # ---- ingest -------------------------------------------------------------
    def conform(self, df: DataFrame, with_tokens: bool = True) -> tuple[DataFrame, DataFrame]:
        """Check and convert ``df`` to this mapping; returns (good, rejected).

        One pass, no shuffle: each row is converted with ``try_*`` functions,
        the errors of a row are gathered into ``_errors`` and the frame is
        split on it.  ``rejected`` keeps the input columns plus ``_errors``.
        """
        return conform(self, df, with_tokens)


def _infer_spec(name: str, dt: T.DataType, text: set[str], dates_as: str) -> FieldSpec:
    if isinstance(dt, T.StringType):
        return FieldSpec("text" if name in text else "keyword")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return FieldSpec(dates_as)
    if isinstance(dt, T.BooleanType):
        return FieldSpec("boolean")
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return FieldSpec("integer")
    if isinstance(dt, T.LongType):
        return FieldSpec("long")
    if isinstance(dt, T.FloatType):
        return FieldSpec("float")
    if isinstance(dt, (T.DoubleType, T.DecimalType)):
        return FieldSpec("double")
    if isinstance(dt, T.StructType):
        return FieldSpec("object", properties={f.name: _infer_spec(f.name, f.dataType, text, dates_as)
                                               for f in dt.fields})
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        return FieldSpec("nested", properties={f.name: _infer_spec(f.name, f.dataType, text, dates_as)
                                               for f in dt.elementType.fields})
    if isinstance(dt, T.ArrayType):
        inner = _infer_spec(name, dt.elementType, text, dates_as)
        return inner
    return FieldSpec("keyword")


def token_column_name(path: str) -> str:
    """Stored token column of a (sub-)field path: ``title.exact`` -> ``title__exact__tokens``."""
    return path.replace(".", "__") + "__tokens"


# ---------------------------------------------------------------------------
# conform job
# ---------------------------------------------------------------------------

def _convert(spec: FieldSpec, col: Column, in_type: T.DataType, path: str, policy: Any = True) -> tuple[Column, list[Column]]:
    """Converted value and error-message columns (null when fine) for one field."""
    errs: list[Column] = []
    t = spec.type
    if t in ("text", "keyword"):
        if isinstance(in_type, (T.StructType, T.ArrayType, T.MapType)):
            out = F.to_json(col)
        else:
            out = col.cast("string")
        return out, errs
    if t in NUMERIC_TYPES:
        target = NUMERIC_TYPES[t]
        if isinstance(in_type, T.StringType) and not spec.coerce:
            errs.append(F.when(col.isNotNull(), F.lit(f"{path}: string not accepted (coerce=false)")))
            return F.lit(None).cast(target), errs
        out = col.try_cast(target)
        errs.append(F.when(col.isNotNull() & out.isNull(), F.lit(f"{path}: not a {t}")))
        return out, errs
    if t == "boolean":
        out = col.try_cast(T.BooleanType())
        errs.append(F.when(col.isNotNull() & out.isNull(), F.lit(f"{path}: not a boolean")))
        return out, errs
    if t == "date":
        if isinstance(in_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return col.cast("timestamp"), errs
        if isinstance(in_type, (T.LongType, T.IntegerType)) or spec.format == "epoch_millis":
            out = F.timestamp_millis(col.try_cast(T.LongType()))
        elif spec.format:
            out = F.try_to_timestamp(col.cast("string"), F.lit(spec.format))
        else:
            out = F.try_to_timestamp(col.cast("string"))
        errs.append(F.when(col.isNotNull() & out.isNull(), F.lit(f"{path}: not a date")))
        return out, errs
    if t == "disabled" or (t == "object" and not spec.enabled):
        out = col if isinstance(in_type, T.StringType) else F.to_json(col)
        return out, errs
    if t in ("object", "nested") and isinstance(in_type, (T.StringType, T.VariantType)):
        packed, n = _from_json(spec, col, in_type, path, policy)
        return packed["value"], _errors(packed, n)
    if t == "object":
        if isinstance(in_type, T.StructType):
            return _from_struct(spec, col, in_type, path, policy)
        raise TypeError(f"{path}: cannot read {in_type} as object")
    if t == "nested":
        if isinstance(in_type, T.ArrayType) and isinstance(in_type.elementType, T.StructType):
            packed = _elements(col, lambda e: _packed(*_from_struct(spec, e, in_type.elementType, path, policy)))
            return packed["value"], _errors(packed, 1)
        raise TypeError(f"{path}: cannot read {in_type} as nested")
    if t == "custom":
        target = spec.spark_type()
        if isinstance(target, T.StructType) and isinstance(in_type, T.StringType):
            out = F.from_json(col, target)
            errs.append(F.when(col.isNotNull() & out.isNull(), F.lit(f"{path}: not a {spec.custom.get('type')}")))
            return out, errs
        return col.cast(target), errs
    raise ValueError(f"unknown type {t}")


def _policy(value: Any) -> Any:
    """The policy that a request names, in words or as a boolean."""
    return {"true": True, "false": False}.get(value, value) if isinstance(value, str) else value


def _own_policy(spec: FieldSpec, policy: Any) -> Any:
    """An object's own policy for undeclared fields, else that of the level above."""
    return policy if spec.dynamic is None else _policy(spec.dynamic)


def _from_struct(spec: FieldSpec, col: Column, in_type: T.StructType, path: str, policy: Any) -> tuple[Column, list[Column]]:
    """A struct by the declared sub-fields; undeclared ones are errors (``strict``) or stay as they came."""
    policy = _own_policy(spec, policy)
    names = {f.name: f.dataType for f in in_type.fields}
    parts, errs = [], []
    for k, sub in spec.properties.items():
        if k in names:
            v, e = _convert(sub, col.getField(k), names[k], f"{path}.{k}", policy)
            errs.extend(e)
        else:
            v = F.lit(None).cast(sub.spark_type())
        parts.append(v.alias(k))
    for n in names:
        if n not in spec.properties:
            if policy == "strict":
                errs.append(F.when(col.getField(n).isNotNull(), F.lit(f"{path}.{n}: unknown field")))
            else:
                parts.append(col.getField(n).alias(n))
    return F.when(col.isNotNull(), F.struct(*parts)), errs


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _packed(value: Column, errs: list[Column]) -> Column:
    """A converted value and its error messages as one expression; who names it more than once binds it."""
    return F.struct(value.alias("value"), F.array(*errs).cast("array<string>").alias("errors"))


def _errors(packed: Column, n: int) -> list[Column]:
    return [F.get(packed["errors"], F.lit(i)) for i in range(n)]


def _elements(array: Column, one: Callable[[Column], Column], *errs: Column) -> Column:
    """Every element converted (packed), after ``errs`` the distinct errors of all elements as one message."""
    def both(done: Column) -> Column:
        found = F.array_distinct(F.flatten(F.transform(done, lambda x: F.array_compact(x["errors"]))))
        return _packed(F.transform(done, lambda x: x["value"]), [*errs, _let(found, lambda f: F.when(F.size(f) > 0, F.array_join(f, "; ")))])

    return _let(F.transform(array, one), both)


def _from_json(spec: FieldSpec, col: Column, in_type: T.DataType, path: str, policy: Any) -> tuple[Column, int]:
    """An object or list of objects from JSON, packed, and how many errors it can have."""
    n = 0

    def checked(v: Column) -> Column:
        nonlocal n
        packed, n = _from_variant(spec, v, path, policy)
        odd = F.when(col.isNotNull() & v.isNull(), F.lit(f"{path}: not {'an object' if spec.type == 'object' else 'a list of objects'}"))
        return _let(packed, lambda p: _packed(p["value"], [odd, *_errors(p, n)]))

    return _let(F.try_parse_json(col) if isinstance(in_type, T.StringType) else col, checked), n + 1


def _from_variant(spec: FieldSpec, v: Column, path: str, policy: Any) -> tuple[Column, int]:
    """A value of parsed JSON by its declaration, at any depth: packed, and how many errors it can have.

    Undeclared fields of an object are an error (``strict``) or stay, whatever
    their types, in its ``_more`` field, a VARIANT that is null where there are none.
    """
    t = spec.type
    there = v.isNotNull() & ~F.is_variant_null(v)
    if t in ("text", "keyword"):
        return _packed(F.try_variant_get(v, "$", "string"), []), 0
    if t in ("date", "disabled") or t == "object" and not spec.enabled:
        value, errs = _convert(spec, F.try_variant_get(v, "$", "string"), T.StringType(), path, policy)
        return _packed(value, errs), len(errs)
    if t not in ("object", "nested"):
        kind = T.BooleanType() if t == "boolean" else NUMERIC_TYPES.get(t) or spec.spark_type()
        out = F.try_variant_get(v, "$", kind.simpleString())
        errs = [F.when(there & out.isNull(), F.lit(f"{path}: not {'an' if t[0] in 'aeiou' else 'a'} {t}"))]
        if not spec.coerce:
            errs.append(F.when(F.schema_of_variant(v) == "STRING", F.lit(f"{path}: string not accepted (coerce=false)")))
        return _packed(out, errs), len(errs)
    policy = _own_policy(spec, policy)
    n = 0

    def map_of(v: Column) -> Column:
        return F.try_variant_get(v, "$", "map<string,variant>")

    def of(fields: Column, *errs: Column) -> Column:
        nonlocal n
        subs = [_from_variant(sub, F.try_element_at(fields, F.lit(k)), f"{path}.{k}", policy) for k, sub in spec.properties.items()]
        extra = F.map_filter(fields, lambda k, x: ~k.isin(list(spec.properties))) if spec.properties else fields
        n = len(errs) + sum(k for _, k in subs) + (policy == "strict")

        def whole(b: Column) -> Column:
            parts = [b[f"f{i}"]["value"].alias(k) for i, k in enumerate(spec.properties)]
            found = [*errs, *(e for i, (_, k) in enumerate(subs) for e in _errors(b[f"f{i}"], k))]
            if policy == "strict":
                found.append(F.when(F.size(b["extra"]) > 0, F.lit(f"{path}: unknown field")))
            else:
                parts.append(F.when(F.size(b["extra"]) > 0, F.parse_json(F.to_json(b["extra"]))).alias(MORE))
            return _packed(F.when(fields.isNotNull(), F.struct(*parts)), found)

        return _let(F.struct(*[p.alias(f"f{i}") for i, (p, _) in enumerate(subs)], extra.alias("extra")), whole)

    if t == "object":
        return _let(map_of(v), lambda fields: of(fields, F.when(there & fields.isNull(), F.lit(f"{path}: not an object")))), n
    # one object counts as a list of one
    elements = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(map_of(v).isNotNull(), F.array(v)))

    def a_list(elements: Column) -> Column:
        odd = F.exists(elements, lambda e: map_of(e).isNull() & ~F.is_variant_null(e))
        return _elements(elements, lambda e: _let(map_of(e), lambda fields: of(fields)), F.when(there & (elements.isNull() | odd), F.lit(f"{path}: not a list of objects")))

    return _let(elements, a_list), 2


def conform(mapping: Mapping, df: DataFrame, with_tokens: bool = True) -> tuple[DataFrame, DataFrame]:
    in_types = {f.name: f.dataType for f in df.schema.fields}
    meta = [c for c in ("_id", "_index") if c in in_types]
    policy = mapping.dynamic_policy
    out_cols: list[Column] = [F.col(c) for c in meta]
    errs: list[Column] = []
    for name, spec in mapping.properties.items():
        if name in in_types and spec.is_container and spec.enabled and isinstance(in_types[name], (T.StringType, T.VariantType)):
            # a generator of one row: neither the filters nor the columns below repeat the conversion
            packed, n = _from_json(spec, F.col(f"`{name}`"), in_types[name], name, policy)
            df = df.withColumn(f"__json__{name}", F.explode(F.array(packed)))
            value = F.col(f"`__json__{name}`")["value"]
            errs.extend(_errors(F.col(f"`__json__{name}`"), n))
        elif name in in_types:
            value, e = _convert(spec, F.col(f"`{name}`"), in_types[name], name, policy)
            errs.extend(e)
        else:
            value = F.lit(None).cast(spec.spark_type())
        out_cols.append(value.alias(name))
    unknown = [c for c in in_types if c not in mapping.properties and c not in meta]
    for c in unknown:
        if policy == "strict":
            errs.append(F.when(F.col(f"`{c}`").isNotNull(), F.lit(f"{c}: unknown field (dynamic=strict)")))
        elif policy != "runtime":
            # true: added as its own column; false: kept in _source only
            out_cols.append(F.col(f"`{c}`"))
    if unknown and policy == "runtime":     # no column of their own: read when a query names them
        out_cols.append(F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in unknown])).alias(MORE))
    err_array = F.filter(F.array(*errs), lambda x: x.isNotNull()) if errs else F.array().cast("array<string>")
    staged = df.select(*out_cols, err_array.alias("_errors"), *[F.col(f"`{c}`").alias(f"__in__{c}") for c in in_types])
    good = staged.filter(F.size("_errors") == 0).select(*[F.col(f"`{c}`") for c in _out_names(mapping, meta, unknown, policy)])
    rejected = staged.filter(F.size("_errors") > 0).select(
        *[F.col(f"`__in__{c}`").alias(c) for c in in_types], "_errors")
    if with_tokens:
        good = add_token_columns(mapping, good)
    return good, rejected


def _out_names(mapping: Mapping, meta: list[str], unknown: list[str], policy: Any) -> list[str]:
    names = list(meta) + list(mapping.properties)
    if policy == "runtime":
        names += [MORE] if unknown else []
    elif policy != "strict":
        names += unknown
    return names


def add_token_columns(mapping: Mapping, df: DataFrame) -> DataFrame:
    """Append ``<field>__tokens`` for every searchable text field and text sub-field,
    plus ``copy_to`` targets (token arrays of the sources concatenated)."""
    reg = mapping.analyzers()
    new: dict[str, Column] = {}
    for name, spec in mapping.properties.items():
        if spec.is_text and spec.index:
            new[token_column_name(name)] = reg.get(spec.analyzer).column(F.col(f"`{name}`"))
        for sub_name, sub in spec.fields.items():
            if sub.is_text and sub.index:
                new[token_column_name(f"{name}.{sub_name}")] = reg.get(sub.analyzer).column(F.col(f"`{name}`"))
    targets: dict[str, list[str]] = {}
    for name, spec in mapping.properties.items():
        for t in spec.copy_to:
            targets.setdefault(t, []).append(name)
    for target, sources in targets.items():
        tspec = mapping.properties.get(target)
        an = reg.get(tspec.analyzer if tspec is not None else None)
        parts = [F.coalesce(an.column(F.col(f"`{s}`").cast("string")), F.array().cast("array<string>"))
                 for s in sources]
        own = token_column_name(target)
        if own in new:
            parts = [F.coalesce(new[own], F.array().cast("array<string>"))] + parts
        new[own] = F.concat(*parts)
    return df.withColumns(new) if new else df
