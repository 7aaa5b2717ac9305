"""An index = a DataFrame of documents + its mapping + a name.

The DataFrame is never materialised here; an :class:`Index` only records how
to read each field for the clause compiler (raw value, array-ness, analysed
terms) and how to get corpus statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.analysis import AnalyzerRegistry
from .mapping import MORE, FieldSpec, Mapping, token_column_name

META_COLUMNS = ("_index", "_id")


@dataclass
class ResolvedField:
    """How one field path reads in a query."""

    path: str
    spec: FieldSpec
    value: Column            # raw value (scalar or array of values)
    data_type: T.DataType    # Spark type of ``value``
    is_array: bool
    tokens: Column | None    # analysed terms for text fields, else None
    search_analyzer: str | None

    @property
    def is_text(self) -> bool:
        return self.spec.is_text

    @property
    def element_type(self) -> T.DataType:
        return self.data_type.elementType if self.is_array else self.data_type

    @property
    def predicate_value(self) -> Column:
        """Value as predicates see it: ``ignore_above`` hides long keywords,
        ``normalizer`` lower-cases, ``null_value`` stands in for null.
        Without those options the bare column is returned so Catalyst can push
        comparisons on it down to the parquet scan."""
        v = self.value
        spec = self.spec

        def one(x):
            if spec.ignore_above is not None:
                x = F.when(F.length(x) <= spec.ignore_above, x)
            if spec.normalizer in ("lowercase", "lower"):
                x = F.lower(x)
            if spec.null_value is not None:
                x = F.coalesce(x, F.lit(spec.null_value).cast(self.element_type))
            return x

        if spec.ignore_above is None and spec.normalizer is None and spec.null_value is None:
            return v
        if self.is_array:
            return F.transform(v, one)
        return one(v)

    def normalise_literal(self, value):
        if self.spec.normalizer in ("lowercase", "lower") and isinstance(value, str):
            return value.lower()
        return value


def _walk_type(dt: T.DataType, parts: list[str]) -> tuple[T.DataType, bool] | None:
    """Spark type reached by a dotted path, and whether an array was crossed."""
    crossed = False
    for p in parts:
        while isinstance(dt, T.ArrayType):
            crossed = True
            dt = dt.elementType
        if not isinstance(dt, T.StructType) or p not in dt.fieldNames():
            return None
        dt = dt[p].dataType
    return dt, crossed


class Index:
    """A searchable collection of documents.

    ``df``       documents; must contain ``_id`` or name an ``id_col``
    ``mapping``  declared schema; inferred from ``df`` when omitted (strings are
                 keyword unless listed in ``text``)
    ``name``     value of the ``_index`` metadata column
    ``stats``    optional stored statistics (:class:`seekframe.operators.postings.SearchTables`)
    """

    def __init__(self, df: DataFrame, mapping: Mapping | None = None, name: str = "index",
                 id_col: str | None = None, text: tuple[str, ...] | list[str] = (), stats=None):
        cols = df.columns
        if "_id" not in cols:
            if id_col is None:
                raise ValueError("an index needs an _id column or id_col")
            df = df.withColumn("_id", F.col(id_col).cast("string"))
        if "_index" not in cols:
            df = df.withColumn("_index", F.lit(name))
        self.df = df
        self.name = name
        self.id_col = id_col
        self.mapping = mapping if mapping is not None else Mapping.infer(
            T.StructType([f for f in df.schema.fields if f.name not in META_COLUMNS
                          and not f.name.endswith("__tokens")]), text)
        self.analyzers: AnalyzerRegistry = self.mapping.analyzers()
        self.stats = stats

    # ------------------------------------------------------------------
    @property
    def source_columns(self) -> list[str]:
        cols = [c for c in self.df.columns if c not in META_COLUMNS and not c.endswith("__tokens")]
        return self.mapping.source_columns(cols)

    def with_df(self, df: DataFrame) -> "Index":
        out = Index.__new__(Index)
        out.__dict__.update(self.__dict__)
        out.df = df
        return out

    @staticmethod
    def union(indices: list["Index"]) -> "Index":
        """Search several indices as one; every hit keeps its ``_index``.
        Statistics are computed over the union (one shared corpus)."""
        if not indices:
            raise ValueError("no index given")
        df = indices[0].df
        mapping = Mapping()
        for ix in indices:
            mapping.merge(ix.mapping)
        for ix in indices[1:]:
            df = df.unionByName(ix.df, allowMissingColumns=True)
        return Index(df, mapping=mapping, name=",".join(i.name for i in indices))

    def with_tokens(self, paths) -> "Index":
        """Index whose rows carry ``<field>__tokens`` for the given text fields.

        The terms are computed by one ``Generate`` (``inline`` of a one-element
        array), which the optimizer does not inline into the filter and the
        score expressions, so each row is tokenised once per scan however
        many clauses read the terms.  Filters on other columns are still
        pushed below it, into the parquet scan."""
        need, names = [], set(self.df.columns)
        for p in dict.fromkeys(paths):
            name = token_column_name(p)
            if name in names:
                continue
            try:
                rf = self.field(p)
            except ValueError:
                continue
            if rf.tokens is None:
                continue
            need.append(rf.tokens.alias(name))
            names.add(name)
        if not need:
            return self
        return self.with_df(self.df.select("*", F.inline(F.array(F.struct(*need)))))

    # ------------------------------------------------------------------
    def _undeclared(self, parts: list[str], base: T.DataType, at: Column | None, like: Any) -> tuple[Column, T.DataType, bool] | None:
        """An undeclared field from the VARIANT of the innermost level that has one, read as the type of ``like``.

        ``at`` is the element that ``parts`` start from (None: the row)."""
        kind = (T.BooleanType() if isinstance(like, bool) else T.DoubleType() if isinstance(like, (int, float))
                else T.TimestampType() if isinstance(like, (date, datetime)) else T.StringType())
        for cut in range(len(parts) - 1, -1, -1):
            walked = _walk_type(base, parts[:cut])
            if walked is None:
                continue
            dt, crossed = walked
            while isinstance(dt, T.ArrayType):
                dt, crossed = dt.elementType, True
            if not isinstance(dt, T.StructType) or MORE not in dt.fieldNames() or not isinstance(dt[MORE].dataType, T.VariantType):
                continue
            rest = "$" + "".join(f"['{p}']" for p in parts[cut:])
            names = [*parts[:cut], MORE]
            value = at
            for n in names if at is not None else ():
                value = value.getField(n)
            value = F.col(".".join(f"`{n}`" for n in names)) if at is None else value
            if crossed:
                return F.transform(value, lambda x: F.try_variant_get(x, rest, kind.simpleString())), T.ArrayType(kind), True
            return F.try_variant_get(value, rest, kind.simpleString()), kind, False
        return None

    def field(self, path: str, element: Column | None = None, element_path: str | None = None, like: Any = None) -> ResolvedField:
        """Resolve a dotted field path (optionally relative to a nested element).

        ``like`` is a value that the field is compared with; it gives the type of fields that no mapping declares
        and no column holds."""
        col_parts, spec, sub = self.mapping.resolve(path)
        if element is not None:
            prefix = element_path.split(".")
            rel = path.split(".")
            if rel[: len(prefix)] != prefix:
                raise ValueError(f"{path} is not inside nested path {element_path}")
            inner = rel[len(prefix):]
            if sub is not None:
                inner = inner[:-1]
            base_type = _walk_type(self.df.schema, prefix)
            elem_type = base_type[0].elementType if base_type else None
            walked = _walk_type(elem_type, inner) if elem_type is not None else None
            more = self._undeclared(inner, elem_type, element, like) if walked is None and elem_type is not None else None
            if walked is None and more is None:
                raise ValueError(f"unknown field {path}")
            if more is None:
                dt, crossed = walked
                value = element
                for p in inner:
                    value = value.getField(p)
        else:
            walked = _walk_type(self.df.schema, col_parts)
            more = self._undeclared(col_parts, self.df.schema, None, like) if walked is None else None
            if walked is None and more is None:
                raise ValueError(f"unknown field {path}")
            if more is None:
                dt, crossed = walked
                value = F.col(".".join(f"`{p}`" for p in col_parts))
        if more is not None:
            value, dt, crossed = more
        elif crossed:
            # a path through an array of structs reads an array of leaf values
            if isinstance(dt, T.ArrayType):
                value = F.flatten(value)
            else:
                dt = T.ArrayType(dt)
        if spec is None:
            if self.mapping.policy_at(path.split(".")) is False and self.mapping.properties:
                raise ValueError(f"field {path} is not searchable (dynamic: false, not declared)")
            from .mapping import _infer_spec
            spec = _infer_spec(path.rsplit(".", 1)[-1], dt, set(), "date")
        is_array = crossed or isinstance(dt, T.ArrayType)
        if not spec.index and element is None:
            raise ValueError(f"field {path} is not searchable (index: false)")
        tokens = None
        if spec.is_text:
            stored = token_column_name(path)
            if element is None and stored in self.df.columns:
                tokens = F.col(stored)
            else:
                an = self.analyzers.get(spec.analyzer)
                if is_array:
                    tokens = F.flatten(F.transform(value, lambda x: F.coalesce(
                        an.column(x), F.array().cast("array<string>"))))
                else:
                    tokens = an.column(value)
        return ResolvedField(path, spec, value, dt, is_array, tokens,
                             spec.search_analyzer or spec.analyzer)
