"""Landed JSON pages -> records with technical columns.

A page row has ``run_id, catmat, extract_type, page, endpoint, body``; ``body``
is the response text. Bodies are parsed once, into a variant, and the parsed pages
are a written table that all readers share.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..fixed_values import PAGE_INFO_KEYS, RECORD_KEYS, SOURCE_LABEL, TOTAL_PAGE_KEYS
from ..functions.scalars import local_text
from ..operators.hashes import variant_hash
from ..staging import stage

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("catmat", T.StringType()),
        T.StructField("extract_type", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

# Objects inside objects are searched this deep by one expression; deeper pages are
# walked level by level.
ENVELOPE_DEPTH = 3
# Stands for the records of a page that is too deep; records are never null.
_TOO_DEEP = "null"

_OBJECT = "map<string,variant>"
_LIST = "array<variant>"


def _as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", _OBJECT)


def _as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", _LIST)


def _is_object(value: Column) -> Column:
    """Whether a value is an object; none of its fields is looked at."""
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def _objects_of(value: Column) -> Column:
    """The objects in a list; null when ``value`` is no list."""
    return F.filter(_as_list(value), _is_object)


def _first_of(arrays: Column) -> Column:
    return F.try_element_at(F.filter(arrays, lambda a: a.isNotNull()), F.lit(1))


def _record_values(fields: Column) -> Column:
    """Values under the record keys in order of preference; null if absent."""
    keys = F.array(*[F.lit(k) for k in RECORD_KEYS])
    return F.transform(keys, lambda key: F.try_element_at(fields, key))


def _from_object(value: Column, depth: int) -> Column:
    """Records of an object; null when it has none or ``value`` is no object.

    The first record key decides whose value is a list, even an empty one, or an
    object that has records. Otherwise an object without nested values is a record.
    """

    def from_value(v: Column) -> Column:
        if depth:
            return F.coalesce(_objects_of(v), _from_object(v, depth - 1))
        marker = F.array(F.parse_json(F.lit(_TOO_DEEP)))
        return F.coalesce(_objects_of(v), F.when(_is_object(v), marker))

    def from_fields(fields: Column) -> Column:
        found = F.transform(
            _record_values(fields),
            lambda v: F.struct(_as_list(v).isNotNull().alias("direct"), from_value(v).alias("records")),
        )
        # A list decides even when it is empty, an object only by having records.
        usable = F.filter(found, lambda x: x["records"].isNotNull() & (x["direct"] | (F.size(x["records"]) > 0)))
        nested = F.try_element_at(usable, F.lit(1))["records"]
        plain = F.forall(
            F.map_values(fields),
            lambda v: ~_is_object(v) & _as_list(v).isNull(),
        )
        return F.coalesce(nested, F.when(plain & (F.size(fields) > 0), F.array(value)))

    # A one-element array names the cast, so that it is written once.
    return _first_of(
        F.transform(
            F.filter(F.array(_as_object(value)), lambda fields: fields.isNotNull()), from_fields
        )
    )


def page_records(body: Column, depth: int = ENVELOPE_DEPTH) -> Column:
    """Array of the record variants of a parsed page; empty when it has none."""
    none = F.array().cast(_LIST)
    return F.coalesce(_objects_of(body), _from_object(body, depth), none)


def total_pages(body: Column) -> Column:
    """The page count a page declares, itself or in a page-info object."""
    paths = [f"$.{k}" for k in TOTAL_PAGE_KEYS]
    paths += [f"$.{info}.{k}" for info in PAGE_INFO_KEYS for k in TOTAL_PAGE_KEYS]
    return F.coalesce(*[F.try_variant_get(body, path, "int") for path in paths])


def parsed_pages(pages: DataFrame, depth: int = ENVELOPE_DEPTH) -> DataFrame:
    """The first pass: pages with ``records``, ``declared_pages`` and a
    ``reject_reason``, TOO_DEEP where ``settled_pages`` has to go on; only pages with
    a reason keep their ``body``."""
    parsed = pages.withColumn("__body", F.try_parse_json("body"))
    body = F.col("__body")
    searched = parsed.withColumns({"__found": page_records(body, depth), "declared_pages": total_pages(body)})
    too_deep = F.exists("__found", F.is_variant_null)
    marked = searched.withColumns(
        {
            "records": F.filter("__found", lambda r: ~F.is_variant_null(r)),
            "reject_reason": F.when(body.isNull(), "NOT_JSON").when(too_deep, "TOO_DEEP"),
        }
    )
    kept = F.when(F.col("reject_reason").isNotNull(), F.col("body"))
    return stage(marked.withColumn("body", kept).drop("__body", "__found"), "pages")


def _walked(deep: DataFrame) -> DataFrame:
    """``__row`` and ``records`` of pages, one level of objects per written pass.

    A list under a record key decides for its object, so later keys are not walked. The
    first records in the order of keys are the page's; empty ones give way to others.
    """
    level = stage(
        deep.select("__row", F.expr("array() :: array<int>").alias("__path"), F.parse_json("body").alias("__value")),
        "page-level",
    )
    found = []
    while not level.isEmpty():
        fields = _as_object(F.col("__value"))
        nested = lambda v: _is_object(v) | _as_list(v).isNotNull()
        plain = (F.size(fields) > 0) & ~F.exists(F.map_values(fields), nested)
        own = level.where(plain).select("__row", "__path", F.array("__value").alias("records"))
        values = _record_values(fields)
        lists_at = F.array_position(F.transform(values, lambda v: _as_list(v).isNotNull()), True)  # from 1; 0 for none
        upto = F.when(lists_at > 0, F.slice(values, 1, lists_at.cast("int"))).otherwise(values)
        tried = level.select("__row", "__path", F.posexplode(upto).alias("__at", "__value"))
        path = F.concat("__path", F.array("__at")).alias("__path")
        lists = tried.select("__row", path, _objects_of(F.col("__value")).alias("records")).where(F.size("records") > 0)
        found.append(stage(own.unionByName(lists), "page-records"))
        level = stage(
            tried.where(_is_object(F.col("__value"))).select("__row", path, "__value"), "page-level"
        )
    return reduce(DataFrame.unionByName, found).groupBy("__row").agg(F.min_by("records", "__path").alias("records"))


def settled_pages(pages: DataFrame) -> DataFrame:
    """``parsed_pages`` with the records of pages of any depth."""
    first = parsed_pages(pages)
    too_deep = F.coalesce(F.col("reject_reason") == "TOO_DEEP", F.lit(False))
    if first.where(too_deep).isEmpty():
        return first
    deep = stage(first.where(too_deep).drop("records").withColumn("__row", F.monotonically_increasing_id()), "deep-pages")
    none = F.array().cast(_LIST)
    settled = deep.join(_walked(deep), "__row", "left").withColumns(
        {"records": F.coalesce("records", none), "body": F.lit(None).cast("string"), "reject_reason": F.lit(None).cast("string")}
    )
    return first.where(~too_deep).unionByName(stage(settled.select(*first.columns), "pages"))


def _parsed(pages: DataFrame) -> DataFrame:
    return pages if "reject_reason" in pages.columns else settled_pages(pages)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that could not be read, with the reason; the others go on. Takes
    landed pages, or those of ``settled_pages``."""
    return _parsed(pages).filter("reject_reason IS NOT NULL").drop("records", "declared_pages")


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per record: the page's columns, ``position`` and ``record``.

    Takes landed pages, or those of ``settled_pages``. Rejected pages have no records.
    """
    keys = [c for c in pages.columns if c not in ("body", "records", "declared_pages", "reject_reason")]
    return _parsed(pages).select(*keys, F.posexplode("records").alias("position", "record"))


def with_metadata(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add the eight technical columns to rows of ``page_rows``.

    The hash covers the source record alone, before anything is added to it.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return records.select(
        "record",
        stamp.alias("_ingestion_timestamp"),
        F.lit(SOURCE_LABEL).alias("_source"),
        F.col("endpoint").alias("_source_endpoint"),
        F.col("run_id").alias("_pipeline_run_id"),
        F.upper("extract_type").alias("_extract_type"),
        F.col("page").alias("_page"),
        F.col("catmat").alias("_catmat"),
        variant_hash(F.col("record")).alias("_record_hash"),
    )


def _stable(kind: T.DataType) -> T.DataType | None:
    """A type that does not depend on one load's values: numbers are doubles; what
    has only been seen as null or empty has none."""
    if isinstance(kind, T.NumericType):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.ArrayType):
        item = _stable(kind.elementType)
        return None if item is None else T.ArrayType(item)
    if isinstance(kind, T.StructType):
        fields = [(f.name, _stable(f.dataType)) for f in kind.fields]
        fields = [T.StructField(name, found) for name, found in fields if found is not None]
        return T.StructType(fields) if fields else None
    return kind


def infer_record_schema(records: DataFrame, column: str = "record") -> T.StructType:
    """The union of all records' fields, merged by Spark in one aggregate, in types
    that stay the same from load to load."""
    found = records.agg(F.schema_of_variant_agg(column)).first()[0] or "VOID"
    kind = _stable(T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found)))
    return kind if isinstance(kind, T.StructType) else T.StructType([])


def _mixed_text(value: Column) -> Column:
    """Text of a field that has values of several kinds within one load."""
    number = F.schema_of_variant(value).rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
    text = F.try_variant_get(value, "$", "string")
    return F.when(number, local_text(F.try_variant_get(value, "$", "double"))).otherwise(text)


def flat_columns(schema: T.StructType, root: str) -> list[Column]:
    """Columns of a struct with nested fields as ``a__b``; lists stay lists."""

    def walk(struct: T.StructType, path: Column, name: str) -> list[Column]:
        columns = []
        for field in struct.fields:
            inner, label = path.getField(field.name), f"{name}{field.name}"
            if isinstance(field.dataType, T.StructType) and field.dataType.fields:
                columns += walk(field.dataType, inner, f"{label}__")
            elif isinstance(field.dataType, T.VariantType):
                columns.append(_mixed_text(inner).alias(label))
            else:
                columns.append(inner.alias(label))
        return columns

    return walk(schema, F.col(root), "")


def flatten_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Turn ``record`` into typed, flattened columns; technical columns stay."""
    shape = schema or infer_record_schema(records)
    rest = [c for c in records.columns if c != "record"]
    if not shape.fields:
        return records.select(*rest)
    typed = records.withColumn("record", F.try_variant_get("record", "$", shape.simpleString()))
    return typed.select(*flat_columns(shape, "record"), *rest)


def bronze_records(
    pages: DataFrame, schema: T.StructType | None = None, ingested_at: Column | None = None
) -> DataFrame:
    """Landed or parsed pages -> flattened source fields plus technical columns."""
    return flatten_records(with_metadata(page_rows(pages), ingested_at), schema)
