"""Object names listed in run manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..settings import DataQualityError
from ..staging import stage

# Names that one task puts in order.
_TASK_NAMES = 500_000


def _named(objects: Column) -> Column:
    """Names in an ``objects`` list: texts, or objects with ``object_name``."""
    items = F.try_variant_get(objects, "$", "array<variant>")

    def name(item: Column) -> Column:
        is_text = F.schema_of_variant(item) == "STRING"
        return F.coalesce(
            F.try_variant_get(item, "$.object_name", "string"),
            F.when(is_text, F.try_variant_get(item, "$", "string")),
        )

    return F.filter(F.transform(items, name), lambda n: n.isNotNull() & (n != ""))


def _children(level: DataFrame, items: Column) -> DataFrame:
    """The next level's results, each with its path."""
    found = level.select("__row", "__path", F.posexplode(items).alias("__at", "__result"))
    return found.select("__row", F.concat("__path", F.array("__at")).alias("__path"), "__result")


def manifest_objects(manifests: DataFrame, column: str = "manifest") -> DataFrame:
    """Distinct object names per manifest row, in order of first mention.

    ``manifest`` is JSON text: one result, or a list of results. Nested results
    are walked level by level until none is left, whatever their depth. A name's
    path gives its place: own objects (-1) come before nested results.
    """
    keys = [c for c in manifests.columns if c != column]
    rows = stage(
        manifests.select(
            F.struct(*[F.col(k) for k in keys]).alias("__row"),
            F.expr("array() :: array<int>").alias("__path"),
            F.try_parse_json(column).alias("__json"),
        ),
        "manifests",
    )
    items = F.coalesce(F.try_variant_get("__json", "$", "array<variant>"), F.array("__json"))
    level, found = stage(_children(rows, items), "manifest-level"), []
    while not level.isEmpty():
        own = _named(F.try_variant_get("__result", "$.objects", "variant"))
        names = level.select("__row", "__path", F.posexplode(own).alias("__at", "object_name"))
        place = F.concat("__path", F.array(F.lit(-1), "__at"))
        found.append(names.select("__row", place.alias("__path"), "object_name"))
        nested = F.try_variant_get("__result", "$.results", "array<variant>")
        level = stage(_children(level, nested), "manifest-level")
    if not found:
        none = rows.limit(0).select("__row", F.lit("").alias("object_name"), F.lit(0).alias("position"))
        return none.select("__row.*", "object_name", "position")
    mentions = stage(reduce(DataFrame.unionByName, found), "manifest-names")
    # Packed names say little about the memory it takes to sort them, so they are counted.
    mentions = mentions.repartition(-(-mentions.count() // _TASK_NAMES) or 1, "__row")
    order = Window.partitionBy("__row").orderBy("__path")  # the names of one manifest
    placed = mentions.withColumn("__n", F.row_number().over(order) - 1)
    first = placed.groupBy("__row", "object_name").agg(F.min("__n").alias("position"))
    return first.select("__row.*", "object_name", "position")


def require_objects(objects: DataFrame) -> DataFrame:
    if objects.isEmpty():
        raise DataQualityError("the manifest names no objects")
    return objects
