"""Snapshots whose fields drift: the declared schema enforced, and nothing lost of what does not fit.

Lines of JSON are read as the schema says. Fields that it does not declare, and
values that do not fit its types, are kept as they came in a ``REST`` column of type
VARIANT next to the typed ones; a line that is no object is kept as text. What
drifted is counted by field and type, and a field that turns out to be there to stay
can be promoted from what was kept, without reading a snapshot again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REST, BROKEN = "_rest", "_broken"
UNDECLARED, ILL_TYPED, BROKEN_LINE = "undeclared", "ill-typed", "broken"
FIELDS = "map<string,variant>"


def _typed(value: Column, kind: T.DataType) -> Column:
    return F.try_variant_get(value, "$", kind.simpleString())


def conformed(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """A column of JSON text as the columns of ``schema``, ``REST`` and ``BROKEN``; a row per line.

    A value fits if it can be cast to the declared type, as a quoted number can; a JSON null fits every type.
    ``REST`` is null where everything fits; ``BROKEN`` holds a line that is no JSON object.
    Of a name that comes twice the parser says which counts.
    """
    read = lines.select(F.col(line).alias("_line"), F.from_json(line, FIELDS).alias("_fields"))
    fields = F.col("_fields")
    value = {f.name: F.try_element_at(fields, F.lit(f.name)) for f in schema}
    typed = {f.name: _typed(value[f.name], f.dataType) for f in schema}
    # Looked at once a row: inside the filter below it would be once for every field.
    ill = [
        F.when(
            value[c].isNotNull() & (F.schema_of_variant(value[c]) != "VOID") & typed[c].isNull(),
            F.struct(F.lit(c).alias("key"), value[c].alias("value")),
        )
        for c in typed
    ]
    declared = F.array(*[F.lit(c) for c in typed])
    undeclared = F.map_filter(fields, lambda k, _: ~F.array_contains(declared, k))
    kept = F.map_concat(undeclared, F.map_from_entries(F.array_compact(F.array(*ill)))) if ill else undeclared
    rest = F.when(F.size(kept) > 0, F.parse_json(F.to_json(kept)))
    broken = F.when(fields.isNull() & (F.trim("_line") != ""), F.col("_line"))
    return read.select(*[typed[c].alias(c) for c in typed], rest.alias(REST), broken.alias(BROKEN))


def read_drifting(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON lines below ``path``, see ``conformed``."""
    return conformed(spark.read.text(path), schema)


def drift_report(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """field, kind, seen_type, row_count of what does not fit ``schema``; broken lines have no field. Empty if all fits.

    Only what was kept is looked at, so the report follows the drift, not the snapshot. One pass; there is no
    filter on what was kept, for below ``conformed`` it would parse a line once for every mention of its fields.
    """
    names, none = [f.name for f in schema], F.lit(None).cast("string")

    def entry(field: Column, kind: Column, seen: Column) -> Column:
        return F.struct(field.alias("field"), kind.alias("kind"), seen.alias("seen_type"))

    def seen(pair: Column) -> Column:
        kind = F.when(pair["key"].isin(names), ILL_TYPED).otherwise(UNDECLARED)
        return entry(pair["key"], kind, F.schema_of_variant(pair["value"]))

    fields = F.transform(F.map_entries(F.from_json(F.to_json(REST), FIELDS)), seen)
    broken = F.when(F.col(BROKEN).isNotNull(), F.array(entry(none, F.lit(BROKEN_LINE), none)))
    both = rows.select(F.inline(F.concat(F.coalesce(fields, F.array()), F.coalesce(broken, F.array()))))
    return both.groupBy("field", "kind", "seen_type").agg(F.count(F.lit(1)).alias("row_count"))


def promote(rows: DataFrame, field: str, kind: T.DataType) -> DataFrame:
    """``rows`` with a kept field as a column of its own; values that fit leave ``REST``, others stay in it."""
    fields = F.from_json(F.to_json(REST), FIELDS)
    value = F.try_element_at(fields, F.lit(field))
    typed = _typed(value, kind)
    fits = typed.isNotNull() | (F.schema_of_variant(value) == "VOID")
    left = F.map_filter(fields, lambda k, _: (k != field) | ~F.coalesce(fits, F.lit(False)))
    rest = F.when(F.size(left) > 0, F.parse_json(F.to_json(left)))
    old = F.col(field) if field in rows.columns else F.lit(None)
    others = [c for c in rows.columns if c not in (field, REST, BROKEN)]
    return rows.select(*others, F.coalesce(old.cast(kind), typed).alias(field), rest.alias(REST), BROKEN)
