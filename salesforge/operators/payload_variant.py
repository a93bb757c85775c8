"""The dashboard payload read as VARIANT: no declared schema, so unknown keys come through instead of being lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PAYLOAD_SCHEMA

KPI_FIELDS = PAYLOAD_SCHEMA["kpi"].dataType.fieldNames()
_LABEL_KEYS = ["sku", "month", "channel", "region", "day"]


def payload_series_variant(payload: DataFrame) -> DataFrame:
    """``payload_series`` from VARIANT: (series, pos, sub_pos, label, sub_label, value).

    What a key holds decides how it is read: an array of objects is a series, an object of arrays a drill-down, an object
    of numbers a set of figures, a number a figure.  So further series, figures and fields need no change here; keys of
    text are left out.  Text that is no JSON gives no rows.
    """
    spark = payload.sparkSession
    # materialised once a row: every series is exploded from the parsed value
    parsed = payload.select(F.try_parse_json("payload").alias("doc")).where(F.col("doc").isNotNull())
    tops = spark.sql("SELECT t.key AS series, t.value AS held, schema_of_variant(t.value) AS kind "
                     "FROM {docs}, LATERAL variant_explode(doc) t", docs=parsed)
    label = "coalesce(" + ", ".join(f"try_variant_get(e.value, '$.{k}', 'string')" for k in _LABEL_KEYS) + ")"
    category, revenue = "try_variant_get(e.value, '$.category', 'string')", "try_variant_get(e.value, '$.revenue', 'double')"
    none_text, none_pos = "CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)"
    place = "array_position(array(" + ", ".join(f"'{f}'" for f in KPI_FIELDS) + "), e.key)"
    return spark.sql(f"""
        SELECT series, CAST(e.pos AS BIGINT) AS pos, {none_pos} AS sub_pos, {label} AS label, {category} AS sub_label,
               {revenue} AS value
        FROM {{tops}}, LATERAL variant_explode(held) e WHERE kind LIKE 'ARRAY<OBJECT%'
        UNION ALL
        SELECT series, CAST(g.pos AS BIGINT), CAST(e.pos AS BIGINT), g.key, {category}, {revenue}
        FROM {{tops}}, LATERAL variant_explode(held) g, LATERAL variant_explode(g.value) e
        WHERE kind LIKE 'OBJECT<%' AND schema_of_variant(g.value) LIKE 'ARRAY%'
        UNION ALL
        SELECT series, CASE WHEN {place} > 0 THEN {place} - 1 ELSE {len(KPI_FIELDS)} + e.pos END, {none_pos}, e.key,
               {none_text}, try_variant_get(e.value, '$', 'double')
        FROM {{tops}}, LATERAL variant_explode(held) e
        WHERE kind LIKE 'OBJECT<%' AND try_variant_get(e.value, '$', 'double') IS NOT NULL
        UNION ALL
        SELECT series, 0, {none_pos}, {none_text}, {none_text}, try_variant_get(held, '$', 'double')
        FROM {{tops}} WHERE NOT kind LIKE 'ARRAY%' AND NOT kind LIKE 'OBJECT%'
          AND try_variant_get(held, '$', 'double') IS NOT NULL""", tops=tops)
