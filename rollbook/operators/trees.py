"""Rows out of nested values."""

from pyspark.sql import functions as F


def explode_sic(df, number="number", cols=("sic_text_1", "sic_text_2", "sic_text_3", "sic_text_4")):
    """(company_number, sic_code) for each text that starts with a five-digit code."""
    return (
        df.select(F.col(number).alias("company_number"), F.explode(F.array(*cols)).alias("_text"))
        .select("company_number", F.regexp_extract("_text", "^[0-9]{5}", 0).alias("sic_code"))
        .filter(F.col("sic_code") != "")
        .distinct()
    )


def flatten_tree(df, col, keep=()):
    """All concepts of the trees in a JSON column, whatever their depth, as (name, label).

    A node is ``[kind, {name, label}, {...}, child, child, ...]``, so children start at
    position 3. Each round of the recursion goes one level down for all trees at once.
    """
    spark = df.sparkSession
    # the number of rows and levels is that of the data, not a fixed one
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "-1")
    kept = "".join(f"{c}, " for c in keep)
    return spark.sql(
        f"""
        WITH RECURSIVE concepts AS (
            SELECT {kept} child.value AS node, 1 AS level
            FROM {{trees}},
                 LATERAL variant_explode(variant_get(parse_json({col}), '$.dimensions')) AS role,
                 LATERAL variant_explode(role.value) AS child
            WHERE child.pos >= 3
            UNION ALL
            SELECT {kept} child.value AS node, level + 1 AS level
            FROM concepts, LATERAL variant_explode(node) AS child
            WHERE child.pos >= 3
        )
        SELECT {kept} level,
               regexp_replace(variant_get(node, '$[1].name', 'string'), '^.*:', '') AS name,
               variant_get(node, '$[1].label', 'string') AS label
        FROM concepts
        """,
        trees=df,
    )
