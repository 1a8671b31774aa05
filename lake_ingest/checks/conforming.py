"""Type conversion, missing values, quarantine, profiles and expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lake_ingest.checks.registry import query, scratch, table
from lake_ingest.operators import conform, profiling, sketches

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)


@query(
    "convert_types",
    """SELECT l_orderkey, l_partkey, l_suppkey,
           CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN l_linenumber END AS l_linenumber,
           CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem""",
)
def convert_types(spark, sf_dir):
    """Order lines as text, some numbers spoilt, converted to the declared types."""
    lines = table(spark, sf_dir, "lineitem")
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in lines.columns])
    spoilt = text.withColumns(
        {
            "l_quantity": F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_quantity")),
            "l_linenumber": F.when(
                (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.col("l_linenumber")
            ).otherwise(F.concat(F.lit("no. "), "l_linenumber")),
        }
    )
    return conform.convert_types(spoilt, LINEITEM)


@query(
    "missing_values",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN 'unknown' ELSE event_type END AS event_type,
           CASE WHEN value >= 1 THEN value ELSE 0.0 END AS value,
           CASE WHEN value <= 50 THEN props END AS props
    FROM events""",
)
def missing_values(spark, sf_dir):
    """Null tokens, blanks and NaN in place of some values."""
    kind, value = F.col("event_type"), F.col("value")
    gaps = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", " N/A ").when(kind == "view", "  ").when(kind == "error", "null").otherwise(kind).alias("event_type"),
        F.when(value < 1, F.lit(float("nan"))).otherwise(value).alias("value"),
        F.when(value > 50, "None").otherwise(F.col("props")).alias("props"),
    )
    return conform.missing_values(gaps, defaults={"event_type": "unknown", "value": 0.0})


def _event_records(spark, sf_dir):
    """Events as text records; a small value spoils ``k``, an error event the time."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.when(F.col("event_type") == "error", "yesterday").otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(F.col("value") < 1, "n/k").otherwise(F.get_json_object("props", "$.k")).alias("k"),
    )


EVENT_RECORD = "event_id bigint, event_type string, ts timestamp_ntz, k int"


@query(
    "quarantine",
    """SELECT event_id, event_type,
           CASE WHEN event_type <> 'error' AND value >= 1 THEN ts END AS ts,
           CASE WHEN event_type <> 'error' AND value >= 1 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
           concat_ws(',', CASE WHEN event_type = 'error' THEN 'ts' END, CASE WHEN value < 1 THEN 'k' END) AS rejected
    FROM events""",
)
def quarantine(spark, sf_dir):
    """Converted good rows, and for the rejected ones the columns at fault."""
    good, rejected = conform.quarantine(_event_records(spark, sf_dir), EVENT_RECORD)
    faults = rejected.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("int").alias("k"),
        F.array_join(conform.REJECTED, ",").alias("rejected"),
    )
    return good.withColumn("rejected", F.lit("")).unionByName(faults)


def _spoilt_orders(spark, sf_dir):
    """Orders as a loader of text files would see them, with typical defects."""
    price = F.col("o_totalprice").cast("string")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_custkey",
        F.when(status == "F", "unknown").otherwise(price).alias("price"),
        F.when(status == "P", None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
        F.lit("import").alias("origin"),
        F.lit(None).cast("string").alias("remark"),
    )


SPOILT_ORDERS_SQL = """
spoilt AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE CAST(o_totalprice AS VARCHAR) END AS price,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, 'import' AS origin,
         CAST(NULL AS VARCHAR) AS remark
  FROM orders)"""

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _profile_sql(columns):
    """Profile of text columns, and of one numeric one, column by column."""
    parts = []
    for name, kind, inferred in columns:
        numeric = (
            f"count(*) FILTER (WHERE regexp_matches({name}, '{_NUMBER}'))"
            if kind == "string"
            else f"count({name})"
        )
        parts.append(
            f"""SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS "rows",
              count({name}) AS non_null, 1 - count({name}) / count(*) AS null_ratio,
              count(DISTINCT {name}) AS distinct_count, CAST(min({name}) AS VARCHAR) AS min_value,
              CAST(max({name}) AS VARCHAR) AS max_value, {numeric} AS numeric_count,
              '{inferred}' AS inferred_type FROM spoilt"""
        )
    return f"profile AS ({' UNION ALL '.join(parts)})"


SPOILT_PROFILE_SQL = f"""{SPOILT_ORDERS_SQL}, {_profile_sql([
    ("o_orderkey", "string", "bigint"),
    ("o_custkey", "bigint", "bigint"),
    ("price", "string", "string"),
    ("priority", "string", "string"),
    ("o_orderdate", "string", "date"),
    ("origin", "string", "string"),
    ("remark", "string", "string"),
])}"""


@query("column_profile", f"WITH {SPOILT_PROFILE_SQL} SELECT * FROM profile")
def column_profile(spark, sf_dir):
    return profiling.column_profile(_spoilt_orders(spark, sf_dir), exact_distinct=True)


@query(
    "column_profile_sketch",
    f"""WITH {SPOILT_PROFILE_SQL}
    SELECT column_name, "rows", non_null, min_value, max_value, numeric_count, inferred_type, TRUE AS distinct_is_close
    FROM profile""",
)
def column_profile_sketch(spark, sf_dir):
    """The default profile, in one scan; its estimate of distinct values lies within a tenth of the exact one."""
    orders = _spoilt_orders(spark, sf_dir)
    exact = profiling.column_profile(orders, exact_distinct=True).select(
        "column_name", F.col("distinct_count").alias("exact")
    )
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.1 * F.col("exact")
    return profiling.column_profile(orders).join(exact, "column_name").select(
        "column_name", "rows", "non_null", "min_value", "max_value", "numeric_count", "inferred_type",
        close.alias("distinct_is_close"),
    )


@query(
    "profile_findings",
    f"""WITH {SPOILT_PROFILE_SQL}
    SELECT column_name, 'all_null' AS finding, 'no value present' AS detail FROM profile WHERE non_null = 0
    UNION ALL SELECT column_name, 'constant', 'always ' || min_value FROM profile WHERE distinct_count = 1
    UNION ALL SELECT column_name, 'mixed_types', numeric_count || ' numeric, ' || (non_null - numeric_count) || ' other'
      FROM profile WHERE data_type = 'string' AND numeric_count > 0 AND numeric_count < non_null
    UNION ALL SELECT column_name, 'missing_values', ("rows" - non_null) || ' of ' || "rows" || ' missing'
      FROM profile WHERE non_null > 0 AND non_null < "rows"
    UNION ALL SELECT column_name, 'stored_as_text', 'every value reads as ' || inferred_type
      FROM profile WHERE data_type = 'string' AND inferred_type <> 'string'""",
)
def profile_findings(spark, sf_dir):
    profile = profiling.column_profile(_spoilt_orders(spark, sf_dir), exact_distinct=True)
    return profiling.profile_findings(profile)


@query(
    "column_dictionary",
    f"""WITH {SPOILT_PROFILE_SQL}, names AS (
      SELECT unnest(['o_orderkey', 'o_custkey', 'price', 'priority', 'o_orderdate', 'origin', 'remark']) AS column_name,
             unnest(range(7)) AS position, unnest([TRUE, TRUE, TRUE, TRUE, TRUE, FALSE, TRUE]) AS nullable)
    SELECT n.column_name, CAST(n.position AS INTEGER) AS position, p.data_type, n.nullable, p.non_null,
           p.distinct_count, p.min_value, p.max_value, d.description, d.description IS NOT NULL AS described
    FROM names n JOIN profile p USING (column_name)
    LEFT JOIN (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'priority' WHEN '2-HIGH' THEN 'price' END AS column_name,
                      min('as in ' || o_orderpriority) AS description
               FROM orders GROUP BY 1) d USING (column_name)""",
)
def column_dictionary(spark, sf_dir):
    """Descriptions come from a table; columns it does not name stay undescribed."""
    priority = F.col("o_orderpriority")
    named = F.when(priority == "1-URGENT", "priority").when(priority == "2-HIGH", "price")
    descriptions = (
        table(spark, sf_dir, "orders")
        .groupBy(named.alias("column_name"))
        .agg(F.min(F.concat(F.lit("as in "), priority)).alias("description"))
    )
    orders = _spoilt_orders(spark, sf_dir)
    profile = profiling.column_profile(orders, exact_distinct=True)
    return profiling.column_dictionary(orders, profile, descriptions)


@query(
    "expectations",
    """WITH failures AS (
      SELECT count(*) AS n,
             count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 50)) AS quantity,
             count(*) FILTER (WHERE NOT (l_discount <= 0.05)) AS discount,
             count(*) FILTER (WHERE NOT (l_returnflag IN ('A', 'R'))) AS flag,
             count(*) FILTER (WHERE NOT (l_extendedprice >= l_quantity)) AS price,
             count(*) FILTER (WHERE NOT (nullif(l_tax, 0) > 0.02)) AS tax
      FROM lineitem)
    SELECT rule, n AS "rows", failed, failed = 0 AS passed
    FROM failures, LATERAL (VALUES ('quantity', quantity), ('discount', discount), ('flag', flag),
                                   ('price', price), ('tax', tax)) v(rule, failed)""",
)
def expectations(spark, sf_dir):
    rules = [
        profiling.Expectation("quantity", "l_quantity BETWEEN 1 AND 50"),
        profiling.Expectation("discount", "l_discount <= 0.05"),
        profiling.Expectation("flag", F.col("l_returnflag").isin("A", "R")),
        profiling.Expectation("price", "l_extendedprice >= l_quantity"),
        profiling.Expectation("tax", "nullif(l_tax, 0) > 0.02"),
    ]
    return profiling.check_expectations(table(spark, sf_dir, "lineitem"), rules)


# Columns of order lines whose profile is merged from batches.
_MERGED = ("l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


@query(
    "merged_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null,
            {f"strftime(min({c}), '%Y-%m-%d %H:%M:%S')" if c == "l_shipdate" else f"CAST(min({c}) AS DOUBLE)::VARCHAR" if c != "l_returnflag" else f"min({c})"} AS min_value,
            TRUE AS distinct_within, TRUE AS quartiles_within, TRUE AS frequent_within FROM lineitem"""
        for c in _MERGED
    ),
)
def merged_profile(spark, sf_dir):
    """Profile of order lines from the sketches of seven batches, within the sketches' bounds of the exact figures."""
    lines, place = table(spark, sf_dir, "lineitem").select("l_orderkey", *_MERGED), f"{scratch(spark)}/sketches"
    for batch in range(7):
        sketches.store_sketches(lines.where(F.col("l_orderkey") % 7 == batch), place, f"b{batch}", _MERGED)
    found = sketches.table_profile(spark, place, 1)
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"), (F.col(c).cast("double") if c[2:] in ("partkey", "quantity", "extendedprice") else F.lit(None).cast("double")).alias("x")) for c in _MERGED)))
    values = lines.select(cells.alias("c")).select("c.*").groupBy("column_name", "v", "x").agg(F.count("*").alias("n"))
    # Of every value how many rows lie below it: where an estimated quartile belongs.
    compared = values.join(found.select("column_name", F.posexplode_outer("quantiles").alias("at", "q")), "column_name")
    ranks = compared.groupBy("column_name", "at").agg(
        F.sum(F.when(F.col("x") < F.col("q"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("q"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("n"),
    )
    want = (F.col("at") + 1) * 0.25 * F.col("n")
    quartiles = ranks.groupBy("column_name").agg(
        F.bool_and(
            F.col("at").isNull() | ((F.col("below") <= want + 0.03 * F.col("n")) & (F.col("upto") >= want - 0.03 * F.col("n")))
        ).alias("quartiles_within")
    )
    exact = values.groupBy("column_name").agg(F.count("v").alias("distinct"), F.max("n").alias("most"), F.sum("n").alias("n"))
    item = F.get("frequent", F.lit(0))
    top = values.select("column_name", F.col("v").alias("_v"), F.col("n").alias("_n"))
    return (
        found.withColumns({"_v": item["item"], "_count": item["count"]})
        .join(exact, "column_name")
        .join(quartiles, "column_name")
        .join(top, ["column_name", "_v"], "left")
        .select(
            "column_name",
            "rows",
            "non_null",
            "min_value",
            (F.abs(F.col("distinct_count") - F.col("distinct")) <= F.lit(0.06) * F.col("distinct")).alias("distinct_within"),
            "quartiles_within",
            # A tracked value's count is at most a share of the rows off, and none is more frequent by more.
            F.coalesce(
                (F.col("_n") >= F.col("most") - 0.01 * F.col("n")) & (F.abs(F.col("_count") - F.col("_n")) <= 0.01 * F.col("n")),
                F.col("most") <= 0.01 * F.col("n"),
            ).alias("frequent_within"),
        )
    )
