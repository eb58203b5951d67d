"""Queries over whole tables, each with the DuckDB SQL that must give the same rows.

``QUERIES`` maps a name to a function of session and data folder, ``ORACLE`` maps names to SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import boosting, clean, impute, keys, ledger, metrics, scoring, split
from millrace.operators.features import FEATURES, feature_stages, predict
from millrace.plans import pipelines
from millrace.sources import raw_csv, snapshots, storage, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None):
    """Register a query under its function name, with its SQL if there is any."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _database(spark: SparkSession) -> str:
    """A new database in the shared folder."""
    name = f"millrace_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{storage.fresh_path(spark, 'database')}'")
    return name


# The supplied tables hold no bad values, so some are put in by a rule on the key.
DIRTY = (
    "CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 13 = 0 THEN NULL "
    "ELSE CAST(value AS {text}) END"
)
DIRTY_SQL = f"""dirty AS (
    SELECT event_id, ts, event_type, user_id, {DIRTY.format(text="VARCHAR")} AS raw FROM events
), typed AS (SELECT *, TRY_CAST(raw AS DOUBLE) AS v FROM dirty)"""


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id", F.expr(DIRTY.format(text="STRING")).alias("raw")
    )


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.coerce_numeric(_dirty_events(spark, sf_dir), ["raw"]).withColumnRenamed("raw", "v")


# --- typing and projecting ---------------------------------------------------------------------


@_query(f"WITH {DIRTY_SQL} SELECT event_id, v FROM typed")
def coerce_numeric(spark, sf_dir):
    return _typed_events(spark, sf_dir).select("event_id", "v")


@_query("SELECT event_id, CAST(trunc(value) AS BIGINT) AS value FROM events")
def strict_int(spark, sf_dir):
    return clean.cast_strict_int(_read(spark, sf_dir, "events"), "value").select("event_id", "value")


@_query(
    "SELECT o_orderstatus, o_orderpriority, o_totalprice, o_custkey, "
    "CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders"
)
def project_features(spark, sf_dir):
    return clean.select_features(
        _read(spark, sf_dir, "orders"),
        ["o_orderstatus", "o_orderpriority"],
        ["o_totalprice"],
        "o_custkey",
        "o_orderkey",
    )


@_query("SELECT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def feature_columns(spark, sf_dir):
    features, _ = clean.split_xy(
        _read(spark, sf_dir, "lineitem"),
        ["l_returnflag"],
        ["l_quantity", "l_discount", "l_tax"],
        "l_extendedprice",
    )
    return features


@_query("SELECT * EXCLUDE (l_shipdate, l_linestatus) FROM lineitem")
def drop_columns(spark, sf_dir):
    return _read(spark, sf_dir, "lineitem").drop("l_shipdate", "l_linestatus")


@_query("SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def shape_report(spark, sf_dir):
    return clean.shape(_read(spark, sf_dir, "lineitem"))


@_query("SELECT o_orderkey, TRUE AS stamped, TRUE AS one_time FROM orders")
def audit_stamp(spark, sf_dir):
    stamped = clean.stamp_utc(_read(spark, sf_dir, "orders"), "at")
    return stamped.select(
        "o_orderkey",
        F.col("at").isNotNull().alias("stamped"),
        (F.col("at") == F.current_timestamp()).alias("one_time"),
    )


# --- filling -----------------------------------------------------------------------------------


@_query(
    f"WITH {DIRTY_SQL} SELECT event_id, "
    "round(coalesce(v, (SELECT median(v) FROM typed)), 6) AS v FROM typed"
)
def fill_median(spark, sf_dir):
    filled = impute.impute(_typed_events(spark, sf_dir), {"v": "median"})
    return filled.select("event_id", F.round("v", 6).alias("v"))


@_query(
    f"WITH {DIRTY_SQL} SELECT event_id, "
    "round(coalesce(v, (SELECT avg(v) FROM typed)), 6) AS v FROM typed"
)
def fill_mean(spark, sf_dir):
    filled = impute.impute(_typed_events(spark, sf_dir), {"v": "mean"})
    return filled.select("event_id", F.round("v", 6).alias("v"))


@_query(f"WITH {DIRTY_SQL} SELECT event_id, coalesce(v, 0) AS v FROM typed")
def fill_constant(spark, sf_dir):
    return impute.impute(_typed_events(spark, sf_dir), {"v": 0}).select("event_id", "v")


@_query(
    f"WITH {DIRTY_SQL}, s AS (SELECT median(v) AS med, avg(v) AS mean FROM typed) "
    "SELECT event_id, round(coalesce(v, med), 6) AS by_median, round(coalesce(v, mean), 6) AS "
    "by_mean, coalesce(v, 0) AS by_constant, v AS unfilled FROM typed CROSS JOIN s"
)
def fill_all(spark, sf_dir):
    copies = ["by_median", "by_mean", "by_constant", "unfilled"]
    wide = _typed_events(spark, sf_dir).select("event_id", *(F.col("v").alias(c) for c in copies))
    filled = impute.impute(wide, {"by_median": "median", "by_mean": "mean", "by_constant": 0})
    return filled.withColumns({c: F.round(c, 6) for c in ("by_median", "by_mean")})


@_query(
    "SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice, "
    "round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax FROM lineitem"
)
def column_statistics(spark, sf_dir):
    rules = {
        "l_quantity": "median",
        "l_extendedprice": "median",
        "l_discount": "mean",
        "l_tax": "mean",
    }
    fills = impute.column_statistics(_read(spark, sf_dir, "lineitem"), rules)
    row = spark.createDataFrame([tuple(fills.values())], ", ".join(f"{c} double" for c in fills))
    return row.withColumns({c: F.round(c, 6) for c in ("l_discount", "l_tax")})


@_query(
    "WITH t AS (SELECT o_orderkey * 1000003::BIGINT + 1152921504606846977 AS b, "
    "o_totalprice::DECIMAL(12,2)::DECIMAL(38,10) AS d, o_totalprice AS x FROM orders), "
    "n AS (SELECT count(*) AS n FROM orders), "
    "b AS (SELECT b, row_number() OVER (ORDER BY b) AS r FROM t), "
    "d AS (SELECT d, row_number() OVER (ORDER BY d) AS r FROM t) "
    "SELECT CAST((SELECT sum(b::HUGEINT) FROM b, n WHERE r IN ((n + 1) // 2, (n + 2) // 2)) * "
    "CASE WHEN n % 2 = 1 THEN 2 ELSE 1 END AS VARCHAR) AS twice_bigint, "
    "CAST((SELECT sum(d) FROM d, n WHERE r IN ((n + 1) // 2, (n + 2) // 2)) * "
    "CASE WHEN n % 2 = 1 THEN 2 ELSE 1 END AS VARCHAR) AS twice_decimal, "
    "(SELECT median(x) FROM t) AS of_double FROM n"
)
def exact_median_types(spark, sf_dir):
    """Medians of a bigint beyond 2 ** 53, a decimal(38,10) and a double, in the same scans."""
    wide = _read(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 1000003 + 1152921504606846977).alias("b"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(38,10)").alias("d"),
        F.col("o_totalprice").alias("x"),
    )
    found = impute.column_statistics(wide, dict.fromkeys(wide.columns, "median"))
    row = (str(int(2 * found["b"])), f"{2 * found['d']:.10f}", found["x"])
    return spark.createDataFrame([row], "twice_bigint string, twice_decimal string, of_double double")


# --- numbering and joining by position ----------------------------------------------------------


@_query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders"
)
def sequential_key(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return keys.add_sequential_key(orders, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "id")


@_query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders"
)
def file_order_key(spark, sf_dir):
    path = storage.fresh_path(spark, "csv")
    ordered = _read(spark, sf_dir, "orders").orderBy("o_totalprice", "o_orderkey")
    ordered.select("o_orderkey", "o_totalprice").write.csv(path, header=True)
    numbered = keys.number_file_rows(raw_csv.read_raw_csv(spark, path, with_position=True))
    return numbered.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "id")


@_query(
    "SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS c_custkey FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders) "
    "LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS r "
    "FROM customer) USING (r)"
)
def zip_by_position(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    zipped = keys.zip_by_position(
        orders, customers, ["o_totalprice", "o_orderkey"], ["c_acctbal", "c_custkey"]
    )
    return zipped.select("o_orderkey", F.col("c_custkey").cast("string").alias("c_custkey"))


@_query(
    "SELECT o_orderkey, round((SELECT avg(c_acctbal) FROM customer), 6) AS mean_balance, "
    "(SELECT count(*) FROM customer) AS n_customers FROM orders"
)
def repeat_row(spark, sf_dir):
    one_row = _read(spark, sf_dir, "customer").agg(
        F.round(F.avg("c_acctbal"), 6).alias("mean_balance"), F.count("*").alias("n_customers")
    )
    return keys.repeat_row(_read(spark, sf_dir, "orders").select("o_orderkey"), one_row)


# --- splitting and limits -----------------------------------------------------------------------


def _labelled(parts: tuple[DataFrame, DataFrame], *columns: str) -> DataFrame:
    train, test = parts
    return train.select(*columns, F.lit("train").alias("part")).unionByName(
        test.select(*columns, F.lit("test").alias("part"))
    )


@_query(
    "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) "
    "<= ceil((SELECT count(*) FROM orders) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part "
    "FROM orders"
)
def split_exact(spark, sf_dir):
    return _labelled(split.split_exact(_read(spark, sf_dir, "orders"), "o_orderkey"), "o_orderkey")


BUCKET_SQL = "('0x' || substr(md5('42:' || {key}), 1, 12))::BIGINT % 1000"


@_query(
    f"SELECT o_orderkey, CASE WHEN {BUCKET_SQL.format(key='o_orderkey')} < 200 THEN 'test' "
    "ELSE 'train' END AS part FROM orders"
)
def split_bucket(spark, sf_dir):
    return _labelled(split.split_bucket(_read(spark, sf_dir, "orders"), "o_orderkey"), "o_orderkey")


@_query(
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"
)
def ordered_limit(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return split.ordered_limit(orders, [F.desc("o_totalprice"), "o_orderkey"], 100)


@_query(
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem "
    "ORDER BY l_quantity DESC, l_extendedprice, l_orderkey, l_linenumber "
    "LIMIT (SELECT count(*) // 3 FROM lineitem)"
)
def ordered_limit_large(spark, sf_dir):
    """A third of the lines in a composite order, found by boundary search."""
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    order = [F.desc("l_quantity"), "l_extendedprice", "l_orderkey", "l_linenumber"]
    return split.ordered_limit(items, order, items.count() // 3, merged=1000)


# --- metrics and the champion test ---------------------------------------------------------------


def _with_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        (price * 0.9 + 10).alias("first"),
        (price * 0.95 - 100).alias("second"),
    )


PREDICTED_SQL = (
    "predicted AS (SELECT o_orderkey, o_orderstatus, o_totalprice, "
    "o_totalprice * 0.9::DOUBLE + 10 AS first, o_totalprice * 0.95::DOUBLE - 100 AS second "
    "FROM orders)"
)


@_query(
    f"WITH {PREDICTED_SQL} SELECT round(avg(pow(o_totalprice - first, 2)), 1) AS mse, "
    "round(avg(abs(o_totalprice - first)), 4) AS mae, "
    "round(1 - sum(pow(o_totalprice - first, 2)) / (var_pop(o_totalprice) * count(*)), 6) "
    "AS r2_score FROM predicted"
)
def regression_metrics(spark, sf_dir):
    found = metrics.regression_metrics(_with_predictions(spark, sf_dir), "o_totalprice", "first")
    return found.select(
        F.round("mse", 1).alias("mse"),
        F.round("mae", 4).alias("mae"),
        F.round("r2_score", 6).alias("r2_score"),
    )


@_query(
    f"WITH {PREDICTED_SQL} "
    "SELECT o_orderkey, round(abs(o_totalprice - first), 4) AS error FROM predicted"
)
def absolute_error(spark, sf_dir):
    rows = _with_predictions(spark, sf_dir)
    with_error = metrics.add_absolute_error(rows, "o_totalprice", "first", "error")
    return with_error.select("o_orderkey", F.round("error", 4).alias("error"))


@_query(
    f"WITH {PREDICTED_SQL} SELECT o_orderkey, o_totalprice AS actual, "
    "round(first, 4) AS prediction_current, "
    "CASE WHEN o_orderstatus = 'O' THEN round(second, 4) END AS prediction_latest FROM predicted"
)
def comparison_frame(spark, sf_dir):
    rows = _with_predictions(spark, sf_dir)
    current = rows.select("o_orderkey", F.round("first", 4).alias("prediction"))
    # The older model scored open orders only.
    latest = rows.where("o_orderstatus = 'O'").select(
        "o_orderkey", F.round("second", 4).alias("prediction")
    )
    return metrics.compare_predictions(rows, "o_orderkey", "o_totalprice", current, latest)


@_query(
    f"WITH {PREDICTED_SQL}, e AS (SELECT avg(abs(o_totalprice - second)) AS c, "
    "avg(abs(o_totalprice - first)) AS l FROM predicted) "
    "SELECT round(c, 4) AS mae_current, round(l, 4) AS mae_latest, c < l AS promote, "
    "CASE WHEN c < l THEN 'current model is better' ELSE 'current model is not better' END "
    "AS reason FROM e"
)
def champion_gate(spark, sf_dir):
    decision = metrics.champion_gate(
        _with_predictions(spark, sf_dir), "o_totalprice", "second", "first"
    )
    return decision.withColumns({c: F.round(c, 4) for c in ("mae_current", "mae_latest")})


@_query(
    f"WITH {PREDICTED_SQL} SELECT round(avg(abs(o_totalprice - first)), 4) AS mae_current, "
    "NULL::DOUBLE AS mae_latest, TRUE AS promote, 'no latest model' AS reason FROM predicted"
)
def champion_gate_first(spark, sf_dir):
    decision = metrics.champion_gate(_with_predictions(spark, sf_dir), "o_totalprice", "first")
    return decision.withColumn("mae_current", F.round("mae_current", 4))


# --- features and models -------------------------------------------------------------------------


@_query(
    "SELECT l_orderkey, l_linenumber, l_returnflag, (l_returnflag = 'A')::DOUBLE AS is_a, "
    "(l_returnflag = 'N')::DOUBLE AS is_n, l_quantity AS quantity FROM lineitem"
)
def onehot_unseen(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    encoder = Pipeline(stages=feature_stages(["l_returnflag"], ["l_quantity"]))
    # Level R is unknown to the encoder, so its rows get zeros.
    encoded = encoder.fit(items.where("l_returnflag <> 'R'")).transform(items)
    vector = vector_to_array(FEATURES)
    return encoded.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        vector[0].alias("is_a"),
        vector[1].alias("is_n"),
        vector[2].alias("quantity"),
    )


@_query(
    "WITH known AS (SELECT l_orderkey AS k, row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 "
    "AS place FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')), "
    "size AS (SELECT count(*) AS n FROM known), "
    "flags AS (SELECT l_linestatus AS f, row_number() OVER (ORDER BY l_linestatus) - 1 AS place FROM "
    "(SELECT DISTINCT l_linestatus FROM lineitem WHERE l_returnflag <> 'R')) "
    "SELECT l_orderkey, l_linenumber, k.place IS NOT NULL AS known, "
    "list_filter([k.place, size.n + flags.place, size.n + (SELECT count(*) FROM flags)], "
    "lambda x: x IS NOT NULL)::VARCHAR AS places, l_quantity AS quantity "
    "FROM lineitem CROSS JOIN size LEFT JOIN known k ON k.k = l_orderkey LEFT JOIN flags ON f = l_linestatus"
)
def onehot_many_levels(spark, sf_dir):
    """Orders as a category, so levels grow with the table; orders whose lines all came back are unknown."""
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity"
    )
    learnt = items.where("l_returnflag <> 'R'")
    stages = feature_stages(["l_orderkey", "l_linestatus"], ["l_quantity"], wide=learnt)
    encoded = Pipeline(stages=stages).fit(learnt).transform(items)
    parts = F.col(FEATURES)
    vector = F.from_json(F.to_json(F.struct(parts.alias("v"))), "v struct<indices: array<int>, values: array<double>>")["v"]
    return encoded.select(
        "l_orderkey",
        "l_linenumber",
        (F.size(vector["indices"]) == 3).alias("known"),
        F.concat(F.lit("["), F.array_join(vector["indices"].cast("array<string>"), ", "), F.lit("]")).alias("places"),
        F.element_at(vector["values"], -1).alias("quantity"),
    )


def _price_by_line_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_extendedprice"
    )


@_query(
    "SELECT l_orderkey, l_linenumber, "
    "round(avg(l_extendedprice) OVER (PARTITION BY l_linestatus), 3) AS prediction FROM lineitem"
)
def tree_depth1(spark, sf_dir):
    items = _price_by_line_status(spark, sf_dir)
    params = {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 1}
    model = boosting.fit_gbt(items, ["l_linestatus"], [], "l_extendedprice", params)
    scored = predict(model, items)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


@_query(
    "WITH g AS (SELECT l_orderkey, l_linenumber, avg(l_extendedprice) OVER () AS m, "
    "avg(l_extendedprice) OVER (PARTITION BY l_linestatus) AS g FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, "
    "round(m + (1 - pow(1 - 0.1::DOUBLE, 3)) * (g - m), 3) AS prediction FROM g"
)
def boost_mean_start(spark, sf_dir):
    items = _price_by_line_status(spark, sf_dir)
    params = {"learning_rate": 0.1, "n_estimators": 3, "max_depth": 1}
    model = boosting.fit_mean_boost(
        items, ["l_linestatus"], [], "l_extendedprice", params, stage_every=2
    )
    scored = predict(model, items)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


# Two trees of depth 1 in SQL: of all splits by quantity or by one level of the flag the best one is
# taken, then again for what the first leaves. Squared error hands on twice the remainder.
@_query(
    """
    WITH cells AS (
        SELECT l_quantity AS q, l_returnflag AS r, count(*) AS n, sum(l_extendedprice) AS s
        FROM lineitem GROUP BY l_quantity, l_returnflag
    ), splits AS (
        SELECT DISTINCT q AS least, NULL AS level FROM cells
        UNION ALL SELECT DISTINCT NULL, r FROM cells
    ), first_gains AS (
        SELECT least, level,
            sum(CASE WHEN c.q >= least OR c.r = level THEN n END) AS n1,
            sum(CASE WHEN c.q >= least OR c.r = level THEN s END) AS s1,
            sum(n) AS n0, sum(s) AS s0
        FROM splits CROSS JOIN cells c GROUP BY least, level
    ), first_tree AS (
        SELECT least, level, s1 / n1 AS inside, (s0 - s1) / (n0 - n1) AS outside
        FROM first_gains WHERE n1 < n0
        ORDER BY s1 * s1 / n1 + (s0 - s1) * (s0 - s1) / (n0 - n1) DESC LIMIT 1
    ), left_over AS (
        SELECT q, r, n, p, 2 * (s - n * p) AS s FROM (
            SELECT c.*, CASE WHEN c.q >= t.least OR c.r = t.level THEN inside ELSE outside END AS p
            FROM cells c CROSS JOIN first_tree t
        )
    ), second_gains AS (
        SELECT least, level,
            sum(CASE WHEN c.q >= least OR c.r = level THEN n END) AS n1,
            sum(CASE WHEN c.q >= least OR c.r = level THEN s END) AS s1,
            sum(n) AS n0, sum(s) AS s0
        FROM splits CROSS JOIN left_over c GROUP BY least, level
    ), second_tree AS (
        SELECT least, level, s1 / n1 AS inside, (s0 - s1) / (n0 - n1) AS outside
        FROM second_gains WHERE n1 < n0
        ORDER BY s1 * s1 / n1 + (s0 - s1) * (s0 - s1) / (n0 - n1) DESC LIMIT 1
    )
    SELECT l_orderkey, l_linenumber, round(
        p + 0.1::DOUBLE * CASE WHEN c.q >= t.least OR c.r = t.level THEN inside ELSE outside END, 3
    ) AS prediction
    FROM lineitem JOIN left_over c ON l_quantity = c.q AND l_returnflag = c.r CROSS JOIN second_tree t
    """
)
def gbt_fit_score(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    params = {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 1, "maxBins": 64}
    model = boosting.fit_gbt(items, ["l_returnflag"], ["l_quantity"], "l_extendedprice", params)
    scored = predict(model, items)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


# The same splits, but of what the mean and the scaled trees before leave over.
@_query(
    """
    WITH cells AS (
        SELECT l_quantity AS q, l_returnflag AS r, count(*) AS n, sum(l_extendedprice) AS s
        FROM lineitem GROUP BY l_quantity, l_returnflag
    ), start AS (SELECT sum(s) / sum(n) AS mean FROM cells),
    centred AS (SELECT q, r, n, s - n * mean AS s FROM cells CROSS JOIN start),
    splits AS (
        SELECT DISTINCT q AS least, NULL AS level FROM cells
        UNION ALL SELECT DISTINCT NULL, r FROM cells
    ), first_gains AS (
        SELECT least, level,
            sum(CASE WHEN c.q >= least OR c.r = level THEN n END) AS n1,
            sum(CASE WHEN c.q >= least OR c.r = level THEN s END) AS s1,
            sum(n) AS n0, sum(s) AS s0
        FROM splits CROSS JOIN centred c GROUP BY least, level
    ), first_tree AS (
        SELECT least, level, s1 / n1 AS inside, (s0 - s1) / (n0 - n1) AS outside
        FROM first_gains WHERE n1 < n0
        ORDER BY s1 * s1 / n1 + (s0 - s1) * (s0 - s1) / (n0 - n1) DESC LIMIT 1
    ), left_over AS (
        SELECT q, r, n, p, s - n * 0.5::DOUBLE * p AS s FROM (
            SELECT c.*, CASE WHEN c.q >= t.least OR c.r = t.level THEN inside ELSE outside END AS p
            FROM centred c CROSS JOIN first_tree t
        )
    ), second_gains AS (
        SELECT least, level,
            sum(CASE WHEN c.q >= least OR c.r = level THEN n END) AS n1,
            sum(CASE WHEN c.q >= least OR c.r = level THEN s END) AS s1,
            sum(n) AS n0, sum(s) AS s0
        FROM splits CROSS JOIN left_over c GROUP BY least, level
    ), second_tree AS (
        SELECT least, level, s1 / n1 AS inside, (s0 - s1) / (n0 - n1) AS outside
        FROM second_gains WHERE n1 < n0
        ORDER BY s1 * s1 / n1 + (s0 - s1) * (s0 - s1) / (n0 - n1) DESC LIMIT 1
    )
    SELECT l_orderkey, l_linenumber, round(mean + 0.5::DOUBLE * (
        p + CASE WHEN c.q >= t.least OR c.r = t.level THEN inside ELSE outside END
    ), 3) AS prediction
    FROM lineitem JOIN left_over c ON l_quantity = c.q AND l_returnflag = c.r
        CROSS JOIN second_tree t CROSS JOIN start
    """
)
def boost_mean_start_numeric(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    params = {"learning_rate": 0.5, "n_estimators": 2, "max_depth": 1, "maxBins": 64}
    model = boosting.fit_mean_boost(
        items, ["l_returnflag"], ["l_quantity"], "l_extendedprice", params, stage_every=2
    )
    scored = predict(model, items)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


@_query(
    "SELECT o_orderkey, round(o_totalprice * 0.5::DOUBLE + o_custkey, 4) AS prediction FROM orders"
)
def python_model_score(spark, sf_dir):
    def half_price(batch):
        return batch["o_totalprice"] * 0.5 + batch["o_custkey"]

    scored = scoring.score_with(
        _read(spark, sf_dir, "orders"), half_price, ["o_totalprice", "o_custkey"]
    )
    return scored.select("o_orderkey", F.round("prediction", 4).alias("prediction"))


# --- tables, snapshots, changes ------------------------------------------------------------------


@_query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_round_trip(spark, sf_dir):
    path = storage.fresh_path(spark, "csv")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.write.csv(path, header=True)
    typed = clean.coerce_numeric(raw_csv.read_raw_csv(spark, path), ["o_totalprice"])
    return clean.cast_strict_int(typed, "o_orderkey")


@_query("SELECT doc_id, text, n_chars FROM documents")
def csv_quoted_text(spark, sf_dir):
    path = storage.fresh_path(spark, "csv")
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    docs.write.csv(path, header=True, escape='"', emptyValue="")
    # A cell may fill a whole text, line breaks included.
    typed = raw_csv.read_raw_csv(spark, path, multiline=True)
    typed = clean.cast_strict_int(clean.cast_strict_int(typed, "doc_id"), "n_chars")
    return typed.withColumn("text", F.coalesce("text", F.lit("")))


@_query("SELECT p_partkey, p_name, p_retailprice FROM part")
def overwrite_table(spark, sf_dir):
    table = f"{_database(spark)}.part"
    parts = _read(spark, sf_dir, "part")
    tables.overwrite_table(parts.select("p_name", "p_size"), table)
    tables.overwrite_table(parts, table)
    return tables.scan(spark, table, ["p_partkey", "p_name", "p_retailprice"])


@_query(
    "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_nationkey, c_acctbal, "
    "c_acctbal < 0 AS in_debt FROM customer"
)
def merge_schema_overwrite(spark, sf_dir):
    table = f"{_database(spark)}.customer"
    customers = _read(spark, sf_dir, "customer")
    tables.write_merged(customers.select("c_custkey", "c_name", "c_nationkey"), table)
    in_debt = (F.col("c_acctbal") < 0).alias("in_debt")
    tables.write_merged(customers.select("c_acctbal", in_debt, "c_name", "c_custkey"), table)
    merged = tables.scan(spark, table)
    return merged.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))


def _customer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers without one segment; then without another, debts raised by one."""
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    raised = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    return (
        customers.where("c_mktsegment <> 'BUILDING'"),
        customers.where("c_mktsegment <> 'MACHINERY'").withColumn("c_acctbal", raised),
    )


@_query(
    "WITH o AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer "
    "WHERE c_mktsegment <> 'BUILDING'), n AS (SELECT c_custkey, c_mktsegment, "
    "CASE WHEN c_acctbal < 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer "
    "WHERE c_mktsegment <> 'MACHINERY') SELECT c_custkey, "
    "coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, "
    "round(coalesce(n.c_acctbal, o.c_acctbal), 4) AS c_acctbal, "
    "CASE WHEN o.c_mktsegment IS NULL THEN 'insert' WHEN n.c_mktsegment IS NULL THEN 'delete' "
    "ELSE 'update' END AS change_type FROM o FULL JOIN n USING (c_custkey) "
    "WHERE o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM "
    "n.c_mktsegment"
)
def change_feed(spark, sf_dir):
    table = f"{_database(spark)}.customer"
    for version in _customer_versions(spark, sf_dir):
        snapshots.write_snapshot(version, table, bucket_key="c_custkey", buckets=8)
    feed = snapshots.change_feed(
        snapshots.read_snapshot(spark, table, 0), snapshots.read_snapshot(spark, table), "c_custkey"
    )
    return feed.withColumn("c_acctbal", F.round("c_acctbal", 4))


@_query(
    "WITH o AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer "
    "WHERE c_mktsegment <> 'BUILDING'), n AS (SELECT c_custkey, c_mktsegment, "
    "CASE WHEN c_acctbal < 0 AND c_custkey % 2 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal "
    "FROM customer WHERE c_mktsegment <> 'FURNITURE' AND (c_mktsegment <> 'BUILDING' OR c_custkey % 3 > 0)) "
    "SELECT c_custkey, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, "
    "round(coalesce(n.c_acctbal, o.c_acctbal), 4) AS c_acctbal, "
    "CASE WHEN o.c_mktsegment IS NULL THEN 'insert' WHEN n.c_mktsegment IS NULL THEN 'delete' "
    "ELSE 'update' END AS change_type FROM o FULL JOIN n USING (c_custkey) "
    "WHERE o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment"
)
def change_feed_range(spark, sf_dir):
    """What three versions changed in all; the third takes back some changes of the second."""
    table = f"{_database(spark)}.customer"
    first, second = _customer_versions(spark, sf_dir)
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    raised = F.when((F.col("c_acctbal") < 0) & (F.col("c_custkey") % 2 == 1), F.col("c_acctbal") + 1)
    third = customers.where(
        "c_mktsegment <> 'FURNITURE' AND (c_mktsegment <> 'BUILDING' OR c_custkey % 3 > 0)"
    ).withColumn("c_acctbal", F.coalesce(raised, "c_acctbal"))
    snapshots.write_snapshot(first, table, bucket_key="c_custkey", buckets=8)
    snapshots.record_changes(spark, table, "c_custkey")
    for version in (second, third):
        last = snapshots.write_snapshot(version, table)
    net = snapshots.net_changes(snapshots.table_changes(spark, table, 0, last), "c_custkey")
    return net.withColumn("c_acctbal", F.round("c_acctbal", 4))


@_query(
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'"
)
def snapshot_read(spark, sf_dir):
    table = f"{_database(spark)}.customer"
    for version in _customer_versions(spark, sf_dir):
        snapshots.write_snapshot(version, table)
    return snapshots.read_snapshot(spark, table, 0)


# --- predictions ---------------------------------------------------------------------------------


@_query(
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN "
    "round(o_totalprice * 0.9::DOUBLE, 4) END AS prediction, TRUE AS stamped FROM orders"
)
def score_output(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    predictions = orders.where("o_orderstatus = 'O'").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 0.9, 4).alias("prediction")
    )
    rows = orders.select("o_orderkey", "o_totalprice")
    table = f"{_database(spark)}.predictions"
    written = scoring.save_predictions(rows, predictions, "o_orderkey", table)
    return written.select(
        "o_orderkey",
        "o_totalprice",
        "prediction",
        F.col(scoring.PREDICTED_AT).isNotNull().alias("stamped"),
    )


@_query("SELECT count(*) AS n_rows, count(*) FILTER (o_totalprice < 0) > 0 AS written FROM orders")
def score_nothing(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    predictions = orders.where("o_totalprice < 0").select("o_orderkey", "o_totalprice")
    table = f"{_database(spark)}.predictions"
    written = scoring.save_predictions(orders, predictions, "o_orderkey", table)
    return orders.agg(
        F.count("*").alias("n_rows"), F.lit(written is not None).alias("written")
    )


@_query(
    "SELECT 'rows' AS form, o_orderkey, round(o_totalprice * 2, 4) AS prediction FROM orders "
    "UNION ALL SELECT 'one row', o_orderkey, round((SELECT avg(o_totalprice) FROM orders), 4) "
    "FROM orders UNION ALL SELECT 'number', o_orderkey, 7.5 FROM orders "
    "UNION ALL SELECT 'none', o_orderkey, NULL FROM orders"
)
def prediction_forms(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey")
    forms = {
        "rows": orders.select("o_orderkey", F.round(F.col("o_totalprice") * 2, 4).alias("prediction")),
        "one row": orders.agg(F.round(F.avg("o_totalprice"), 4).alias("prediction")),
        "number": 7.5,
        "none": None,
    }
    result = None
    for form, predictions in forms.items():
        part = scoring.attach_predictions(rows, predictions, "o_orderkey").select(
            F.lit(form).alias("form"), "o_orderkey", "prediction"
        )
        result = part if result is None else result.unionByName(part)
    return result


# --- ledger and registry -------------------------------------------------------------------------

STATUS_MODEL = {"learning_rate": 0.1, "n_estimators": 1, "max_depth": 2}


def _fit_by_status(orders: DataFrame):
    """A model whose prediction is the mean price of the order's status."""
    return boosting.fit_gbt(orders, ["o_orderstatus"], [], "o_totalprice", STATUS_MODEL)


@_query(
    "WITH p AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY o_orderstatus) AS p "
    "FROM orders), m AS (SELECT avg(pow(y - p, 2)) AS mse, avg(abs(y - p)) AS mae, "
    "1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS r2 FROM p) "
    "SELECT 'mse' AS metric, round(mse / 1e6, 4) AS value, '0.1' AS learning_rate FROM m UNION ALL "
    "SELECT 'mae', round(mae, 3), '0.1' FROM m UNION ALL SELECT 'r2_score', round(r2, 6), '0.1' "
    "FROM m"
)
def run_ledger(spark, sf_dir):
    database = _database(spark)
    orders = _read(spark, sf_dir, "orders")
    model = _fit_by_status(orders)
    found = metrics.regression_metrics(predict(model, orders), "o_totalprice", "prediction")
    run_id = ledger.log_run(
        spark,
        database,
        "prices",
        model,
        storage.fresh_path(spark, "models"),
        found.first().asDict(),
        STATUS_MODEL,
        inputs=orders.select("o_orderstatus"),
    )
    recorded = ledger.run_metadata(spark, database, run_id)
    listed = recorded.select(
        F.explode("metrics").alias("metric", "value"),
        F.col("params")["learning_rate"].alias("learning_rate"),
    )
    value = F.col("value")
    rounded = (
        F.when(F.col("metric") == "mse", F.round(value / 1e6, 4))
        .when(F.col("metric") == "mae", F.round(value, 3))
        .otherwise(F.round(value, 6))
    )
    return listed.withColumn("value", rounded)


@_query(
    "SELECT CASE column_name WHEN 'prediction' THEN 'output' ELSE 'input' END AS side, column_name AS name, "
    "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'long' ELSE lower(data_type) END AS type, "
    "(SELECT count(*) FROM orders) AS n_rows "
    "FROM (SELECT column_name, data_type FROM information_schema.columns WHERE table_name = 'orders' "
    "AND column_name IN ('o_orderstatus', 'o_custkey') UNION ALL SELECT 'prediction', 'DOUBLE')"
)
def run_signature(spark, sf_dir):
    """Both sides of the signature that a run has stored, as rows."""
    database = _database(spark)
    orders = _read(spark, sf_dir, "orders")
    model = boosting.fit_gbt(orders, ["o_orderstatus"], ["o_custkey"], "o_totalprice", STATUS_MODEL)
    run_id = ledger.log_run(
        spark, database, "prices", model, storage.fresh_path(spark, "models"), {}, STATUS_MODEL,
        inputs=orders.select("o_orderstatus", "o_custkey"),
        outputs=predict(model, orders).select("prediction"),
    )
    run = spark.table(f"{database}.{ledger.RUNS}").where(F.col("run_id") == run_id)
    field = "array<struct<name: string, type: string>>"
    sides = F.from_json("signature", f"inputs {field}, outputs {field}")
    listed = run.select(sides.alias("s")).select(
        F.explode(
            F.concat(
                F.transform("s.inputs", lambda x: F.struct(F.lit("input").alias("side"), x["name"].alias("name"), x["type"].alias("type"))),
                F.transform("s.outputs", lambda x: F.struct(F.lit("output").alias("side"), x["name"].alias("name"), x["type"].alias("type"))),
            )
        ).alias("x")
    )
    return listed.select("x.*", F.lit(orders.count()).cast("bigint").alias("n_rows"))


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def run_dataset(spark, sf_dir):
    database = _database(spark)
    table = f"{database}.orders"
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    fitted_on = snapshots.write_snapshot(orders.where("o_orderstatus <> 'P'"), table)
    run_id = ledger.log_run(
        spark,
        database,
        "prices",
        _fit_by_status(snapshots.read_snapshot(spark, table, fitted_on)),
        storage.fresh_path(spark, "models"),
        {},
        STATUS_MODEL,
        dataset=(table, fitted_on),
    )
    snapshots.write_snapshot(orders, table)
    return ledger.run_dataset(spark, database, run_id).select("o_orderkey", "o_totalprice")


@_query(
    "SELECT o_orderpriority AS experiment, run_id, o_orderdate AS started_at, o_totalprice AS price "
    "FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS run_id, row_number() OVER ("
    "PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS r "
    "FROM orders) WHERE r = 1"
)
def latest_run(spark, sf_dir):
    # Every order stands for a run of the experiment named by its priority.
    runs = _read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").alias("started_at"),
        F.create_map(F.lit("price"), F.col("o_totalprice")).alias("metrics"),
    )
    return ledger.latest_runs(runs).select(
        "experiment", "run_id", "started_at", F.col("metrics")["price"].alias("price")
    )


def _registry_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every event stands for a registered version and for an alias set by its user."""
    events = _read(spark, sf_dir, "events")
    versions = events.select(
        F.col("event_type").alias("name"),
        F.col("event_id").alias("version"),
        F.col("user_id").cast("string").alias("run_id"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("path"),
    )
    aliases = events.select(
        F.col("event_type").alias("name"),
        F.concat(F.lit("by-"), F.col("user_id").cast("string")).alias("alias"),
        F.col("event_id").alias("version"),
        F.col("event_id").alias("seq"),
    )
    return versions, aliases


@_query(
    "SELECT event_type AS name, max(event_id) AS version, "
    "CAST(arg_max(user_id, event_id) AS VARCHAR) AS run_id, "
    "'models/' || max(event_id) AS path FROM events GROUP BY event_type"
)
def newest_versions(spark, sf_dir):
    versions, _ = _registry_rows(spark, sf_dir)
    return ledger.newest_versions(versions)


@_query(
    "SELECT event_type AS name, 'by-' || user_id AS alias, max(event_id) AS version, "
    "'models/' || max(event_id) AS path FROM events GROUP BY event_type, user_id"
)
def alias_resolve(spark, sf_dir):
    versions, aliases = _registry_rows(spark, sf_dir)
    return ledger.resolve_aliases(aliases, versions).select("name", "alias", "version", "path")


@_query(
    "SELECT o_orderkey, CAST(2 AS BIGINT) AS version, "
    "round(avg(o_totalprice) OVER (PARTITION BY o_orderstatus), 3) AS prediction FROM orders"
)
def registry_score(spark, sf_dir):
    database, root = _database(spark), storage.fresh_path(spark, "models")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = boosting.fit_gbt(
        orders.where("o_orderstatus = 'P'"), ["o_orderstatus"], [], "o_totalprice", STATUS_MODEL
    )
    for model in (first, _fit_by_status(orders)):
        run_id = ledger.log_run(spark, database, "prices", model, root, {})
        version = ledger.register_version(spark, database, "price", run_id)
        ledger.set_alias(spark, database, "price", ledger.LATEST_ALIAS, version)
    scored = predict(ledger.load_alias(spark, database, "price"), orders)
    return scored.select(
        "o_orderkey",
        F.lit(version).cast("bigint").alias("version"),
        F.round("prediction", 3).alias("prediction"),
    )


# --- the three jobs ------------------------------------------------------------------------------


@_query(
    f"WITH {DIRTY_SQL}, numbered AS (SELECT event_type, coalesce(v, (SELECT median(v) FROM typed)) "
    "AS v, user_id, row_number() OVER (ORDER BY ts, event_id) AS id FROM typed), "
    "parted AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), CAST(id AS VARCHAR)) "
    "<= ceil((SELECT count(*) FROM events) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part "
    "FROM numbered) SELECT part, event_type, count(*) AS n, round(avg(v), 6) AS mean_value, "
    "CAST(sum(user_id) AS BIGINT) AS user_sum FROM parted GROUP BY part, event_type"
)
def clean_and_split(spark, sf_dir):
    events = _dirty_events(spark, sf_dir).withColumnRenamed("raw", "v")
    columns = pipelines.Columns(num=["v"], cat=["event_type"], target="user_id")
    cleaned = pipelines.clean_table(events, columns, {"v": "median"}, ["ts", "event_id"])
    parts = _labelled(split.split_exact(cleaned, "Id"), "event_type", "v", "user_id")
    return parts.groupBy("part", "event_type").agg(
        F.count("*").alias("n"),
        F.round(F.avg("v"), 6).alias("mean_value"),
        F.sum("user_id").alias("user_sum"),
    )


@_query(
    f"WITH {DIRTY_SQL}, numbered AS (SELECT event_type, round(coalesce(v, (SELECT avg(v) FROM typed)"
    "), 6) AS v, user_id, CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR) AS \"Id\" FROM typed)"
    ", parted AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || \"Id\"), \"Id\") AS r "
    "FROM numbered) SELECT event_type, v, user_id, \"Id\", CASE WHEN r <= "
    "ceil((SELECT count(*) FROM events) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part "
    "FROM parted"
)
def prepare_job(spark, sf_dir):
    path, database = storage.fresh_path(spark, "csv"), _database(spark)
    raw = _dirty_events(spark, sf_dir).orderBy("event_id")
    raw.select(F.col("raw").alias("v"), "user_id", "event_type").write.csv(path, header=True)
    columns = pipelines.Columns(num=["v"], cat=["event_type"], target="user_id")
    train, test = f"{database}.train_set", f"{database}.test_set"
    pipelines.prepare(spark, path, columns, {"v": "mean"}, train, test)
    parts = spark.table(train), spark.table(test)
    labelled = _labelled(parts, "event_type", "v", "user_id", "Id")
    return labelled.withColumn("v", F.round("v", 6))


STATUS_PARTS_SQL = (
    f"parts AS (SELECT *, {BUCKET_SQL.format(key='o_orderkey')} < 200 AS is_test FROM orders), "
    "fitted AS (SELECT o_orderstatus, avg(o_totalprice) AS p FROM parts WHERE NOT is_test "
    "GROUP BY o_orderstatus)"
)
STATUS_COLUMNS = pipelines.Columns(
    num=[], cat=["o_orderstatus"], target="o_totalprice", key="o_orderkey"
)


def _status_tables(spark: SparkSession, sf_dir: str) -> str:
    """A database with a training and a test table of orders."""
    database = _database(spark)
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for part, name in zip(split.split_bucket(orders, "o_orderkey"), ("train", "test"), strict=True):
        tables.write_merged(part, f"{database}.{name}")
    return database


def _train_by_status(spark: SparkSession, database: str, root: str) -> dict:
    return pipelines.train_and_promote(
        spark,
        f"{database}.train",
        f"{database}.test",
        STATUS_COLUMNS,
        database,
        "price",
        root,
        "prices",
        STATUS_MODEL,
        fit=boosting.fit_gbt,
    )


@_query(
    f"WITH {STATUS_PARTS_SQL}, m AS (SELECT round(avg(abs(o_totalprice - p)), 3) AS mae "
    "FROM parts JOIN fitted USING (o_orderstatus) WHERE is_test) "
    "SELECT 1 AS attempt, mae AS mae_current, NULL::DOUBLE AS mae_latest, TRUE AS promote, "
    "'no latest model' AS reason, 1::BIGINT AS version FROM m UNION ALL "
    "SELECT 2, mae, mae, FALSE, 'current model is not better', 0 FROM m"
)
def train_job(spark, sf_dir):
    database, root = _status_tables(spark, sf_dir), storage.fresh_path(spark, "models")
    rows = []
    for attempt in (1, 2):
        outcome = _train_by_status(spark, database, root)
        errors = [outcome["mae_current"], outcome["mae_latest"]]
        version = outcome["version"] or 0
        rows.append((attempt, *errors, outcome["promote"], outcome["reason"], version))
    schema = (
        "attempt int, mae_current double, mae_latest double, promote boolean, reason string, "
        "version bigint"
    )
    decisions = spark.createDataFrame(rows, schema)
    return decisions.withColumns({c: F.round(c, 3) for c in ("mae_current", "mae_latest")})


# Boosting from the mean: with one tree and a rate r, a status is predicted as m + r * (p - m).
@_query(
    f"WITH {STATUS_PARTS_SQL}, start AS (SELECT avg(o_totalprice) AS m FROM parts WHERE NOT is_test), "
    "errors AS (SELECT avg(abs(o_totalprice - m - 0.1::DOUBLE * (p - m))) AS weak, "
    "avg(abs(o_totalprice - p)) AS strong FROM parts JOIN fitted USING (o_orderstatus) CROSS JOIN start "
    "WHERE is_test), "
    "better AS (SELECT weak, strong, least(weak, strong) AS best, strong < weak AS won FROM errors) "
    "SELECT 1 AS attempt, round(weak, 3) AS mae_current, NULL::DOUBLE AS mae_latest, TRUE AS promote, "
    "'no latest model' AS reason, 1::BIGINT AS version, 1::BIGINT AS dataset_version FROM better UNION ALL "
    "SELECT 2, round(strong, 3), round(weak, 3), won, CASE WHEN won THEN 'current model is better' "
    "ELSE 'current model is not better' END, CASE WHEN won THEN 2 ELSE 0 END, 1 FROM better UNION ALL "
    "SELECT 3, round(weak, 3), round(best, 3), FALSE, 'current model is not better', 0, 2 FROM better"
)
def train_job_champions(spark, sf_dir):
    """A weak model, a strong one that takes its place, and the weak one again on a newer version."""
    database, root = _status_tables(spark, sf_dir), storage.fresh_path(spark, "models")
    train = f"{database}.train"
    tables.write_version(spark.table(train), train)
    rows = []
    for attempt, rate in enumerate((0.1, 1.0, 0.1), start=1):
        if attempt == 3:
            tables.write_version(spark.table(train), train)
        outcome = pipelines.train_and_promote(
            spark, train, f"{database}.test", STATUS_COLUMNS, database, "price", root, "prices",
            {**STATUS_MODEL, "learning_rate": rate},
        )
        run = spark.table(f"{database}.{ledger.RUNS}").where(F.col("run_id") == outcome["run_id"]).first()
        errors = [outcome["mae_current"], outcome["mae_latest"]]
        row = (attempt, *errors, outcome["promote"], outcome["reason"], outcome["version"] or 0)
        rows.append((*row, run["dataset_version"]))
    schema = (
        "attempt int, mae_current double, mae_latest double, promote boolean, reason string, "
        "version bigint, dataset_version bigint"
    )
    decisions = spark.createDataFrame(rows, schema)
    return decisions.withColumns({c: F.round(c, 3) for c in ("mae_current", "mae_latest")})


@_query(
    f"WITH {STATUS_PARTS_SQL} SELECT o_orderkey, o_orderstatus, round(p, 3) AS prediction, "
    "TRUE AS stamped FROM parts JOIN fitted USING (o_orderstatus) WHERE is_test"
)
def score_job(spark, sf_dir):
    database, root = _status_tables(spark, sf_dir), storage.fresh_path(spark, "models")
    _train_by_status(spark, database, root)
    written = pipelines.score_batch(
        spark, f"{database}.test", STATUS_COLUMNS, database, "price", f"{database}.predictions"
    )
    return written.select(
        "o_orderkey",
        "o_orderstatus",
        F.round("prediction", 3).alias("prediction"),
        F.col(scoring.PREDICTED_AT).isNotNull().alias("stamped"),
    )
