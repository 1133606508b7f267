"""Every operator as a query over the given tables, each with the SQL that must give the same rows.

Floats are rounded on both sides. The SQL is plain DuckDB over the same parquet files.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.functions.expressions import bin_edges, bin_index
from feldspark.functions.hashing import driver_normal
from feldspark.operators import filters, models, monitoring, quality, runs, serving, splits, stats, tuning
from feldspark.operators.mlp import history_frame, initial_weights, prepare_training, train_mlp
from feldspark.operators.ordering import join_lookup
from feldspark.operators.preprocess import Preprocessor
from feldspark.operators.quality import ColumnRule, DatasetRules
from feldspark.operators.recipe import Recipe, default_recipe, fill_interaction
from feldspark.operators.store import FeatureStore, flat_metadata
from feldspark.plans.flows import build_features, preprocess_table, score_records, train_from_store
from feldspark.plans.frames import feature_frame, metric_frame, system_metrics, table
from feldspark.session import scratch_path
from feldspark.sources import synthetic
from feldspark.sources.parquet import create_source, read_parquet, write_parquet
from feldspark.streaming import metrics as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
ROUNDING = True  # the bench turns it off: rounding serves the comparison only


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if oracle is not None:
            ORACLES[name or f.__name__] = oracle
        return f

    return register


def rounded(df: DataFrame, digits: int = 6, columns: Sequence[str] | None = None) -> DataFrame:
    """Round double columns; integral columns become bigint, as in the SQL."""
    changed = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns):
            changed[f.name] = F.round(c.cast("double"), digits) if ROUNDING else c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            changed[f.name] = c.cast("long")
    return df.withColumns(changed) if changed else df


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    return feature_frame(table(spark, sf, "lineitem"))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metric_frame(table(spark, sf, "events"))


# ---- shared SQL

FRAME = """(SELECT l_orderkey AS id, l_quantity AS feature_1, l_discount AS feature_2,
  l_extendedprice AS feature_3, l_tax AS feature_4, l_shipdate AS "timestamp",
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END::BIGINT AS target FROM lineitem)"""
FEATURES = ("feature_1", "feature_2", "feature_3", "feature_4")


def _digest(seed: object, *keys: str) -> str:
    return f"md5(concat_ws(':', '{seed}', {', '.join(keys)}))"


def _word(digest: str, start: int) -> str:
    return f"(('0x' || substr({digest}, {start}, 8))::BIGINT)::DOUBLE"


def sql_uniform(seed: object, *keys: str) -> str:
    return f"({_word(_digest(seed, *keys), 1)} / 4294967296::DOUBLE)"


def sql_normal(seed: object, *keys: str) -> str:
    d = _digest(seed, *keys)
    return (
        f"(sqrt(-2 * ln(({_word(d, 1)} + 1) / 4294967296::DOUBLE)) "
        f"* cos({2 * math.pi!r}::DOUBLE * ({_word(d, 9)} / 4294967296::DOUBLE)))"
    )


def sql_moments(x: str, std: str = "stddev_samp") -> str:
    return f"avg({x}) AS mean, {std}({x}) AS std, min({x}) AS min, max({x}) AS max, count({x}) AS count"


def _union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------ sources, sinks


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")
def scan_orders(spark, sf):
    df = table(spark, sf, "orders")
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(_union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {test}) AS null_count, count(*) AS num_rows FROM events"
    for c, test in [(c, f"{c} IS NULL") for c in ("event_id", "ts", "user_id", "event_type", "props")]
    + [("value", "value IS NULL OR isnan(value)")]
]))
def null_profile(spark, sf):
    return stats.null_profile(table(spark, sf, "events"))


_SEED = 42
_X = {i: sql_normal(_SEED, f"'x{i}'", "o_orderkey") for i in range(1, 5)}
_Y = " + ".join(
    [f"0.1::DOUBLE * {sql_normal(_SEED, chr(39) + 'noise' + chr(39), 'o_orderkey')}"]
    + [f"x{i} * {driver_normal(_SEED, 'coefficient', i)!r}::DOUBLE" for i in range(1, 5)]
)
_DRAWN = f"(SELECT o_orderkey, {', '.join(f'{e} AS x{i}' for i, e in _X.items())} FROM orders)"


@query(f"""SELECT o_orderkey AS id, {', '.join(f'round(x{i}, 6) AS feature_{i}' for i in range(1, 5))},
  trunc({_Y})::BIGINT AS target FROM {_DRAWN}""")
def synthetic_regression(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return rounded(synthetic.regression_rows(ids, 4, _SEED))


@query(f"""SELECT o_orderkey AS id, {', '.join(f'round(x{i}, 6) AS feature_{i}' for i in range(1, 5))},
  (y > avg(y) OVER ())::BIGINT AS target,
  strftime(TIMESTAMP '2024-01-01' + o_orderkey * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M') AS "timestamp"
FROM (SELECT *, {_Y} + 0.5::DOUBLE * x1 * x2 + 0.3::DOUBLE * sin(x3 * 2) AS y FROM {_DRAWN})""")
def synthetic_labelled(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    df = synthetic.labelled_rows(ids, 4, _SEED)
    return rounded(df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm")))


@query(f"""SELECT round({sql_normal('part', 'o_orderkey % 10', "'normal'", 'o_orderkey')}, 6) AS feature_1,
  round({sql_uniform('part', 'o_orderkey % 10', "'uniform'", 'o_orderkey')}, 6) AS feature_2,
  ({sql_uniform('part', 'o_orderkey % 10', "'target'", 'o_orderkey')} >= 0.5)::BIGINT AS target FROM orders""")
def synthetic_partitioned(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return rounded(synthetic.partitioned_rows(ids))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def store_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "partitioned")
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    write_parquet(df, path, ["o_orderstatus"])
    return read_parquet(spark, path)


# ------------------------------------------------------------------- quality


@query("""SELECT c AS "column", p AS problem, e AS expected, a AS actual, (SELECT count(*) FROM events) AS num_rows
FROM (VALUES ('id', 'missing', 'bigint', ''), ('event_id', 'extra', '', 'bigint'), ('props', 'extra', '', 'string'),
  ('event_type', 'type', 'int', 'string')) AS t(c, p, e, a)""")
def schema_diff(spark, sf):
    expected = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.IntegerType()), T.StructField("event_type", T.IntegerType()),
        T.StructField("value", T.FloatType()),
    ])
    return quality.schema_diff(table(spark, sf, "events"), expected)


@query("""SELECT violation, n FROM (
  SELECT 'o_totalprice:range' AS violation, count(*) AS n FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000
  UNION ALL SELECT 'o_orderpriority:values', count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
  UNION ALL SELECT 'o_custkey:dtype', count(*) FROM orders
  UNION ALL SELECT 'discount:absent', count(*) FROM orders) WHERE n > 0""")
def rule_violations(spark, sf):
    rules = DatasetRules("orders", "1", (
        ColumnRule("o_orderkey", "int64"),
        ColumnRule("o_totalprice", "float64", allowed_range=(1000.0, 400000.0)),
        ColumnRule("o_orderpriority", "string", "categorical", allowed_values=("1-URGENT", "2-HIGH")),
        ColumnRule("o_custkey", "string"),
        ColumnRule("discount", "float32"),
    ))
    return rules.violation_counts(table(spark, sf, "orders"))


_RECORD = """(SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 51 = 0 THEN 'nan'::DOUBLE
  WHEN event_id % 53 = 0 THEN 'inf'::DOUBLE ELSE value END AS amount FROM events)"""


@query(f"""WITH s AS (SELECT avg(value) AS m, greatest(stddev_samp(value), 1e-8) AS d FROM events),
r AS (SELECT event_id, amount, abs((amount - m) / d) AS z FROM {_RECORD}, s)
SELECT event_id,
  CASE WHEN amount IS NULL THEN 'Missing required feature: amount' WHEN isnan(amount) THEN 'Feature amount is NaN'
       WHEN isinf(amount) THEN 'Feature amount is infinite' ELSE '' END AS errors,
  CASE WHEN isnan(amount) OR amount IS NULL THEN '' WHEN isinf(amount)
       THEN 'Feature amount is an outlier (z-score: Infinity)'
       WHEN z > 3 THEN printf('Feature amount is an outlier (z-score: %.2f)', z) ELSE '' END AS warnings,
  (amount IS NOT NULL AND NOT isnan(amount) AND NOT isinf(amount)) AS valid FROM r""")
def record_validation(spark, sf):
    events = table(spark, sf, "events")
    known = serving.stats_of(stats.column_stats(events, ["value"]))["value"]
    key = F.col("event_id")
    amount = (
        F.when(key % 50 == 0, F.lit(None)).when(key % 51 == 0, F.lit(float("nan")))
        .when(key % 53 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    )
    checked = quality.validate_records(events.select("event_id", amount.alias("amount")), ["amount"], {"amount": known})
    return checked.select("event_id", F.concat_ws("|", "errors").alias("errors"),
                          F.concat_ws("|", "warnings").alias("warnings"), "valid")


@query("""SELECT count(embedding) AS num_vectors, min(len(embedding)) AS min_length, max(len(embedding)) AS max_length,
  count(label) AS num_targets, count(embedding) > 0 AND min(len(embedding)) = max(len(embedding))
  AND count(label) = count(embedding) AS valid FROM embeddings""")
def vector_shape_check(spark, sf):
    return rounded(quality.vector_shape(table(spark, sf, "embeddings"), "embedding", "label"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax FROM lineitem""")
def numeric_projection(spark, sf):
    return rounded(quality.numeric_projection(table(spark, sf, "lineitem")), 2)


# ---------------------------------------------------------- filters, mapping


def _filtered(spark, sf, *conditions):
    steps = [{"type": "filter", "column": c, "condition": t} for c, t in conditions]
    df = filters.apply_steps(table(spark, sf, "lineitem"), steps)
    return df.select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query("SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity)")
def filter_not_null(spark, sf):
    return _filtered(spark, sf, ("l_quantity", "not_null"))


@query("SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem WHERE l_quantity > 24.5 AND NOT isnan(l_quantity)")
def filter_gt(spark, sf):
    return _filtered(spark, sf, ("l_quantity", "gt:24.5"))


@query("SELECT l_orderkey, l_partkey, l_quantity, l_discount FROM lineitem WHERE l_discount < 0.05::DOUBLE AND l_quantity IS NOT NULL")
def filter_lt(spark, sf):
    return _filtered(spark, sf, ("l_quantity", "not_null"), ("l_discount", "lt:0.05"), ("l_tax", "other"))


@query("""SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS revenue,
  l_returnflag = 'R' AS returned FROM lineitem""")
def map_expression(spark, sf):
    df = filters.apply_steps(table(spark, sf, "lineitem"), [
        {"type": "map", "name": "revenue", "expr": "round(l_extendedprice * (1 - l_discount), 4)"},
        {"type": "map", "name": "returned", "expr": "l_returnflag = 'R'"},
    ])
    return df.select("l_orderkey", "l_partkey", "revenue", "returned")


@query("""SELECT l_orderkey, coalesce(CASE WHEN l_linenumber > 2 THEN l_quantity END, l_discount) AS feature_1_norm,
  CASE WHEN l_linenumber > 1 THEN l_tax END AS feature_2_norm, l_extendedprice AS feature_3, l_discount AS feature_4,
  l_linenumber > 1 AS valid FROM lineitem""")
def model_input_projection(spark, sf):
    line = F.col("l_linenumber")
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(line > 2, F.col("l_quantity")).alias("feature_1_norm"),
        F.col("l_discount").alias("feature_1"), F.when(line > 1, F.col("l_tax")).alias("feature_2"),
        F.col("l_extendedprice").alias("feature_3"), F.col("l_discount").alias("feature_4"),
    )
    names = ["feature_1_norm", "feature_2_norm", "feature_3", "feature_4"]
    return filters.model_input(df, names, keep=["l_orderkey"], on_missing="flag")


# ------------------------------------------------------------------- recipes


def _made(spark, sf, recipe: Recipe, *names: str) -> DataFrame:
    return rounded(recipe.transform(_frame(spark, sf)).select("id", *names))


@query(f"SELECT id, round(feature_1 * feature_2, 6) AS feature_1_feature_2_interaction FROM {FRAME}")
def feat_interaction(spark, sf):
    return _made(spark, sf, Recipe().add_interaction("feature_1", "feature_2"), "feature_1_feature_2_interaction")


@query(f"SELECT id, round(pow(feature_1, 2), 6) AS feature_1_poly_2, round(pow(feature_2, 3), 6) AS cube FROM {FRAME}")
def feat_polynomial(spark, sf):
    recipe = Recipe().add_polynomial("feature_1").add_polynomial("feature_2", 3, "cube")
    return _made(spark, sf, recipe, "feature_1_poly_2", "cube")


@query(f"SELECT id, round(ln(abs(feature_3) + 1e-8), 6) AS feature_3_log, round(ln(abs(feature_4) + 1), 6) AS log1 FROM {FRAME}")
def feat_log(spark, sf):
    recipe = Recipe().add_log("feature_3").add_log("feature_4", "log1", 1.0)
    return _made(spark, sf, recipe, "feature_3_log", "log1")


_BIN = "len(list_filter(range(1, {n}), lambda i: {x} > mn + i * ((mx - mn) / {n})))"


@query(f"""SELECT event_id, {_BIN.format(n=10, x='value')}::BIGINT AS value_binned,
  (['low', 'mid', 'high'])[{_BIN.format(n=3, x='value')} + 1] AS level
FROM events, (SELECT min(value) AS mn, max(value) AS mx FROM events)""")
def feat_binning(spark, sf):
    recipe = Recipe().add_binning("value").add_binning("value", 3, "level", ["low", "mid", "high"])
    return rounded(recipe.transform(table(spark, sf, "events")).select("event_id", "value_binned", "level"))


@query(f"""SELECT id, round((feature_3 - m) / greatest(s, 1e-8), 6) AS feature_3_standardized
FROM {FRAME}, (SELECT avg(feature_3) AS m, stddev_samp(feature_3) AS s FROM {FRAME})""")
def feat_standardize(spark, sf):
    return _made(spark, sf, Recipe().add_standardization("feature_3"), "feature_3_standardized")


@query(f"""WITH a AS (SELECT *, feature_1 * feature_2 AS pair FROM {FRAME}),
b AS (SELECT avg(pair) AS m, stddev_samp(pair) AS s, min(feature_3) AS mn, max(feature_3) AS mx FROM a)
SELECT id, round((pair - m) / s, 6) AS pair_standardized, {_BIN.format(n=4, x='feature_3')}::BIGINT AS feature_3_binned,
  round(ln(abs((pair - m) / s) + 1), 6) AS pair_log, round(feature_4 + feature_2, 6) AS charge FROM a, b""")
def feature_recipe(spark, sf):
    recipe = (
        Recipe().add_interaction("feature_1", "feature_2", "pair").add_standardization("pair")
        .add_binning("feature_3", 4).add_log("pair_standardized", "pair_log", 1.0)
        .add_expression("charge", "feature_4 + feature_2")
    )
    return _made(spark, sf, recipe, "pair_standardized", "feature_3_binned", "pair_log", "charge")


def sql_scaled(method: str, clip: str | None = "winsorize") -> str:
    """The fitted transform of the frame: statistics first, then clip and scale each feature."""
    stat = ", ".join(
        f"avg({c}) AS m_{c}, greatest(stddev_samp({c}), 1e-8) AS s_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}, "
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in FEATURES
    )

    def clipped(c: str) -> str:
        z = f"abs({c} - m_{c}) / s_{c}"
        if clip == "winsorize":
            return f"(CASE WHEN {z} > 3 THEN m_{c} + sign({c} - m_{c}) * 3 * s_{c} ELSE {c} END)"
        return f"(CASE WHEN {z} <= 3 THEN {c} END)" if clip == "null" else c

    def scaled(c: str) -> str:
        x = clipped(c)
        if method == "standard":
            return f"({x} - m_{c}) / s_{c}"
        low, high = (f"lo_{c}", f"hi_{c}") if method == "minmax" else (f"q1_{c}", f"q3_{c}")
        return f"({x} - {low}) / greatest({high} - {low}, 1e-8)"

    outs = ", ".join(f"{scaled(c)} AS {c}_norm" for c in FEATURES)
    return f'(SELECT id, "timestamp", target, {outs} FROM {FRAME} f, (SELECT {stat} FROM {FRAME}) g)'


_NORMED = ", ".join(f"round({c}_norm, 6) AS {c}_norm" for c in FEATURES)
_DEFAULT = """round(feature_1_norm * feature_2_norm, 6) AS feature_1_norm_feature_2_norm_interaction,
  round(pow(feature_1_norm, 2), 6) AS feature_1_norm_poly_2, round(pow(feature_2_norm, 2), 6) AS feature_2_norm_poly_2,
  round(ln(abs(feature_3_norm) + 1), 6) AS feature_3_log, round(ln(abs(feature_4_norm) + 1), 6) AS feature_4_log"""


@query(f"SELECT id, target, {_NORMED}, {_DEFAULT} FROM {sql_scaled('standard')}", "default_recipe")
def default_features(spark, sf):
    scaled = Preprocessor().fit_transform(_frame(spark, sf))
    return rounded(default_recipe().transform(scaled).drop("timestamp"))


@query("""SELECT l_orderkey, round(coalesce(CASE WHEN l_linenumber > 3 THEN l_tax END, l_quantity * l_discount), 6)
  AS feature_interaction FROM lineitem""")
def interaction_fill(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").alias("feature_1"), F.col("l_discount").alias("feature_2"),
        F.when(F.col("l_linenumber") > 3, F.col("l_tax")).alias("feature_interaction"),
    )
    return rounded(fill_interaction(df).select("l_orderkey", "feature_interaction"))


# ------------------------------------------------------------- preprocessing


def _stat_rows(spark: SparkSession, found: dict[str, dict]) -> DataFrame:
    names = ("mean", "std", "min", "max", "q25", "q75")
    rows = [(f, *[float(s[n]) if s[n] is not None else None for n in names]) for f, s in found.items()]
    return spark.createDataFrame(rows, "feature string, " + ", ".join(f"{n} double" for n in names))


@query(_union([
    f"""SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min,
  max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.75), 4) AS q75 FROM {FRAME}"""
    for c in FEATURES
]))
def preprocess_fit(spark, sf):
    fitted = Preprocessor().fit(_frame(spark, sf)).complete()
    return rounded(_stat_rows(spark, fitted.stats), 4)


_CLIP = """SELECT event_id, round({e}, 6) AS clipped
FROM events, (SELECT avg(value) AS m, greatest(stddev_samp(value), 1e-8) AS s FROM events)"""


def _clipped(spark, sf, mode):
    from feldspark.functions import expressions as X

    events = table(spark, sf, "events")
    s = serving.stats_of(stats.column_stats(events, ["value"]))["value"]
    clip = X.winsorize if mode == "winsorize" else X.drop_outlier
    return rounded(events.select("event_id", clip(F.col("value"), s["mean"], s["std"], 3.0).alias("clipped")))


@query(_CLIP.format(e="CASE WHEN abs(value - m) / s > 3 THEN m + sign(value - m) * 3 * s ELSE value END"))
def clip_winsorize(spark, sf):
    return _clipped(spark, sf, "winsorize")


@query(_CLIP.format(e="CASE WHEN abs(value - m) / s <= 3 THEN value END"))
def clip_null(spark, sf):
    return _clipped(spark, sf, "null")


def _scaled(spark, sf, **options):
    return rounded(Preprocessor(**options).fit_transform(_frame(spark, sf)).drop("timestamp"))


@query(f"SELECT id, target, {_NORMED} FROM {sql_scaled('standard', None)}")
def scale_standard(spark, sf):
    return _scaled(spark, sf, scaling_method="standard", clip_outliers=False)


@query(f"SELECT id, target, {_NORMED} FROM {sql_scaled('minmax', None)}")
def scale_minmax(spark, sf):
    return _scaled(spark, sf, scaling_method="minmax", clip_outliers=False)


@query(f"SELECT id, target, {_NORMED} FROM {sql_scaled('robust', None)}")
def scale_robust(spark, sf):
    return _scaled(spark, sf, scaling_method="robust", clip_outliers=False)


@query(f"SELECT id, target, {_NORMED} FROM {sql_scaled('robust', 'winsorize')}")
def preprocess_transform(spark, sf):
    return _scaled(spark, sf, scaling_method="robust")


@query(f"SELECT id, target, {_NORMED} FROM {sql_scaled('standard', 'null')}")
def preprocess_state_roundtrip(spark, sf):
    frame, path = _frame(spark, sf), scratch_path(spark, "state")
    Preprocessor(clip_mode="null").fit(frame).save(spark, path)
    return rounded(Preprocessor.load(spark, path).transform(frame).drop("timestamp"))


@query(f"SELECT id, target, strftime(\"timestamp\", '%Y-%m-%d') AS day, {_NORMED} FROM {sql_scaled('standard')}")
def preprocess_end_to_end(spark, sf):
    done = preprocess_table(spark, _frame(spark, sf), scratch_path(spark, "processed"), scratch_path(spark, "state"))
    return rounded(done.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")).drop("timestamp"))


# -------------------------------------------------------------- aggregations

_STATS_SQL = _union([
    f"""SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min,
  max({c}) AS max, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {FRAME}"""
    for c in FEATURES
])


@query(_STATS_SQL)
def column_stats(spark, sf):
    return rounded(stats.column_stats(_frame(spark, sf)), 4)


_ITEM_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(_union([
    f"""SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_pop({c}::DOUBLE), 4) AS std,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, count({c}) AS count FROM lineitem""" for c in _ITEM_NUMBERS
]))
def record_stats(spark, sf):
    return rounded(stats.record_stats(table(spark, sf, "lineitem")), 4)


@query("""SELECT event_type AS feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
  min(value) AS min, max(value) AS max, count(value) AS count FROM events GROUP BY event_type""")
def record_stats_map(spark, sf):
    records = table(spark, sf, "events").select(F.create_map("event_type", "value").alias("record"))
    return rounded(stats.record_stats_map(records, "record"))


@query("""WITH e AS (SELECT l_extendedprice / 1000 AS y, l_quantity * 2 AS p FROM lineitem)
SELECT round(avg(pow(y - p, 2)), 4) AS val_mse, round(sqrt(avg(pow(y - p, 2))), 4) AS val_rmse,
  round(avg(abs(y - p)), 4) AS val_mae, round(1 - sum(pow(y - p, 2)) / (count(*) * var_pop(y)), 6) AS val_r2 FROM e""")
def regression_metrics(spark, sf):
    df = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 2).alias("p")
    )
    found = stats.regression_metrics(df, "y", "p", prefix="val_")
    return rounded(rounded(found, 6, ["val_r2"]), 4, ["val_mse", "val_rmse", "val_mae"])


@query(f"SELECT target, count(*) AS n FROM {FRAME} GROUP BY target")
def target_distribution(spark, sf):
    return stats.target_distribution(_frame(spark, sf), "target")


@query("""WITH b AS (SELECT dayofmonth(ts) AS epoch, user_id, avg(value) AS m, sum(value) AS s, count(value) AS n
  FROM events GROUP BY ALL)
SELECT epoch, round(avg(m), 6) AS loss, round(sum(s) / sum(n), 6) AS row_loss, count(*) AS num_batches FROM b GROUP BY epoch""")
def epoch_loss(spark, sf):
    df = table(spark, sf, "events").withColumn("epoch", F.dayofmonth("ts"))
    return rounded(stats.epoch_loss(df, "epoch", "user_id", "value"))


# -------------------------------------------------------------------- splits

_BUCKET = sql_uniform(42, "o_orderkey")
_CASE = "CASE WHEN rn <= {a} THEN 'train' WHEN rn <= {a} + {b} THEN 'validation' ELSE 'test' END AS split"
_FLOORS = {"a": "floor(n * 0.7::DOUBLE)", "b": "floor(n * 0.15::DOUBLE)"}


@query(f"""SELECT o_orderkey, CASE WHEN {_BUCKET} < 0.7::DOUBLE THEN 'train'
  WHEN {_BUCKET} < 0.7::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM orders""")
def split_random(spark, sf):
    return splits.random_split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "split")


@query(f"SELECT o_orderkey, CASE WHEN {_BUCKET} < 1 - 0.2::DOUBLE THEN 'train' ELSE 'validation' END AS split FROM orders")
def split_holdout(spark, sf):
    return splits.holdout(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "split")


_STRATA_SQL = f"""SELECT o_orderkey, o_orderstatus, {_CASE.format(**_FLOORS)} FROM (
  SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_digest(42, 'o_orderkey')}) AS rn FROM orders)"""


@query(_STRATA_SQL)
def split_stratified(spark, sf):
    df = splits.stratified_split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus")
    return df.select("o_orderkey", "o_orderstatus", "split")


@query(_STRATA_SQL)
def split_stratified_binned(spark, sf):
    df = splits.stratified_split(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", bin_rows=50)
    return df.select("o_orderkey", "o_orderstatus", "split")


@query(f"""SELECT event_id, {_CASE.format(**_FLOORS)} FROM (
  SELECT event_id, count(*) OVER () AS n, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)""")
def split_time(spark, sf):
    return splits.time_split(table(spark, sf, "events"), "ts", "event_id").select("event_id", "split")


@query(f"""SELECT o_orderkey, {_CASE.format(**_FLOORS)} FROM (
  SELECT o_orderkey, count(*) OVER () AS n, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""")
def split_time_ties(spark, sf):
    return splits.time_split(table(spark, sf, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", "split")


_GROUPS_SQL = f"""WITH g AS (SELECT user_id, count(*) OVER () AS n, row_number() OVER (ORDER BY {_digest(42, 'user_id')}) AS rn
  FROM (SELECT DISTINCT user_id FROM events))
SELECT event_id, user_id, {_CASE.format(**_FLOORS)} FROM events JOIN g USING (user_id)"""


@query(_GROUPS_SQL)
def split_group(spark, sf):
    return splits.group_split(table(spark, sf, "events"), "user_id").select("event_id", "user_id", "split")


@query(_GROUPS_SQL)
def split_group_binned(spark, sf):
    return splits.group_split(table(spark, sf, "events"), "user_id", bin_rows=20).select("event_id", "user_id", "split")


@query("SELECT event_id, user_id, n FROM events JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) USING (user_id)")
def lookup_salted(spark, sf):
    events = table(spark, sf, "events")
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return join_lookup(events, counts, ["user_id"], max_rows=1, salts=4, hot_rows=20).select("event_id", "user_id", "n")


# --------------------------------------------------------------------- store


def _store(spark: SparkSession) -> FeatureStore:
    return FeatureStore(spark, scratch_path(spark, "store"))


@query(_STATS_SQL)
def store_write_stats(spark, sf):
    store = _store(spark)
    store.write(_frame(spark, sf), "items", "v1", tags={"source": "lineitem"})
    columns = ["feature", "mean", "std", "min", "max", "count", "null_count"]
    return rounded(flat_metadata(store.catalog()).select(*columns), 4)


@query(f"SELECT id, feature_1, feature_2 * 3 AS feature_2, 'v10' AS version FROM {FRAME}")
def store_read_latest(spark, sf):
    store, frame = _store(spark), _frame(spark, sf).select("id", "feature_1", "feature_2")
    for i, version in enumerate(("v1", "v9", "v10"), 1):
        store.write(frame.withColumn("feature_2", F.col("feature_2") * i), "items", version)
    df, known = store.read("items")
    return df.withColumn("version", F.lit(known.version))


@query("""SELECT 'orders' AS name, 'v2' AS version, count(*) AS num_rows, 'o_orderstatus' AS partitions,
  'from orders' AS description, 'gold' AS tier, 'feature_1:double,key:bigint,o_orderstatus:string' AS columns FROM orders""")
def store_metadata(spark, sf):
    store = _store(spark)
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("feature_1"), "o_orderstatus"
    )
    store.write(df, "orders", "v1")
    store.write(df, "orders", "v2", "from orders", {"tier": "gold"}, ["o_orderstatus"])
    columns = F.transform(F.array_sort(F.map_entries("schema")), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return store.catalog().filter((F.col("name") == "orders") & (F.col("version") == "v2")).select(
        "name", "version", "num_rows", F.concat_ws(",", "partitions").alias("partitions"), "description",
        F.col("tags")["tier"].alias("tier"), F.concat_ws(",", columns).alias("columns"),
    )


@query("""SELECT 'events' AS name, 'b' AS latest_version, count(*) FILTER (WHERE value > 50) AS num_rows, 2::BIGINT AS num_versions FROM events
UNION ALL SELECT 'orders', 'only', count(*), 1 FROM orders""")
def store_list(spark, sf):
    store, events = _store(spark), table(spark, sf, "events").select("event_id", "value")
    store.write(events, "events", "a")
    store.write(events.filter("value > 50"), "events", "b")
    store.write(table(spark, sf, "orders").select("o_orderkey"), "orders", "only")
    return store.list_datasets().drop("created_at")


@query("""SELECT 'events' AS name, 'b' AS version, count(*) AS num_rows FROM events
UNION ALL SELECT 'orders', 'b', count(*) FILTER (WHERE o_totalprice > 100000) FROM orders""")
def store_delete(spark, sf):
    """What is left after one version, one whole dataset and a replaced version."""
    store, events, orders = _store(spark), table(spark, sf, "events").select("event_id"), table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for version in ("a", "b"):
        store.write(events, "events", version)
        store.write(orders, "orders", version)
        store.write(orders, "gone", version)
    store.write(orders.filter("o_totalprice > 100000"), "orders", "b", overwrite=True)
    store.delete("events", "a")
    store.delete("orders", "a")
    store.delete("gone")
    rows = [(name, *(lambda df, known: (known.version, df.count()))(*store.read(name))) for name in ("events", "orders")]
    left = spark.createDataFrame(rows, "name string, version string, num_rows long")
    return store.catalog().select("name", "version").join(left, ["name", "version"])


@query("""SELECT l_returnflag AS flag, CASE WHEN l_returnflag = 'N' THEN 'error' ELSE 'success' END AS status,
  CASE WHEN l_returnflag <> 'N' THEN count(*)::VARCHAR END AS result, CASE WHEN l_returnflag = 'N' THEN 'ValueError: not returned' END AS error
FROM lineitem GROUP BY l_returnflag""")
def run_series(spark, sf):
    """A run per return flag, one of which fails while the others go on."""
    items = table(spark, sf, "lineitem")
    flags = [r[0] for r in items.select("l_returnflag").distinct().orderBy("l_returnflag").collect()]

    def run(config):
        if config["flag"] == "N":
            raise ValueError("not returned")
        return items.filter(F.col("l_returnflag") == config["flag"]).count()

    done = runs.run_series(spark, [{"flag": f} for f in flags], run)
    names = spark.createDataFrame(list(enumerate(flags)), "run int, flag string")
    return done.join(names, "run").select("flag", "status", "result", "error")


@query("""SELECT 4::BIGINT AS bins, CASE WHEN l_quantity IS NOT NULL THEN 1::BIGINT END AS bin, count(*) AS n FROM lineitem GROUP BY ALL""")
def constant_bins(spark, sf):
    """A column with one value equals the middle edge; intervals are closed on the right, so it falls below."""
    items = table(spark, sf, "lineitem").select(F.when(F.col("l_quantity").isNotNull(), F.lit(3.0)).alias("x"))
    low, high = items.agg(F.min("x"), F.max("x")).first()
    index = bin_index(F.col("x"), bin_edges(low, high, 4))
    return items.select(F.lit(4).cast("long").alias("bins"), index.cast("long").alias("bin")).groupBy("bins", "bin").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10")
def source_factory(spark, sf):
    items = create_source(spark, "parquet", path=f"{sf}/lineitem.parquet", schema_validation=False)
    return items.filter("l_quantity > 10").select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"SELECT id, target, {_NORMED}, {_DEFAULT}, 'features' AS stage FROM {sql_scaled('minmax')}")
def feature_store_build(spark, sf):
    store, scaled = _store(spark), Preprocessor("minmax").fit_transform(_frame(spark, sf))
    df, known = store.read("features", build_features(store, scaled, "features"))
    return rounded(df.drop("timestamp").withColumn("stage", F.lit(known.tags["stage"])))


# ------------------------------------------------------------------- serving


@query(f"""WITH s AS (SELECT avg(feature_1) AS m1, stddev_samp(feature_1) AS s1, avg(feature_2) AS m2, stddev_samp(feature_2) AS s2 FROM {FRAME})
SELECT id, feature_1, feature_2, round((feature_1 - m1) / s1, 6) AS feature_1_norm,
  round((feature_2 - m2) / s2, 6) AS feature_2_norm,
  round(((feature_1 - m1) / s1) * ((feature_2 - m2) / s2), 6) AS feature_interaction FROM {FRAME}, s""")
def serve_transform(spark, sf):
    store, frame = _store(spark), _frame(spark, sf).select("id", "feature_1", "feature_2")
    store.write(frame, "features", "v1")
    return rounded(serving.transform_records(frame, store.metadata("features").feature_stats))


@query(f"""SELECT 'features' AS name, 'v1' AS version, c AS "column", t AS type, count(*) AS num_rows FROM {FRAME},
(VALUES ('id', 'bigint'), ('feature_1', 'double'), ('target', 'bigint')) AS k(c, t) GROUP BY ALL""")
def stored_schema(spark, sf):
    store = _store(spark)
    store.write(_frame(spark, sf).select("id", "feature_1", "target"), "features", "v1")
    return store.catalog().select("name", "version", F.explode("schema").alias("column", "type"), "num_rows")


@query(_union([
    f"""SELECT 'custom' AS name, 1::BIGINT AS num_features, 'value' AS feature, round(avg(value), 6) AS mean,
  round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, count(value) AS count FROM events"""
]))
def stats_save_roundtrip(spark, sf):
    path = scratch_path(spark, "stats")
    found = serving.stats_of(stats.record_stats(table(spark, sf, "events"), ["value"]))
    serving.save_stats(spark, path, found, "custom", "values of events")
    return rounded(serving.load_stats(spark, path).drop("description", "created_at"))


@query("""SELECT l_orderkey, l_quantity, round(i + l_quantity * s, 3) AS prediction FROM lineitem,
(SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)""")
def batch_score(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    model = models.linear_regression(items, ["l_quantity"], "l_extendedprice")
    return rounded(model.transform(items).drop("l_extendedprice"), 3)


_UUID = "concat_ws('-', substr(d, 1, 8), substr(d, 9, 4), substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12))"


@query(f"""SELECT {_UUID} AS prediction_id, 'batch-1' AS batch_id, event_id, round(1 + value * 2, 6) AS prediction,
  'v3' AS model_version, value AS input FROM (SELECT *, md5('batch-1:' || event_id) AS d FROM events)""")
def prediction_log(spark, sf):
    scored = serving.score_linear(table(spark, sf, "events"), ["value"], [2.0], 1.0)
    log = serving.prediction_log(scored, "event_id", "v3", "batch-1", features=["value"])
    return rounded(log.withColumn("input", F.col("features.value")).drop("features", "timestamp"))


@query("SELECT 'batch-1' AS batch_id, 'v3' AS model_version, count(*) AS count FROM events")
def prediction_batches(spark, sf):
    scored = serving.score_linear(table(spark, sf, "events"), ["value"], [2.0], 1.0)
    return serving.batch_summary(serving.prediction_log(scored, "event_id", "v3", "batch-1"))


@query("""WITH r AS (SELECT l_suppkey AS model, CASE WHEN l_suppkey % 3 = 0 THEN 'v' || l_linenumber ELSE l_partkey::VARCHAR END AS version FROM lineitem)
SELECT model, coalesce(max_by(version, try_cast(version AS BIGINT)) FILTER (WHERE try_cast(version AS BIGINT) IS NOT NULL), max(version)) AS latest_version
FROM r GROUP BY model""")
def model_latest(spark, sf):
    registry = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("model"),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("v"), "l_linenumber"))
        .otherwise(F.col("l_partkey").cast("string")).alias("version"),
    )
    return serving.latest_versions(registry)


# ------------------------------------------------------------ models, tuning

_PAIR = """SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
  var_pop(l_quantity) + {a} / count(*) AS s11, var_pop(l_discount) + {a} / count(*) AS s22, covar_pop(l_quantity, l_discount) AS s12,
  covar_pop(l_quantity, l_extendedprice) AS t1, covar_pop(l_discount, l_extendedprice) AS t2 FROM lineitem"""


def _weights_sql(alpha: str) -> str:
    return f"""WITH c AS ({_PAIR.format(a=alpha)}),
w AS (SELECT *, (t1 * s22 - t2 * s12) / (s11 * s22 - s12 * s12) AS w1, (t2 * s11 - t1 * s12) / (s11 * s22 - s12 * s12) AS w2 FROM c)
SELECT 'l_quantity' AS term, round(w1, 3) AS weight FROM w UNION ALL SELECT 'l_discount', round(w2, 3) FROM w
UNION ALL SELECT 'intercept', round(my - w1 * m1 - w2 * m2, 3) FROM w"""


def _weight_rows(spark: SparkSession, model: models.LinearModel) -> DataFrame:
    rows = [*zip(model.features, model.weights, strict=True), ("intercept", model.intercept)]
    return rounded(spark.createDataFrame(rows, "term string, weight double"), 3)


@query(_weights_sql("0"))
def linear_regression(spark, sf):
    items = table(spark, sf, "lineitem")
    return _weight_rows(spark, models.linear_regression(items, ["l_quantity", "l_discount"], "l_extendedprice"))


@query(_weights_sql("25::DOUBLE"))
def ridge_regression(spark, sf):
    items = table(spark, sf, "lineitem")
    return _weight_rows(spark, models.ridge_regression(items, ["l_quantity", "l_discount"], "l_extendedprice", 25.0))


@query(_weights_sql("1::DOUBLE"))
def model_registry_roundtrip(spark, sf):
    registry = models.ModelRegistry(spark, scratch_path(spark, "models"))
    items = table(spark, sf, "lineitem")
    registry.save("price", "1", models.ridge_regression(items, ["l_quantity", "l_discount"], "l_extendedprice", 1.0))
    return _weight_rows(spark, registry.load("price", "1"))


@query()
def random_forest(spark, sf):
    features = ["l_quantity", "l_discount", "l_tax"]
    items = table(spark, sf, "lineitem")
    fitted = models.random_forest(items, features, "l_extendedprice")
    return stats.regression_metrics(
        models.forest_predictions(fitted, items, features, "l_extendedprice"), "l_extendedprice", "prediction"
    )


_CHARGE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _charged(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return items.select(*_CHARGE, price.alias("charge"))


@query()
def mlp_train_history(spark, sf):
    items = _charged(spark, sf)
    return history_frame(train_mlp(items, _CHARGE, "charge"), items)


@query()
def mlp_score(spark, sf):
    items = _charged(spark, sf)
    model = train_mlp(items, _CHARGE, "charge")
    return stats.regression_metrics(model.transform(items), "charge", "prediction")


_BUCKETED = f"""(SELECT o_custkey::DOUBLE AS x, o_totalprice AS y, {sql_uniform(42, 'o_orderkey')} < 1 - 0.2::DOUBLE AS fitted
  FROM orders WHERE o_totalprice > 2000)"""


@query(f"""WITH w AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM {_BUCKETED} WHERE fitted),
e AS (SELECT fitted, y, y - i - s * x AS d FROM {_BUCKETED}, w)
SELECT CASE WHEN fitted THEN 'train' ELSE 'validation' END AS split, round(avg(abs(d)), 3) AS mae, round(avg(d * d), 0) AS mse, round(sqrt(avg(d * d)), 3) AS rmse,
  round(1 - sum(d * d) / (count(*) * var_pop(y)), 6) AS r2 FROM e GROUP BY fitted""")
def train_on_store(spark, sf):
    store, registry = _store(spark), models.ModelRegistry(spark, scratch_path(spark, "models"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("double").alias("feature_1"),
        F.col("o_totalprice").alias("target"), F.col("o_orderstatus").alias("label"),
    )
    store.write(orders, "orders", "v1")
    steps = [{"type": "filter", "column": "target", "condition": "gt:2000"}]
    _, found = train_from_store(store, "orders", registry, "price", target="target", key="id", steps=steps)
    return rounded(rounded(rounded(found.select("split", "mae", "mse", "rmse", "r2"), 6, ["r2"]), 3, ["mae", "rmse"]), 0, ["mse"])


@query(f"""WITH s AS (SELECT avg(feature_1) AS m1, stddev_samp(feature_1) AS s1, avg(feature_2) AS m2, stddev_samp(feature_2) AS s2 FROM {FRAME})
SELECT id, '4' AS model_version, 'b7' AS batch_id,
  round(0.5 + 2 * (feature_1 - m1) / s1 - (feature_2 - m2) / s2 + 0.25 * feature_3, 4) AS prediction FROM {FRAME}, s""")
def score_on_stored_stats(spark, sf):
    store, frame = _store(spark), _frame(spark, sf).select("id", "feature_1", "feature_2", "feature_3")
    store.write(frame, "features", "v1")
    model = models.LinearModel(["feature_1_norm", "feature_2_norm", "feature_3"], [2.0, -1.0, 0.25], 0.5)
    stored = {k: v for k, v in store.metadata("features").feature_stats.items() if k != "feature_3"}
    log = score_records(frame, stored, model, key="id", version="4", batch="b7")
    return rounded(log.select("id", "model_version", "batch_id", "prediction"), 4)


def _sql_choice(name: str, values: Sequence[int]) -> str:
    draw = sql_uniform(42, f"'{name}'", "p_partkey")
    return f"({list(values)})[floor({draw} * {len(values)})::INT + 1]::BIGINT AS {name}"


@query(f"""SELECT p_partkey AS trial,
  round(exp(ln(1e-4) + {sql_uniform(42, "'learning_rate'", 'p_partkey')} * (ln(1e-2) - ln(1e-4))), 9) AS learning_rate,
  round(0.1 + {sql_uniform(42, "'dropout_rate'", 'p_partkey')} * 0.4, 9) AS dropout_rate,
  {_sql_choice('batch_size', tuning.BATCH_SIZES)}, {_sql_choice('hidden_dim', tuning.HIDDEN_DIMS)},
  {_sql_choice('num_layers', tuning.LAYERS)} FROM part""")
def search_space(spark, sf):
    return rounded(tuning.search_space(table(spark, sf, "part").select(F.col("p_partkey").alias("trial"))), 9)


_ALPHAS = (0.0, 1e9, 1e11, 1e13)


@query(f"""WITH r AS (SELECT l_extendedprice AS x, l_quantity AS y,
    {sql_uniform(42, 'l_extendedprice', 'l_quantity')} < 0.2::DOUBLE AS held FROM lineitem),
m AS (SELECT held, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS c FROM r GROUP BY held),
w AS (SELECT trial, alpha, c / (vx + alpha / n) AS w, my - mx * (c / (vx + alpha / n)) AS b FROM m,
  (VALUES {', '.join(f'({i}, {a!r}::DOUBLE)' for i, a in enumerate(_ALPHAS))}) AS t(trial, alpha) WHERE NOT held)
SELECT trial::BIGINT AS trial, alpha,
  round(max(CASE WHEN NOT held THEN vy - 2 * w * c + w * w * vx + pow(my - mx * w - b, 2) END), 6) AS train_loss,
  round(max(CASE WHEN held THEN vy - 2 * w * c + w * w * vx + pow(my - mx * w - b, 2) END), 6) AS val_loss
FROM w, m GROUP BY trial, alpha""")
def tune_trials(spark, sf):
    items = table(spark, sf, "lineitem")
    return rounded(tuning.ridge_trials(items, ["l_extendedprice"], "l_quantity", _ALPHAS))


@query()
def tune_forests(spark, sf):
    items = table(spark, sf, "lineitem")
    return tuning.forest_trials(items, ["l_quantity", "l_discount"], "l_extendedprice", [20, 50], [3, 5])


@query()
def tune_networks(spark, sf):
    """Sampled configurations, each trained in full; the best trial's last epoch beside all others."""
    trials = spark.range(3).withColumnRenamed("id", "trial")
    history, best = tuning.tune_mlp(_charged(spark, sf), _CHARGE, "charge", trials, epochs=3)
    return history.join(best.select(F.col("trial").alias("best")), F.col("trial") == F.col("best"), "left").withColumn(
        "best", F.col("best").isNotNull())


_RATES = (0.05, 0.9)
_TUNE_SQL = f"""WITH RECURSIVE d AS (SELECT l_quantity AS x, l_extendedprice AS y, l_orderkey % 5 = 0 AS held FROM lineitem),
m AS (SELECT held, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS c FROM d GROUP BY held),
f AS (SELECT mx AS cx, my AS cy, sqrt(vx) AS sx, sqrt(vy) AS sy FROM m WHERE NOT held),
s AS (SELECT held, (mx - cx) / sx AS ax, (my - cy) / sy AS ay, vx / (sx * sx) + pow((mx - cx) / sx, 2) AS xx,
  vy / (sy * sy) + pow((my - cy) / sy, 2) AS yy, c / (sx * sy) + (mx - cx) / sx * (my - cy) / sy AS xy FROM m, f),
p AS (SELECT t.*, h.ax AS hax, h.ay AS hay, h.xx AS hxx, h.yy AS hyy, h.xy AS hxy FROM s t, s h WHERE NOT t.held AND h.held),
space AS (SELECT n_nationkey AS trial, exp(ln({_RATES[0]}::DOUBLE) + {sql_uniform(42, "'learning_rate'", 'n_nationkey')} * (ln({_RATES[1]}::DOUBLE) - ln({_RATES[0]}::DOUBLE))) AS rate
  FROM nation),
e AS (SELECT trial, 0 AS epoch, rate, rate AS used, 0::DOUBLE AS b, 0::DOUBLE AS w, 'inf'::DOUBLE AS best, 0 AS waited, 0 AS stalled, NULL::DOUBLE AS train_loss, NULL::DOUBLE AS val_loss FROM space
  UNION ALL SELECT trial, epoch + 1, CASE WHEN gained OR stalled + 1 < 2 THEN rate ELSE greatest(rate * 0.5::DOUBLE, 1e-6::DOUBLE) END, rate, b2, w2,
    CASE WHEN gained THEN held_loss ELSE best END, CASE WHEN gained THEN 0 ELSE waited + 1 END, CASE WHEN gained OR stalled + 1 >= 2 THEN 0 ELSE stalled + 1 END, loss, held_loss
  FROM (SELECT *, held_loss < best - 1e-4 AS gained FROM (
    SELECT *, yy + w2 * w2 * xx + b2 * b2 + 2 * w2 * b2 * ax - 2 * w2 * xy - 2 * b2 * ay AS loss,
      hyy + w2 * w2 * hxx + b2 * b2 + 2 * w2 * b2 * hax - 2 * w2 * hxy - 2 * b2 * hay AS held_loss FROM (
      SELECT e.*, p.*, b - rate * 2 * (b + w * ax - ay) AS b2, w - rate * 2 * (b * ax + w * xx - xy) AS w2 FROM e, p WHERE epoch < 12 AND waited < 4)))),
h AS (SELECT * FROM e WHERE epoch > 0),
z AS (SELECT trial FROM (SELECT trial, val_loss, row_number() OVER (PARTITION BY trial ORDER BY epoch DESC) AS r FROM h) WHERE r = 1 ORDER BY val_loss, trial LIMIT 1)
SELECT trial::BIGINT AS trial, epoch::BIGINT AS epoch, round(used, 9) AS rate, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, trial = (SELECT trial FROM z) AS best FROM h"""


@query(_TUNE_SQL)
def tune_sampled(spark, sf):
    """A sampled rate per nation over one pass of the line items; the trial of least validation loss is the best."""
    trials = table(spark, sf, "nation").select(F.col("n_nationkey").alias("trial"))
    space = tuning.search_space(trials, learning_rate=_RATES)
    start, epoch = tuning.moment_descent(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", F.col("l_orderkey") % 5 == 0)
    history = tuning.tune_sampled(space, start, epoch, epochs=12, patience=4, plateau=2)
    best = tuning.best_trial(tuning.last_epochs(history), "val_loss").first()["trial"]
    out = history.select("trial", "epoch", "rate", "train_loss", "val_loss", (F.col("trial") == best).alias("best"))
    return rounded(rounded(out, 9, ["rate"]), 6, ["train_loss", "val_loss"])


_BLOCKS = 7


def _linear_history_sql() -> str:
    w, b = (float(v) for v in initial_weights([1, 1], 42))
    step = lambda g, p, m, v: f"""{p} - 0.05::DOUBLE * (0.9 * {m} + 0.1 * {g}) / (1 - pow(0.9::DOUBLE, t + 1)) / (sqrt((0.999 * {v} + 0.001 * pow({g}, 2)) / (1 - pow(0.999::DOUBLE, t + 1))) + 1e-8::DOUBLE)"""
    gw, gb = "(2 * (w * k.xx + b * k.x - k.xy))", "(2 * (w * k.x + b - k.y))"
    mean = lambda x: f"list_sum(list_transform(blocks, lambda k: k.n * ({x}))) / list_sum(list_transform(blocks, lambda k: k.n))"
    loss = "(k.yy + w * w * k.xx + b * b + 2 * w * b * k.x - 2 * w * k.xy - 2 * b * k.y)"
    return f"""WITH RECURSIVE d AS (SELECT l_quantity AS x, l_extendedprice AS y, l_orderkey % 5 = 0 AS held, l_orderkey % {_BLOCKS} AS block FROM lineitem),
f AS (SELECT avg(x) AS cx, avg(y) AS cy, stddev_pop(x) AS sx, stddev_pop(y) AS sy FROM d WHERE NOT held),
z AS (SELECT (x - cx) / sx AS x, (y - cy) / sy AS y, held, block FROM d, f),
g AS (SELECT held, block, count(*)::DOUBLE AS n, avg(x) AS x, avg(y) AS y, avg(x * x) AS xx, avg(y * y) AS yy, avg(x * y) AS xy FROM z GROUP BY held, block),
l AS (SELECT (SELECT list({{'n': n, 'x': x, 'y': y, 'xx': xx, 'yy': yy, 'xy': xy}}) FROM g WHERE NOT held) AS blocks,
  (SELECT list({{'n': n, 'x': x, 'y': y, 'xx': xx, 'yy': yy, 'xy': xy}}) FROM g WHERE held) AS kept),
e AS (SELECT 0 AS epoch, 0 AS t, {w!r}::DOUBLE AS w, {b!r}::DOUBLE AS b, 0::DOUBLE AS mw, 0::DOUBLE AS mb, 0::DOUBLE AS vw, 0::DOUBLE AS vb, NULL::DOUBLE AS train_loss
  UNION ALL SELECT epoch + 1, t + 1, {mean(step(gw, 'w', 'mw', 'vw'))}, {mean(step(gb, 'b', 'mb', 'vb'))},
    {mean(f'0.9 * mw + 0.1 * {gw}')}, {mean(f'0.9 * mb + 0.1 * {gb}')}, {mean(f'0.999 * vw + 0.001 * pow({gw}, 2)')}, {mean(f'0.999 * vb + 0.001 * pow({gb}, 2)')},
    {mean(loss)} FROM e, l WHERE epoch < 6)
SELECT epoch::BIGINT AS epoch, round(train_loss, 5) AS train_loss, round({mean(loss).replace('blocks', 'kept')}, 5) AS val_loss, round(w, 5) AS weight, round(b, 5) AS bias FROM e, l WHERE epoch > 0"""


@query(_linear_history_sql())
def mlp_linear_history(spark, sf):
    """A network without hidden layer: one Adam step per block and epoch, averaged, over the whole table."""
    items = table(spark, sf, "lineitem").withColumn("block", F.col("l_orderkey") % _BLOCKS).withColumn("held", F.col("l_orderkey") % 5 == 0)
    ready = prepare_training(items, ["l_quantity"], "l_extendedprice", block="block", held="held")
    weights = {}
    model = train_mlp(
        items, ["l_quantity"], "l_extendedprice", hidden=(), epochs=6, batch_size=1 << 40, learning_rate=0.05, prepared=ready,
        double=True, on_epoch=lambda epoch, m: weights.__setitem__(epoch, m.weights),
    )
    rows = [(h["epoch"], h["train_loss"], h["val_loss"], *weights[h["epoch"]]) for h in model.history]
    return rounded(spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double, weight double, bias double"), 5)


_STUMP = ("l_linenumber", "l_discount", "l_tax")


def _stump_sql() -> str:
    one = " UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS x, l_extendedprice AS y FROM lineitem" for i, c in enumerate(_STUMP))
    return f"""WITH d AS ({one}), v AS (SELECT f, x, count(*)::DOUBLE AS n, sum(y) AS s, sum(y * y) AS q FROM d GROUP BY f, x),
c AS (SELECT f, x, sum(n) OVER a AS n, sum(s) OVER a AS s, sum(q) OVER a AS q, sum(n) OVER w AS tn, sum(s) OVER w AS ts, sum(q) OVER w AS tq
  FROM v WINDOW a AS (PARTITION BY f ORDER BY x), w AS (PARTITION BY f)),
g AS (SELECT *, (q - s * s / n) + ((tq - q) - pow(ts - s, 2) / (tn - n)) AS rest FROM c WHERE n < tn),
best AS (SELECT * FROM g ORDER BY rest, f LIMIT 1)
SELECT f::BIGINT AS feature, 'low' AS side, n::BIGINT AS n, round(s / n, 4) AS prediction FROM best
UNION ALL SELECT f, 'high', (tn - n)::BIGINT, round((ts - s) / (tn - n), 4) FROM best"""


@query(_stump_sql())
def forest_stump(spark, sf):
    """One tree of one split on all rows and features: the split of least squared error."""
    items = table(spark, sf, "lineitem")
    fitted = models.random_forest(items, list(_STUMP), "l_extendedprice", trees=1, depth=1, every_feature=True, all_rows=True, bins=64)
    split = fitted.forest.trees[0]._call_java("rootNode").split()
    scored = models.forest_predictions(fitted, items, list(_STUMP), "l_extendedprice")
    side = F.when(F.col(_STUMP[split.featureIndex()]) <= split.threshold(), "low").otherwise("high")
    out = scored.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("prediction"))
    return rounded(out.select(F.lit(split.featureIndex()).cast("long").alias("feature"), "side", "n", "prediction"), 4)


@query("""WITH t AS (SELECT user_id AS trial, avg(value) AS val_loss, count(*) AS n FROM events GROUP BY user_id)
SELECT * FROM (SELECT 'min' AS mode, trial, round(val_loss, 6) AS val_loss, n FROM t ORDER BY t.val_loss, trial LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'max' AS mode, trial, round(val_loss, 6) AS val_loss, n FROM t ORDER BY t.val_loss DESC, trial LIMIT 1)""")
def best_trial(spark, sf):
    trials = table(spark, sf, "events").groupBy(F.col("user_id").alias("trial")).agg(
        F.avg("value").alias("val_loss"), F.count(F.lit(1)).alias("n")
    )
    low, high = (
        tuning.best_trial(trials, "val_loss", m).select(F.lit(m).alias("mode"), "trial", "val_loss", "n")
        for m in ("min", "max")
    )
    return rounded(low.unionByName(high))


# ---------------------------------------------------------------------- runs

_METRIC_OF = "CASE event_type WHEN 'click' THEN 'val_loss' WHEN 'view' THEN 'train_loss' ELSE 'other' END"


@query(f"""WITH w AS (SELECT user_id % 97 AS run, max(value) FILTER (WHERE m = 'val_loss') AS val_loss, max(value) FILTER (WHERE m = 'train_loss') AS train_loss
  FROM (SELECT *, {_METRIC_OF} AS m FROM events) GROUP BY 1)
SELECT run, val_loss, train_loss, coalesce(run = (SELECT run FROM w WHERE val_loss IS NOT NULL ORDER BY val_loss, run LIMIT 1), false) AS is_best FROM w""")
def compare_runs(spark, sf):
    name = F.when(F.col("event_type") == "click", "val_loss").when(F.col("event_type") == "view", "train_loss").otherwise("other")
    long = table(spark, sf, "events").select((F.col("user_id") % 97).alias("run"), name.alias("metric"), "value")
    return runs.compare_runs(long, "run", "metric", "value", ["val_loss", "train_loss"])


@query("""SELECT event_id, key, value FROM (
  SELECT event_id, 'props.' || k AS key, props ->> k AS value FROM events, unnest(json_keys(props)) AS u(k)
  UNION ALL SELECT event_id, 'type', event_type FROM events)""")
def flatten_props(spark, sf):
    text = F.concat(F.lit('{"type": "'), "event_type", F.lit('", "props": '), "props", F.lit("}"))
    df = table(spark, sf, "events").select("event_id", text.alias("config"))
    return runs.flatten_json(df, "config", ["event_id"])


@query("""SELECT o_orderkey AS "order.key", o_totalprice AS "order.price.total", o_orderstatus AS status FROM orders""")
def flatten_structs(spark, sf):
    df = table(spark, sf, "orders").select(
        F.struct(F.col("o_orderkey").alias("key"), F.struct(F.col("o_totalprice").alias("total")).alias("price")).alias("order"),
        F.col("o_orderstatus").alias("status"),
    )
    return runs.flatten_structs(df)


_RUN_ROWS = "p AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)"


_STOP_SQL = f"""WITH RECURSIVE {_RUN_ROWS},
f(user_id, rn, best, wait, stopped) AS (
  SELECT DISTINCT user_id, 0::BIGINT, 'inf'::DOUBLE, 0, NULL::BIGINT FROM p
  UNION ALL SELECT f.user_id, p.rn, CASE WHEN value < best - 1e-4 THEN value ELSE best END,
    CASE WHEN value < best - 1e-4 THEN 0 ELSE wait + 1 END,
    CASE WHEN NOT value < best - 1e-4 AND wait + 1 >= 5 THEN event_id END
  FROM f JOIN p ON p.user_id = f.user_id AND p.rn = f.rn + 1 WHERE stopped IS NULL)
SELECT user_id, min(best) AS best_loss, max(stopped) AS stopped_epoch FROM f GROUP BY user_id"""


@query(_STOP_SQL)
def early_stop_scan(spark, sf):
    return runs.early_stop(table(spark, sf, "events"), "user_id", "event_id", "value", patience=5)


@query(_STOP_SQL)
def early_stop_blocked(spark, sf):
    return runs.early_stop(table(spark, sf, "events"), "user_id", "event_id", "value", patience=5, block_rows=12)


_RATE_SQL = f"""WITH RECURSIVE {_RUN_ROWS},
f(user_id, event_id, rn, best, wait, lr) AS (
  SELECT DISTINCT user_id, NULL::BIGINT, 0::BIGINT, 'inf'::DOUBLE, 0, 1e-3::DOUBLE FROM p
  UNION ALL SELECT f.user_id, p.event_id, p.rn, CASE WHEN value < best - 1e-4 THEN value ELSE best END,
    CASE WHEN value < best - 1e-4 OR wait + 1 >= 5 THEN 0 ELSE wait + 1 END,
    CASE WHEN NOT value < best - 1e-4 AND wait + 1 >= 5 THEN greatest(lr * 0.5::DOUBLE, 1e-6::DOUBLE) ELSE lr END
  FROM f JOIN p ON p.user_id = f.user_id AND p.rn = f.rn + 1)
SELECT user_id, event_id, round(lr, 9) AS lr FROM f WHERE rn > 0"""


@query(_RATE_SQL)
def lr_schedule_scan(spark, sf):
    return rounded(runs.lr_schedule(table(spark, sf, "events"), "user_id", "event_id", "value"), 9)


@query(_RATE_SQL)
def lr_schedule_blocked(spark, sf):
    return rounded(runs.lr_schedule(table(spark, sf, "events"), "user_id", "event_id", "value", block_rows=12), 9)


@query("""SELECT user_id, event_id, value, rank FROM (SELECT user_id, event_id, value,
  row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rank FROM events) WHERE rank <= 3""")
def topk_checkpoints(spark, sf):
    return rounded(runs.best_checkpoints(table(spark, sf, "events"), "user_id", "event_id", "value"))


# ---------------------------------------------------------------- monitoring


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"


@query(f"SELECT event_id AS seq, event_type AS name, value, user_id AS context, {_TS} FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 250)")
def recent_metrics(spark, sf):
    return _timed(monitoring.recent_metrics(_metrics(spark, sf), 250))


_SPIKES = """(SELECT event_id AS seq, user_id AS context, ts, value, previous FROM (
  SELECT event_id, user_id, ts, value, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS previous FROM events) WHERE previous > 0 AND value > previous * 5)"""


_SPIKES_SQL = f"SELECT seq, context, {_TS}, value, round(previous, 6) AS previous FROM {_SPIKES}"


@query(_SPIKES_SQL)
def loss_spikes(spark, sf):
    return _timed(rounded(monitoring.loss_spikes(_metrics(spark, sf))))


@query(_SPIKES_SQL)
def loss_spikes_hot(spark, sf):
    return _timed(rounded(monitoring.loss_spikes(_metrics(spark, sf), chunk_rows=12)))


# order of text that is alike for many bytes, ties by numbers beyond 2**53
_STRING_SPIKES = """SELECT seq, context, step, value, round(previous, 6) AS previous FROM (
  SELECT event_id + 1152921504606846976 AS seq, user_id AS context, step, value, avg(value) OVER (PARTITION BY user_id ORDER BY step, event_id
    ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS previous FROM (SELECT *, 'runs/checkpoint-' || strftime(ts, '%Y-%m-%d') AS step FROM events))
WHERE previous > 0 AND value > previous * 5"""


@query(_STRING_SPIKES)
def loss_spikes_strings(spark, sf):
    step = F.concat(F.lit("runs/checkpoint-"), F.date_format("ts", "yyyy-MM-dd"))
    seq = F.col("seq") + F.lit(1 << 60)
    found = monitoring.loss_spikes(_metrics(spark, sf).withColumn("ts", step).withColumn("seq", seq), chunk_rows=12)
    return rounded(found.withColumnRenamed("ts", "step"))


def _ks_sql(feature: str, x: str) -> str:
    series = "2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam)))"
    return f"""(WITH v AS (SELECT {x} AS x, count(*) FILTER (WHERE event_id % 2 = 0) AS a, count(*) FILTER (WHERE event_id % 2 = 1) AS b
    FROM events GROUP BY 1),
  r AS (SELECT sum(a) OVER (ORDER BY x) / (SELECT sum(a) FROM v) AS fa, sum(b) OVER (ORDER BY x) / (SELECT sum(b) FROM v) AS fb FROM v),
  d AS (SELECT max(abs(fa - fb)) AS ks, (SELECT sum(a)::DOUBLE FROM v) AS n, (SELECT sum(b)::DOUBLE FROM v) AS m FROM r),
  l AS (SELECT ks, ks * sqrt(n * m / (n + m)) AS lam FROM d)
  SELECT '{feature}' AS feature, ks, CASE WHEN lam < 0.15 THEN 1.0 ELSE least(greatest({series}, 0.0), 1.0) END AS p FROM l)"""


_KS = _union([_ks_sql("value", "value"), _ks_sql("user", "user_id"),
              _ks_sql("shifted", "value + (event_id % 2) * 4")])


# the share of lattice paths inside the band, diagonal by diagonal
_SMALL_KS = """WITH RECURSIVE v AS (SELECT x, count(*) FILTER (WHERE NOT late) AS a, count(*) FILTER (WHERE late) AS b
  FROM (SELECT avg(value) AS x, dayofmonth(ts) > 12 AS late FROM events GROUP BY dayofmonth(ts)) GROUP BY x),
r AS (SELECT sum(a) OVER (ORDER BY x) AS ra, sum(b) OVER (ORDER BY x) AS rb, sum(a) OVER () AS n, sum(b) OVER () AS m FROM v),
d AS (SELECT max(abs(ra * m - rb * n))::BIGINT AS h, max(n)::BIGINT AS n, max(m)::BIGINT AS m FROM r),
p AS (SELECT 0::BIGINT AS s, h, n, m, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 AND h > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS u FROM d
  UNION ALL SELECT s + 1, h, n, m, list_transform(range(0, n + 1), lambda i: CASE WHEN i <= s + 1 AND s + 1 - i <= m AND abs(i * m - (s + 1 - i) * n) < h
    THEN coalesce(i / (s + 1) * u[i], 0) + (s + 1 - i) / (s + 1) * u[i + 1] ELSE 0.0::DOUBLE END) FROM p WHERE s < n + m),
e AS (SELECT h::DOUBLE / (n * m) AS ks, 1 - u[n + 1] AS p FROM p WHERE s = n + m)
SELECT 'daily' AS feature, round(ks, 6) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.05 AS drift_detected FROM e"""


@query(_SMALL_KS)
def ks_drift_small(spark, sf):
    """Daily means of the first twelve days of the month against those of the others: exact p-values."""
    day = F.dayofmonth("ts")
    daily = table(spark, sf, "events").groupBy(day.alias("day")).agg(F.avg("value").alias("daily"))
    return rounded(monitoring.ks_drift(daily.filter("day <= 12"), daily.filter("day > 12"), ["daily"]))


def _drift(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "value", F.col("user_id").alias("user"),
        (F.col("value") + (F.col("event_id") % 2) * 4).alias("shifted"),
    )
    even, odd = (events.filter(F.col("event_id") % 2 == i) for i in (0, 1))
    return monitoring.ks_drift(even, odd, ["value", "user", "shifted"], exact_rows=0)


@query(f"SELECT feature, round(ks, 6) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.05 AS drift_detected FROM ({_KS})")
def ks_drift(spark, sf):
    return rounded(_drift(spark, sf))


_DECAY = """(SELECT name, c AS current_value, r AS reference_value, abs(c - r) / abs(r) AS decay FROM (
  SELECT event_type AS name, max(value) FILTER (WHERE event_id % 2 = 1) AS c, max(value) FILTER (WHERE event_id % 2 = 0) AS r
  FROM events GROUP BY event_type) WHERE r <> 0 AND c IS NOT NULL)"""


def _decay(spark, sf):
    events = table(spark, sf, "events")
    odd, even = (
        events.filter(F.col("event_id") % 2 == i).groupBy(F.col("event_type").alias("name")).agg(F.max("value").alias("value"))
        for i in (1, 0)
    )
    return monitoring.metric_decay(odd, even)


@query(f"""SELECT feature, round(ks, 6) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.05 AS drift_detected FROM ({_ks_sql("value", "value")})
UNION ALL SELECT 'never', NULL, NULL, NULL""")
def ks_drift_missing(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", F.lit(None).cast("double").alias("never"))
    even, odd = (events.filter(F.col("event_id") % 2 == i) for i in (0, 1))
    return rounded(monitoring.ks_drift(even, odd, ["value", "never"]))


@query("""WITH v AS (SELECT event_type AS name, max_by(value, event_id) FILTER (WHERE event_id % 2 = 1) AS c,
  max_by(value, event_id) FILTER (WHERE event_id % 2 = 0) AS r FROM events GROUP BY event_type)
SELECT name, c AS current_value, r AS reference_value, round(abs(c - r) / abs(r), 6) AS decay, abs(c - r) / abs(r) > 0.1 AS decayed
FROM v WHERE r <> 0 AND c IS NOT NULL""")
def metric_decay_repeated(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("name"), "value")
    odd, even = (rows.filter(F.col("seq") % 2 == i) for i in (1, 0))
    return rounded(monitoring.metric_decay(odd, even))


@query(f"SELECT name, current_value, reference_value, round(decay, 6) AS decay, decay > 0.1 AS decayed FROM {_DECAY}")
def metric_decay(spark, sf):
    return rounded(_decay(spark, sf))


_NAMED = """(SELECT event_id AS seq, value, ts, CASE event_type WHEN 'click' THEN 'system.cpu.percent' WHEN 'view' THEN 'system.memory.percent'
  WHEN 'error' THEN 'serving.prediction.latency' ELSE 'training.' || event_type END AS name FROM events)"""
_LATEST = f"(SELECT * FROM {_NAMED} ORDER BY ts DESC, seq DESC LIMIT 100)"


def _half_up(x: str, digits: int) -> str:
    """Decimal ties away from zero, as Spark formats them."""
    return f"round({x}::DECIMAL(30, 9), {digits})::DOUBLE"


def _over_sql(source: str) -> str:
    return f"""(SELECT seq, name, value, CASE name WHEN 'system.cpu.percent' THEN 'high_cpu_usage' WHEN 'system.memory.percent' THEN 'high_memory_usage'
    ELSE 'high_prediction_latency' END AS type, CASE name WHEN 'system.cpu.percent' THEN printf('High CPU usage: %.1f%%', {_half_up('value', 1)})
    WHEN 'system.memory.percent' THEN printf('High memory usage: %.1f%%', {_half_up('value', 1)}) ELSE printf('High prediction latency: %.3fs', {_half_up('value', 3)}) END AS message,
    'warning' AS severity FROM {source}
  WHERE (name = 'system.cpu.percent' AND value > 80) OR (name = 'system.memory.percent' AND value > 90) OR (name = 'serving.prediction.latency' AND value > 1))"""


@query(f"SELECT seq, name, value, type, message, severity FROM {_over_sql(_LATEST)}")
def threshold_alerts(spark, sf):
    found = monitoring.threshold_alerts(system_metrics(table(spark, sf, "events")))
    return found.select("seq", "name", "value", "type", "message", "severity")


@query(f"SELECT name, round(avg(value), 6) AS avg, max(value) AS max, count(*) AS n FROM {_LATEST} WHERE name LIKE 'system.%' GROUP BY name")
def metric_summary(spark, sf):
    return rounded(monitoring.metric_summary(system_metrics(table(spark, sf, "events"))))


_ALERTS = f"""(SELECT 'training_loss_spike' AS type, printf('Training loss spike in %s: %.4f (5x previous average)', context::VARCHAR, value) AS message, 'warning' AS severity FROM {_SPIKES}
UNION ALL SELECT 'data_drift', printf('Data drift detected in feature %s: KS statistic = %.4f, p-value = %.4f', feature, ks, p), 'warning' FROM ({_KS}) WHERE p < 0.05
UNION ALL SELECT 'model_decay', printf('Model v1 performance decay in %s: %.1f%% decay', name, decay * 100), 'warning' FROM {_DECAY} WHERE decay > 0.1
UNION ALL SELECT type, message, severity FROM {_over_sql(_LATEST)})"""


def _alerts(spark, sf):
    limits = monitoring.limit_alerts(monitoring.threshold_alerts(system_metrics(table(spark, sf, "events"))))
    return monitoring.all_alerts(
        monitoring.spike_alerts(monitoring.loss_spikes(_metrics(spark, sf))),
        monitoring.drift_alerts(_drift(spark, sf)),
        monitoring.decay_alerts(_decay(spark, sf), "v1"),
        limits,
    )


@query(f"SELECT type, message, severity FROM {_ALERTS}")
def alerts_union(spark, sf):
    return _alerts(spark, sf).select("type", "message", "severity")


@query(f"""SELECT count(*) AS total_metrics, least(count(*), 100) AS recent_metrics_count,
  (SELECT count(*) FROM {_ALERTS}) AS active_alerts FROM events""")
def monitor_counts(spark, sf):
    return monitoring.monitor_counts(system_metrics(table(spark, sf, "events")), _alerts(spark, sf))


@query(f"""SELECT 'metric' AS kind, name AS label, count(*) AS n FROM {_NAMED} GROUP BY name
UNION ALL SELECT 'alert', type, count(*) FROM {_over_sql(_NAMED)} GROUP BY type""")
def metric_log(spark, sf):
    log = monitoring.MetricLog(spark, scratch_path(spark, "metrics"))
    named = system_metrics(table(spark, sf, "events"))
    for part in (0, 1):
        log.record(named.filter(F.col("seq") % 2 == part))
    log.raise_alerts(monitoring.limit_alerts(monitoring.exceeding(log.metrics())))
    return log.metrics().groupBy("name").count().select(
        F.lit("metric").alias("kind"), F.col("name").alias("label"), F.col("count").alias("n")
    ).unionByName(log.alerts().groupBy("type").count().select(
        F.lit("alert").alias("kind"), F.col("type").alias("label"), F.col("count").alias("n")
    ))


# ----------------------------------------------------------------- streaming


def _arrivals(spark: SparkSession, sf: str, arrival=None) -> streams.Arrivals:
    """The events in four spans, in order of time unless an order of arrival is given."""
    return streams.Arrivals(table(spark, sf, "events"), "ts", 4, arrival)


@query(f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, name, round(avg(value), 6) AS avg,
  max(value) AS max, count(value) AS n FROM {_NAMED} GROUP BY 1, 2""")
def stream_window_summary(spark, sf):
    done = streams.run_updates(
        lambda events: streams.window_summary(system_metrics(events)), "windows", ["window_start", "name"], _arrivals(spark, sf)
    )
    return rounded(done.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm")))


@query(f"SELECT seq, name, value, type, message, severity FROM {_over_sql(_NAMED)}")
def stream_alerts(spark, sf):
    found = streams.run_to_table(lambda events: streams.alert_stream(system_metrics(events)), "alerts", _arrivals(spark, sf))
    return found.select("seq", "name", "value", "type", "message", "severity")


@query(_SPIKES_SQL)
def stream_loss_spikes(spark, sf):
    return _timed(rounded(streams.run_spikes(metric_frame, arrivals=_arrivals(spark, sf))))


@query(_SPIKES_SQL)
def stream_loss_spikes_late(spark, sf):
    """Rows that arrive up to five days after their time, so that every span holds rows of earlier ones."""
    days = 5
    behind = F.pmod(F.xxhash64("event_id"), F.lit(days * 86_400)) * 1_000_000
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + behind
    return _timed(rounded(streams.run_spikes(metric_frame, arrivals=_arrivals(spark, sf, arrival), delay=days * 86_400)))
