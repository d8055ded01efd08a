"""Feature build for the failed-transaction model.

From the flat frame (with time features): numeric columns filled with their
exact median, frequency encoding of merchant category and merchant, the top
states kept and the rest 'Other', one-hot levels of the categorical columns,
a leakage gate, the time split and the class weight.

Scale notes: all per-value statistics (frequencies, level lists, medians)
are aggregates combined map-side and joined back through tables whose size
is bounded by the number of distinct values; level lists are the only thing
brought to the driver (to name the feature columns, as StringIndexer.fit
does) and are checked against a bound first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardspark.functions.numeric import round_half_up, round_half_up_sql, share
from cardspark.operators.keys import surrogate_keys
from cardspark.operators.prefix import exact_medians
from cardspark.plans.registry import register
from cardspark.plans.star import CTES, FLAT_SQL, TIME_SQL, _wh, flat_with_time
from cardspark.plans.warehouse import sized_broadcast
from cardspark.sources.store import scratch_table

# The reference's feature lists, in the reference's order.
TARGET = "is_error"
NUMERIC_COLS = ["amount", "current_age", "yearly_income", "credit_score", "debt_to_income",
                "num_credit_cards", "credit_limit"]
TIME_NUMERIC_COLS = ["txn_hour", "txn_per_card_day"]
TIME_CATEGORICAL_COLS = ["is_night", "txn_weekday"]
CATEGORICAL_COLS = ["card_brand", "card_type", "credit_limit_band", "credit_band", "income_band",
                    "age_group", "gender", "entry_mode", "has_chip", "is_online",
                    "is_online_entry", "is_weekend", "quarter", "month_number", "day_name"]
FREQ_ENCODE_COLS = ["mcc_description", "merchant_id"]
STATE_TOP_N = 15
FORBIDDEN = {"is_error", "is_success", "error_type", "transaction_id", "date_key", "year"}
SPLIT_CUTOFF = 20000101
# A categorical column has few levels (bands, flags, months, 15 states); one with
# more than this is none, and its name is in the error.
MAX_LEVELS = 1_000

# The JVM never compiles a method of more bytes than this: a stage whose generated
# method is larger runs as separate operators, which are compiled.
METHOD_BYTES = 8000

ALL_NUMERIC = NUMERIC_COLS + TIME_NUMERIC_COLS
ALL_CATEGORICAL = CATEGORICAL_COLS + TIME_CATEGORICAL_COLS + ["state_grp"]


class LeakageError(ValueError):
    pass


def check_leakage(names) -> None:
    """Refuse a feature list that holds a forbidden column."""
    leaked = sorted(set(names) & FORBIDDEN)
    if leaked:
        raise LeakageError(f"forbidden columns among features: {leaked}")


def clean_name(name: str) -> str:
    """Names safe for downstream tools ('<25' becomes 'lt25')."""
    return name.replace("[", "(").replace("]", ")").replace("<", "lt")


def as_text(c: str, dtype: str):
    """Category text as pandas' astype(str) writes it: True/False for flags,
    plain digits for integers, 'None' for a missing value."""
    col = F.col(c)
    if dtype == "boolean":
        txt = F.when(col, "True").when(~col, "False")
    elif dtype in ("double", "float"):
        txt = col.cast("long").cast("string")
    else:
        txt = col.cast("string")
    return F.coalesce(txt, F.lit("None"))


def _flat(spark, sf_dir) -> DataFrame:
    return _wh(spark, sf_dir).ml_frame()


def _text_cols(flat: DataFrame) -> list:
    """Category columns as text, plus the raw state text (``_state``)."""
    types = dict(flat.dtypes)
    cols = CATEGORICAL_COLS + TIME_CATEGORICAL_COLS
    return [as_text(c, types[c]).alias(c) for c in cols] + \
        [as_text("state", types["state"]).alias("_state")]


# ------------------------------------------------------------------ M4 ----
def numeric_medians(flat: DataFrame) -> DataFrame:
    """One row per numeric column: its exact median and the rows to fill."""
    meds = exact_medians(flat, ALL_NUMERIC)
    nulls = flat.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ALL_NUMERIC]) \
        .unpivot([], ALL_NUMERIC, "column_name", "n_filled")
    return meds.join(nulls, "column_name")


@register("impute_numeric", f"""
WITH tf AS ({TIME_SQL}), flat0 AS ({FLAT_SQL}),
flat AS (SELECT flat0.*, tf.txn_hour, tf.txn_per_card_day FROM flat0
         LEFT JOIN tf ON tf.transaction_id = flat0.transaction_id)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, "
    f"{round_half_up_sql(f'median(CAST({c} AS DOUBLE))', 6)} AS median, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_filled FROM flat" for c in ALL_NUMERIC), CTES)
def impute_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = numeric_medians(_flat(spark, sf_dir))
    return m.select("column_name", round_half_up(F.col("median"), 6).alias("median"), "n_filled")


# ------------------------------------------------------------------ M5 ----
def frequencies(flat: DataFrame) -> DataFrame:
    """Share of rows per value of each high-cardinality column, in one pass
    (explode (column, value) pairs, count per pair, divide by the total)."""
    pairs = flat.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), as_text(c, "string").alias("value"))
        for c in FREQ_ENCODE_COLS])).alias("p")).select("p.*")
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # one row per encoded column (not a window over all its distinct values)
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("_total"))
    return (counts.join(F.broadcast(totals), "column_name")
                  .withColumn("freq", share(F.col("n"), F.col("_total"))).drop("n", "_total"))


@register("freq_encode", f"""
WITH flat AS ({FLAT_SQL}),
pairs AS (SELECT 'mcc_description' AS column_name, COALESCE(mcc_description, 'None') AS value FROM flat
          UNION ALL SELECT 'merchant_id', COALESCE(CAST(merchant_id AS VARCHAR), 'None') FROM flat),
c AS (SELECT column_name, value, COUNT(*) AS n FROM pairs GROUP BY 1, 2)
SELECT column_name, value,
       CAST(n AS DOUBLE) / CAST(SUM(n) OVER (PARTITION BY column_name) AS DOUBLE) AS freq
FROM c""", CTES)
def freq_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequencies(_flat(spark, sf_dir))


# ------------------------------------------------------------------ M6 ----
def state_groups(flat: DataFrame, top_n: int = STATE_TOP_N) -> DataFrame:
    """Per state text: its row count and group (itself if among the top_n by
    count, ties by name, else 'Other')."""
    types = dict(flat.dtypes)
    counts = (flat.select(as_text("state", types["state"]).alias("state"))
                  .groupBy("state").agg(F.count(F.lit(1)).alias("n")))
    # The top_n states by a distributed top-k (each partition keeps its best
    # top_n, the merge sees top_n rows per partition): the broadcast side
    # holds top_n rows whatever the number of distinct states.
    top = (counts.orderBy(F.desc("n"), "state").limit(top_n)
                 .select("state", F.lit(True).alias("_top")))
    return (counts.join(F.broadcast(top), "state", "left")
                  .withColumn("state_grp", F.when(F.col("_top"), F.col("state"))
                              .otherwise("Other")).drop("_top"))


@register("state_top_n", f"""
WITH flat AS ({FLAT_SQL}),
c AS (SELECT COALESCE(state, 'None') AS state, COUNT(*) AS n FROM flat GROUP BY 1)
SELECT state, n, CASE WHEN row_number() OVER (ORDER BY n DESC, state) <= {STATE_TOP_N}
                      THEN state ELSE 'Other' END AS state_grp
FROM c""", CTES)
def state_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_groups(_flat(spark, sf_dir))


# ------------------------------------------------------------------ M7 ----
def levels(text: DataFrame) -> DataFrame:
    """Distinct level per categorical column (one pass: explode then
    distinct), with the cleaned feature name and the feature's position."""
    pairs = text.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("col_order"), F.lit(c).alias("column_name"),
                 F.col(c).alias("level"))
        for i, c in enumerate(ALL_CATEGORICAL)])).alias("p")).select("p.*").distinct()
    name = F.concat(F.col("column_name"), F.lit("_"), F.col("level"))
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\[", "("), r"\]", ")"),
                            "<", "lt")
    base = len(ALL_NUMERIC) + len(FREQ_ENCODE_COLS)
    # position in (column, level) order: size-checked ranking (a plain window
    # only when a count proves the level list small)
    ranked = surrogate_keys(pairs, ["col_order", "level"], "_pos", start=base)
    return ranked.select("column_name", "level", name.alias("feature_name"),
                         F.col("_pos").cast("int").alias("feature_index"), "col_order")


def text_with_state(flat: DataFrame, keep: list | None = None,
                    groups: DataFrame | None = None) -> DataFrame:
    """Categorical columns as text with the state group attached (a broadcast
    join with one row per distinct state); a state that ``groups`` lacks is
    'Other'."""
    groups = state_groups(flat) if groups is None else groups
    groups = groups.select(F.col("state").alias("_state"), "state_grp")
    t = flat.select(*(keep or []), *_text_cols(flat))
    return (t.join(sized_broadcast(groups, 2_000_000), "_state", "left").drop("_state")
             .withColumn("state_grp", F.coalesce("state_grp", F.lit("Other"))))


def _text_sql(c: str) -> str:
    if c in {"has_chip", "is_online", "is_online_entry", "is_weekend"}:
        return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' ELSE 'None' END"
    if c == "txn_weekday":
        return f"COALESCE(CAST(CAST({c} AS BIGINT) AS VARCHAR), 'None')"
    return f"COALESCE(CAST({c} AS VARCHAR), 'None')"


_T_COLS = ", ".join(f"{_text_sql(c)} AS {c}" for c in CATEGORICAL_COLS + TIME_CATEGORICAL_COLS)
# flat rows with time features, and their categorical columns as text
_TEXT_CTES = f"""
WITH tf AS ({TIME_SQL}), flat0 AS ({FLAT_SQL}),
flat AS (SELECT flat0.*, tf.txn_hour, tf.txn_weekday, tf.is_night, tf.txn_per_card_day FROM flat0
         LEFT JOIN tf ON tf.transaction_id = flat0.transaction_id),
c AS (SELECT COALESCE(state, 'None') AS state, COUNT(*) AS n FROM flat GROUP BY 1),
st AS (SELECT state, CASE WHEN row_number() OVER (ORDER BY n DESC, state) <= {STATE_TOP_N}
                          THEN state ELSE 'Other' END AS state_grp FROM c),
t AS (SELECT transaction_id, {_T_COLS}, st.state_grp
      FROM flat LEFT JOIN st ON st.state = COALESCE(flat.state, 'None'))"""
_NAME_SQL = "replace(replace(replace(column_name || '_' || level, '[', '('), ']', ')'), '<', 'lt')"


def _one_hot_sql() -> str:
    pairs = "\nUNION ALL\n".join(
        f"SELECT DISTINCT {i} AS col_order, '{c}' AS column_name, {c} AS level FROM t"
        for i, c in enumerate(ALL_CATEGORICAL))
    base = len(ALL_NUMERIC) + len(FREQ_ENCODE_COLS)
    return f"""{_TEXT_CTES},
pairs AS ({pairs})
SELECT column_name, level, {_NAME_SQL} AS feature_name,
       CAST(row_number() OVER (ORDER BY col_order, level) + {base - 1} AS INT) AS feature_index
FROM pairs"""


def _matrix_sql() -> str:
    """The matrix with the names of a row's levels in one column (which columns
    there are depends on the data)."""
    held = "\nUNION ALL\n".join(f"SELECT transaction_id, '{c}' AS column_name, {c} AS level FROM t"
                                for c in ALL_CATEGORICAL)
    medians = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in ALL_NUMERIC)
    filled = ", ".join(f"COALESCE(CAST(flat.{c} AS DOUBLE), med.{c}) AS {c}" for c in ALL_NUMERIC)
    freq = ", ".join(f"CAST(COUNT(*) OVER (PARTITION BY flat.{c}) AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE)"
                     f" AS {c}_freq" for c in FREQ_ENCODE_COLS)
    return f"""{_TEXT_CTES},
med AS (SELECT {medians} FROM flat),
x AS (SELECT flat.transaction_id, flat.date_key, CAST({TARGET} AS DOUBLE) AS label, {filled}, {freq}
      FROM flat, med),
hot AS (SELECT transaction_id, string_agg({_NAME_SQL}, ',' ORDER BY {_NAME_SQL}) AS levels
        FROM ({held}) GROUP BY transaction_id)
SELECT x.*, levels FROM x JOIN hot ON hot.transaction_id = x.transaction_id"""


@register("one_hot", _one_hot_sql(), CTES)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels(text_with_state(_flat(spark, sf_dir))).drop("col_order")


# ------------------------------------------------------------- M8, M10, M11 ----
def encoded_features(flat: DataFrame, top_n: int = STATE_TOP_N, fit: DataFrame | None = None):
    """Return (frame, level rows): the frame holds transaction_id, date_key,
    label, the numeric and frequency columns, and per categorical column the
    place of its level among that column's level rows (``_at_<column>``, from 1;
    0 for a level that ``fit`` lacks). A row's one-hot columns follow from the
    places, so no row is compared with every level of every column twice.

    Medians, frequencies, state groups and levels come from ``fit`` (all rows
    by default; the training rows to keep the test rows out). A value that
    ``fit`` lacks has frequency 0, no level, and state group 'Other'."""
    lim = 2_000_000
    flat.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
    fit = flat if fit is None else fit
    groups = scratch_table(state_groups(fit, top_n), "state_groups")
    meds = exact_medians(fit, ALL_NUMERIC).groupBy().pivot("column_name", ALL_NUMERIC) \
        .agg(F.first("median"))
    meds = meds.select(*[F.col(c).alias(f"_med_{c}") for c in ALL_NUMERIC])
    freqs = scratch_table(frequencies(fit), "frequencies")
    text = text_with_state(fit, groups=groups)
    lv = levels(text).orderBy("feature_index")
    wide = [r["column_name"] for r in lv.groupBy("column_name").count()
            .filter(F.col("count") > MAX_LEVELS).collect()]
    if wide:
        raise ValueError(f"not categorical, over {MAX_LEVELS} levels: {', '.join(sorted(wide))}")
    level_rows = lv.select("column_name", "level", "feature_name").collect()
    check_leakage(_names(level_rows))

    raw = flat.select("transaction_id", "date_key", F.col(TARGET).cast("double").alias("label"),
                      *[F.col(c).cast("double").alias(c) for c in ALL_NUMERIC],
                      *[as_text(c, "string").alias(f"_f_{c}") for c in FREQ_ENCODE_COLS],
                      "state", *CATEGORICAL_COLS, *TIME_CATEGORICAL_COLS)
    keep = ["transaction_id", "date_key", "label", *ALL_NUMERIC,
            *[f"_f_{c}" for c in FREQ_ENCODE_COLS]]
    x = text_with_state(raw, keep, groups).crossJoin(F.broadcast(meds))
    for c in FREQ_ENCODE_COLS:
        fc = sized_broadcast(freqs.filter(F.col("column_name") == c)
                             .select(F.col("value").alias(f"_f_{c}"),
                                     F.col("freq").alias(f"{c}_freq")), lim)
        x = x.join(fc, f"_f_{c}", "left")
    numeric = [F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) for c in ALL_NUMERIC]
    freq_cols = [F.coalesce(F.col(f"{c}_freq"), F.lit(0.0)).alias(f"{c}_freq")
                 for c in FREQ_ENCODE_COLS]
    places = [F.array_position(F.array(*[F.lit(r["level"]) for r in rows]), F.col(c)).cast("int")
              .alias(f"_at_{c}") if rows else F.lit(0).alias(f"_at_{c}")
              for c, rows in _by_column(level_rows).items()]
    return (x.select("transaction_id", "date_key", "label", *numeric, *freq_cols, *places),
            level_rows)


def _names(level_rows: list) -> list[str]:
    return ALL_NUMERIC + [f"{c}_freq" for c in FREQ_ENCODE_COLS] + \
        [r["feature_name"] for r in level_rows]


def _by_column(level_rows: list) -> dict[str, list]:
    return {c: [r for r in level_rows if r["column_name"] == c] for c in ALL_CATEGORICAL}


def build_features(flat: DataFrame, top_n: int = STATE_TOP_N, fit: DataFrame | None = None):
    """Return (frame, feature names): the frame holds transaction_id,
    date_key, label and one double column per feature, named as listed (see
    ``encoded_features``)."""
    x, level_rows = encoded_features(flat, top_n, fit)
    names = _names(level_rows)
    dummies = [(F.col(f"_at_{c}") == i).cast("double").alias(r["feature_name"])
               for c, rows in _by_column(level_rows).items() for i, r in enumerate(rows, 1)]
    return x.select("transaction_id", "date_key", "label",
                    *names[:len(names) - len(level_rows)], *dummies), names


def assembled_features(flat: DataFrame, top_n: int = STATE_TOP_N, fit: DataFrame | None = None):
    """Return (frame, feature names): transaction_id, date_key, label and
    ``features``, the vector of the columns of ``build_features``."""
    x, level_rows = encoded_features(flat, top_n, fit)
    names = _names(level_rows)
    spark = flat.sparkSession
    held = {c: len(rows) for c, rows in _by_column(level_rows).items() if rows}
    if not held:  # no rows
        x = VectorAssembler(inputCols=names, outputCol="features").transform(x)
        return x.select("transaction_id", "date_key", "label", "features"), names
    # the encoder learns how many levels each column has from its highest place;
    # a place of 0 is none of them
    sizes = spark.createDataFrame([tuple(float(n - 1) for n in held.values())],
                                  ", ".join(f"_at_{c} double" for c in held))
    hot = OneHotEncoder(inputCols=[f"_at_{c}" for c in held], outputCols=[f"_hot_{c}" for c in held],
                        handleInvalid="keep").fit(sizes)
    x = hot.transform(x.withColumns({f"_at_{c}": (F.col(f"_at_{c}") - 1).cast("double")
                                     for c in held}))
    x = VectorAssembler(inputCols=names[:len(names) - len(level_rows)] + [f"_hot_{c}" for c in held],
                        outputCol="features").transform(x)
    # every feature is numeric, under its own name
    meta = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]},
                        "num_attrs": len(names)}}
    return x.select("transaction_id", "date_key", "label",
                    F.col("features").alias("features", metadata=meta)), names


@register("feature_matrix", None)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the assembled matrix (one double column per feature) with label."""
    frame, _ = build_features(_flat(spark, sf_dir))
    return frame


@register("feature_rows", _matrix_sql(), CTES)
def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the same matrix, a row's one-hot columns as the sorted names of those
    that are 1."""
    x, level_rows = encoded_features(_flat(spark, sf_dir))
    numeric = _names(level_rows)[:-len(level_rows) or None]
    held = [F.element_at(F.array(*[F.lit(r["feature_name"]) for r in rows]),
                         F.nullif(F.col(f"_at_{c}"), F.lit(0)))
            for c, rows in _by_column(level_rows).items() if rows]
    return x.select("transaction_id", "date_key", "label", *numeric,
                    F.array_join(F.sort_array(F.array(*held).cast("array<string>")), ",").alias("levels"))


@register("time_split_counts", f"""
WITH flat AS ({FLAT_SQL})
SELECT CASE WHEN date_key < {SPLIT_CUTOFF} THEN 'train' ELSE 'test' END AS split,
       COUNT(*) AS n_rows, CAST(SUM(is_error) AS BIGINT) AS n_errors,
       CAST(SUM(is_error) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS error_rate
FROM flat GROUP BY 1""", CTES)
def time_split_counts(spark: SparkSession, sf_dir: str, cutoff: int = SPLIT_CUTOFF) -> DataFrame:
    """Train is date_key < cutoff, test the rest."""
    flat = _flat(spark, sf_dir)
    g = (flat.groupBy(F.when(F.col("date_key") < cutoff, "train").otherwise("test").alias("split"))
             .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(TARGET).cast("long").alias("n_errors")))
    return g.withColumn("error_rate", share("n_errors", "n_rows"))


def time_split(frame: DataFrame, cutoff: int = SPLIT_CUTOFF):
    return frame.filter(F.col("date_key") < cutoff), frame.filter(F.col("date_key") >= cutoff)


@register("class_weight", f"""
WITH flat AS ({FLAT_SQL}), tr AS (SELECT * FROM flat WHERE date_key < {SPLIT_CUTOFF})
SELECT CAST(SUM(is_error) AS BIGINT) AS n_pos, COUNT(*) - CAST(SUM(is_error) AS BIGINT) AS n_neg,
       CAST(COUNT(*) - SUM(is_error) AS DOUBLE) / CAST(GREATEST(SUM(is_error), 1) AS DOUBLE) AS pos_weight
FROM tr""", CTES)
def class_weight(spark: SparkSession, sf_dir: str, cutoff: int = SPLIT_CUTOFF) -> DataFrame:
    """Negatives over max(positives, 1) on the training rows."""
    tr = _flat(spark, sf_dir).filter(F.col("date_key") < cutoff)
    g = tr.agg(F.sum(TARGET).cast("long").alias("n_pos"), F.count(F.lit(1)).alias("n"))
    return g.select("n_pos", (F.col("n") - F.col("n_pos")).alias("n_neg"),
                    share(F.col("n") - F.col("n_pos"), F.greatest(F.col("n_pos"), F.lit(1)))
                    .alias("pos_weight"))

