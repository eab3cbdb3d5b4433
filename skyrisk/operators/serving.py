"""Read-side queries over the processed / aggregates / predictions tables.

The reference computes these in pandas on one machine after loading whole
Parquet folders.  Here each is a DataFrame plan: global aggregates are
partial + final (one row per task crosses the wire), and every "newest N"
is ``orderBy(...).limit(N)`` = TakeOrderedAndProject, which keeps N rows per
task and merges them, never sorting the table.  Order keys always end in a
unique key so ties cannot make results vary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.functions.rules import is_critical
from skyrisk.schemas import AGGREGATE_COLUMNS, DEFAULT_CITY, EVENT_COLUMNS, RISK_CLASSES


# ---------------------------------------------------------------- C2
def kpi_summary(processed: DataFrame) -> DataFrame:
    """Mean temperature, mean humidity, total precipitation, max wind, events."""
    return processed.agg(
        F.avg("temperature").alias("avg_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.sum("precipitation").alias("total_precipitation"),
        F.max("wind_speed").alias("max_wind_speed"),
        F.count(F.lit(1)).alias("total_events"),
    )


def to_metric_rows(one_row: DataFrame) -> DataFrame:
    """Wide single row -> long ``(metric string, value double)`` rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
             for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))


# ---------------------------------------------------------------- C3
def class_distribution(df: DataFrame, col: str = "risk_level") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


# ---------------------------------------------------------------- C6
def prediction_distribution(predictions: DataFrame, col: str = "risk_prediction") -> DataFrame:
    """Counts over the fixed class list, zero-filled, in class order; other
    values (``unknown``) left out.

    One conditional count per class in a single global aggregate (partial
    per task, one row per task to the final step), then the row is unfolded
    to one row per class: no join, no broadcast, no sort.
    """
    counts = predictions.agg(*[F.count_if(F.col(col) == name).alias(f"n{i}")
                               for i, name in RISK_CLASSES])
    rows = [F.struct(F.lit(name).alias(col), F.col(f"n{i}").alias("count"))
            for i, name in RISK_CLASSES]
    return counts.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- C5, C4, G5
def split_bucket(key: Column | str, seed: int = 42) -> Column:
    """Integer hash of a whole key in [0, 65536): the first 16 bits of the md5 of
    ``seed:key``, so ids of any spacing (multiples, time-ordered ids) spread evenly."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit("")))), 1, 4), 16, 10).cast("int")


def event_hash(df: DataFrame) -> Column:
    """A 60-bit hash of the event's own columns.  Measures enter as whole
    millionths and times as microseconds, so any engine can state it."""
    def text(f):
        c = F.col(f.name)
        if f.dataType.typeName().startswith("timestamp"):
            c = F.unix_micros(c.cast("timestamp"))
        elif f.dataType.typeName() in ("double", "float"):
            c = F.floor(c * 1e6 + F.lit(0.5)).cast("long")
        return F.coalesce(c.cast("string"), F.lit(""))

    parts = [text(df.schema[c]) for c in EVENT_COLUMNS if c in df.columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def row_key(df: DataFrame, key: str | None = "event_id") -> Column:
    """The split and order key of every row: the key column alone (hashed unless it is an
    integer), so nothing else is read for it; the hash of the event where the table has no
    such column.  Landed tables have no null key (``with_key``)."""
    if not key or key not in df.columns:
        return event_hash(df)
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.col(key).cast("long") if whole else \
        F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long")


def with_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows without a key get the hash of their event: done once, when they are landed."""
    return df.withColumn(key, F.coalesce(F.col(key), event_hash(df))) if key in df.columns else df


def keyed(df: DataFrame, key: str = "event_id") -> DataFrame:
    """A stored table whose key no row lacks.  One that was landed without keys by another
    writer gets them here; whether it was is told by the key column's own statistics."""
    if key not in df.columns or df.where(F.col(key).isNull()).select(F.lit(1)).isEmpty():
        return df
    return with_key(df, key)


def split_by_key(df: DataFrame, key: str | None = "event_id", train_fraction: float = 0.8,
                 seed: int = 42) -> DataFrame:
    """Key-based train/test split.  Unlike ``randomSplit`` it does not
    depend on partitioning or row order, so a retried task or another
    cluster shape gives the same split."""
    cut = int(train_fraction * 65536)
    return df.withColumn(
        "split", F.when(split_bucket(row_key(df, key), seed) < cut, F.lit("train"))
        .otherwise(F.lit("test")))


def training_gates(processed: DataFrame, features: list[str], key: str | None = "event_id",
                   train_fraction: float = 0.8, seed: int = 42,
                   min_clean_rows: int = 20) -> DataFrame:
    """All pre-training counts in one pass (the reference runs five jobs).

    ``n_classes`` counts the fixed label domain with one conditional count
    per class, so the plan stays a single partial + final aggregate (no
    distinct aggregation).
    """
    from skyrisk.functions.rules import risk_label

    clean = F.lit(True)
    for c in features:
        clean = clean & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    label = risk_label()
    train = split_bucket(row_key(processed, key), seed) < int(train_fraction * 65536)
    per_class = [F.count_if(clean & (label == v)) for v, _ in RISK_CLASSES]
    g = processed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(clean).alias("clean_rows"),
        sum((pc > 0).cast("int") for pc in per_class).alias("n_classes"),
        F.count_if(clean & train).alias("train_rows"),
        F.count_if(clean & ~train).alias("test_rows"),
    )
    status = (F.when(F.col("total_rows") == 0, F.lit("no_data"))
              .when(F.col("clean_rows") < min_clean_rows, F.lit("too_few_rows"))
              .when((F.col("train_rows") == 0) | (F.col("test_rows") == 0), F.lit("empty_split"))
              .when(F.col("n_classes") < 2, F.lit("one_class"))
              .otherwise(F.lit("ok")))
    return g.withColumn("status", status).withColumn(
        "can_train", F.col("status").isin("ok", "one_class"))


# ---------------------------------------------------------------- D1-D5
def newest(df: DataFrame, n: int, time_col: str, tie_cols: list[str]) -> DataFrame:
    """Top-n by time, newest first; ties broken by ``tie_cols`` (desc)."""
    return df.orderBy(F.col(time_col).desc(), *[F.col(c).desc() for c in tie_cols]).limit(n)


def tail_ascending(df: DataFrame, n: int, time_col: str, tie_cols: list[str]) -> DataFrame:
    """The newest n rows with a time, presented oldest first (chart input)."""
    top = newest(df.where(F.col(time_col).isNotNull()), n, time_col, tie_cols)
    return top.orderBy(F.col(time_col).asc(), *[F.col(c).asc() for c in tie_cols])


def latest_per_key(df: DataFrame, key: str, time_col: str) -> DataFrame:
    """Newest row per key; rows without a time do not count.  Of rows with equal key and
    time (a window landed twice) one counts, whole, by a hash of its columns.

    One pass: ``max_by`` of every other column by time and hash, which are the digits of
    one decimal.  Fixed-width columns keep it a HashAggregate with a partial step, so a hot
    key is reduced on every map task (``max_by`` over a struct would sort).
    """
    base = F.lit(10**18).cast("decimal(19,0)")
    order = F.unix_micros(F.col(time_col).cast("timestamp")).cast("decimal(18,0)") * base \
        + F.pmod(F.xxhash64(*df.columns), F.lit(10**18)).cast("decimal(18,0)")
    picked = df.where(F.col(time_col).isNotNull()).withColumn("__order", order).groupBy(key).agg(
        *[F.max(c).alias(c) if c == time_col else F.max_by(c, "__order").alias(c)
          for c in df.columns if c != key])
    return picked.select(*df.columns)


def present_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep only the wanted columns that exist (schema-level)."""
    return df.select(*[c for c in wanted if c in df.columns])


# ---------------------------------------------------------------- C7
NUMERIC_AGG = AGGREGATE_COLUMNS[3:]
SUMMARY_STATS = ["current", "oldest", "avg", "min", "max", "std"]


def summary_stats(aggregates: DataFrame, pool: int = 1000,
                  columns: list[str] | None = None) -> DataFrame:
    """Per numeric column over the newest ``pool`` windows: current (newest),
    oldest, avg, min, max and sample std.

    Top-k rows, unpivoted to (column, value) pairs, then one grouped
    aggregate with six functions - a small generated aggregate rather than
    six functions per column in one row.  The reference labels the oldest
    row's value "current"; both are given.
    """
    cols = columns or [f.name for f in aggregates.schema.fields
                       if f.dataType.typeName() in ("double", "long", "integer", "float")]
    top = newest(aggregates, pool, "window_start", ["city"])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                      for c in cols])
    long = top.select(F.struct("window_start", "city").alias("o"), F.inline(pairs))
    g = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max_by("x", "o").alias("current"), F.min_by("x", "o").alias("oldest"),
        F.avg("x").alias("avg"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.stddev_samp("x").alias("std"))
    return g.select("column", "rows", *SUMMARY_STATS)


# ---------------------------------------------------------------- C8
RECENT = 50    # fixed value: events and predictions that an alert looks at


def alert_flag(processed: DataFrame, predictions: DataFrame | None, recent: int = RECENT) -> DataFrame:
    """Critical measure in the newest ``recent`` events, or a 'critical'
    prediction in the newest ``recent`` predictions.

    Both top-k sets are unioned and reduced by one aggregate (no join).
    Equal times are ordered by the row key, which no row lacks.
    """
    def top(df):
        return newest(df.withColumn("__key", row_key(df)), recent, "timestamp", ["__key"])

    data = top(processed).select(
        is_critical().alias("d"), F.lit(None).cast("boolean").alias("p"))
    if predictions is not None and "risk_prediction" in predictions.columns:
        pred = top(predictions).select(
            F.lit(None).cast("boolean").alias("d"), (F.col("risk_prediction") == "critical").alias("p"))
        data = data.unionByName(pred)
    out = data.agg(F.coalesce(F.bool_or("d"), F.lit(False)).alias("critical_in_data"),
                   F.coalesce(F.bool_or("p"), F.lit(False)).alias("critical_in_pred"))
    return out.withColumn("alert", F.col("critical_in_data") | F.col("critical_in_pred"))


# ---------------------------------------------------------------- B18
# BI column names and their sources.
BI_COLUMNS = [
    ("AvgTemperature", "avg_temperature"), ("MaxTemperature", "max_temperature"),
    ("MinTemperature", "min_temperature"), ("AvgHumidity", "avg_humidity"),
    ("TotalPrecipitation", "total_precipitation"), ("MaxWindSpeed", "max_wind_speed"),
    ("MaxWindGusts", "max_wind_gusts"), ("AvgSurfacePressure", "avg_surface_pressure"),
    ("AvgApparentTemperature", "avg_apparent_temperature"),
]


def bi_rows(aggregates: DataFrame, with_push_time: bool = True) -> DataFrame:
    """Window rows in the BI push format: ISO times, missing values 0."""
    def num(src: str) -> Column:
        return (F.coalesce(F.col(src).cast("double"), F.lit(0.0)) if src in aggregates.columns
                else F.lit(0.0))

    iso = "yyyy-MM-dd'T'HH:mm:ss"
    cols = []
    if with_push_time:
        cols.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                    .alias("Timestamp"))
    cols += [
        F.date_format("window_start", iso).alias("WindowStart"),
        F.date_format("window_end", iso).alias("WindowEnd"),
        (F.coalesce(F.col("city"), F.lit(DEFAULT_CITY)) if "city" in aggregates.columns
         else F.lit(DEFAULT_CITY)).alias("City"),
    ]
    cols += [num(src).alias(dst) for dst, src in BI_COLUMNS]
    cols.append((F.coalesce(F.col("event_count"), F.lit(0)) if "event_count" in aggregates.columns
                 else F.lit(0)).cast("int").alias("EventCount"))
    return aggregates.select(*cols)


# ---------------------------------------------------------------- C14
def dataset_status(tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Row count and has-data flag per named table, one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("has_data", F.col("rows") > 0)


def landed_status(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """C14 over landed Parquet folders, from their footers alone.

    Bare counts are pushed into Spark's second-generation Parquet reader, which answers
    them from row-group metadata and returns one number per file.  Its settings live in a
    session of their own, so the caller's stay as they are.  A missing folder has no rows."""
    from skyrisk.sources.files import any_file, path_exists
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")

    def rows(path):
        if not path_exists(spark, path) or not any_file(spark, path):
            return own.range(1).select(F.lit(0).cast("long").alias("rows"))
        return own.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    out = None
    for name, path in folders.items():
        one = rows(path).select(F.lit(name).alias("dataset"), "rows", (F.col("rows") > 0).alias("has_data"))
        out = one if out is None else out.unionByName(one)
    return out
