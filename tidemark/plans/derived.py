"""Frames that the query catalogue derives from the given tables: targets, staged batches, logs, settings.

Each has a counterpart of the same name among the oracle's common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import index_text


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _log(df: DataFrame, database: str, table_name: Column, *group: str) -> DataFrame:
    """One "run" per day of the index column: the day is the run's time, its greatest value the index value."""
    day = F.date_trunc("DAY", "ts").cast("timestamp_ntz")
    grouped = df.groupBy(*group, day.alias("created_ts")).agg(F.max("ts").alias("m"))
    return grouped.select(
        F.lit("dw").alias("datastore_name"),
        F.lit(database).alias("database_name"),
        table_name.alias("table_name"),
        index_text(F.col("m"), df.schema["ts"].dataType).alias("index_value"),
        "created_ts",
    )


def idx_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state log with one table per event type."""
    return _log(table(spark, sf_dir, "events"), "ev", F.col("event_type"), "event_type")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state log of all events as one table."""
    return _log(table(spark, sf_dir, "events"), "ev", F.lit("events"))


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state log with the order priority as database, the status as table, and a run per month."""
    month = F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", "o_orderstatus", month.alias("created_ts"))
        .agg(F.max("o_orderkey").cast("string").alias("index_value"))
        .select(
            F.lit("dw").alias("datastore_name"),
            F.col("o_orderpriority").alias("database_name"),
            F.col("o_orderstatus").alias("table_name"),
            "index_value",
            "created_ts",
        )
    )


def orders_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") <= ntz("1998-06-30"))


def orders_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps the target by one quarter (updates) and goes two quarters beyond it (inserts)."""
    date = F.col("o_orderdate")
    changed = {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1}
    rows = table(spark, sf_dir, "orders").where((date > ntz("1998-03-31")) & (date <= ntz("1998-12-31")))
    return rows.withColumns(changed)


def orders_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source behind the loaded orders: in every 20th block of 64 keys it has lost a third and changed a third of them, and
    has orders that were not loaded."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    block = F.floor(key / 64) % 20 == 3
    rows = orders.where((F.col("o_orderdate") <= ntz("1998-06-30")) | block).where(~(block & (key % 3 == 0)))
    price = F.when(block & (key % 3 == 1), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return rows.withColumn("o_totalprice", price)


def lineitem_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= ntz("1998-06-30"))


def lineitem_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").where((date > ntz("1998-03-31")) & (date <= ntz("1998-12-31")))


def null_keyed(orders: DataFrame) -> DataFrame:
    """Keys of one priority become NULL."""
    key = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderkey"))
    return orders.select(key.alias("k"), F.col("o_orderstatus").alias("v"))


def events_nullidx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one type lose their index value."""
    index = F.when(F.col("event_type") != "signup", F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", index.alias("ts"), "event_type")


def index_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new index values of every kind, one pair per event."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    ts_type = events.schema["ts"].dataType
    old = (
        F.when(kind == "click", F.col("user_id").cast("string"))
        .when(kind == "view", index_text(F.col("ts"), ts_type))
        .when(kind == "error", F.lit("abcd"))
        .when(kind == "purchase", F.col("event_id").cast("string"))
    )
    moved = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("user_id") - 50).cast("decimal(18,6)"))
    new = (
        F.when(kind == "click", F.col("event_id").cast("string"))
        .when(kind == "view", index_text(moved, ts_type))
        .when(kind != "purchase", F.col("event_id").cast("string"))
    )
    return events.select(
        "event_id",
        old.alias("old_value"),
        new.alias("new_value"),
        F.when(kind == "view", F.lit("timestamp")).otherwise(F.lit("int")).alias("kind"),
    )


def dates_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text; some priorities carry zero dates, empty texts or NULL instead."""
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "2-HIGH", F.lit("0000-00-00 00:00:00"))
        .when(priority == "3-MEDIUM", F.lit(""))
        .when(priority != "4-NOT SPECIFIED", F.col("o_orderdate").cast("string"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("d"))


def column_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Columns of many source and target tables, and the tables to rebuild: a brand is a table, a name a column."""
    part = table(spark, sf_dir, "part")
    named = part.select(F.col("p_brand").alias("table_name"), F.col("p_name").alias("column_name"), "p_size", "p_type")
    source = named.where("p_size >= 5").select("table_name", "column_name")
    target = named.where("p_size >= 15 AND p_type <> 'ECONOMY'").select("table_name", "column_name")
    rebuilt = named.where("p_size = 50").select("table_name").distinct()
    return source, target, rebuilt


# MySQL types as a catalogue reports them; % stands for a number.
MYSQL_TYPE_TEXTS = (
    "tinyint(%) unsigned", "smallint(%)", "smallint unsigned", "MEDIUMINT(%)", "int", "int unsigned",
    "INT(%) UNSIGNED ZEROFILL", "bigint(%)", "bigint unsigned", "float unsigned", "DOUBLE", "decimal(%,2) unsigned",
    "VARCHAR(%)", "char(%)", "varchar(%000)", "bit(1)", "bit(64)", "set('a','b')", "mediumtext", "datetime(6)", "date",
    "time(3)", "year", "char(36)",
)


def mysql_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One MySQL type per part."""
    texts = F.array(*[F.lit(t) for t in MYSQL_TYPE_TEXTS])
    chosen = F.element_at(texts, (F.col("p_partkey") % len(MYSQL_TYPE_TEXTS) + 1).cast("int"))
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", F.replace(chosen, F.lit("%"), size).alias("source_type"))


# Postgres types.
POSTGRES_TYPE_NAMES = ("int4", "varchar", "numeric", "text", "uuid", "money", "jsonb", "mood", "timestamp", "decimal")


def postgres_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One description of a Postgres column per part; every fourth size is unknown."""
    names = F.array(*[F.lit(t) for t in POSTGRES_TYPE_NAMES])
    source = F.element_at(names, (F.col("p_partkey") % len(POSTGRES_TYPE_NAMES) + 1).cast("int"))
    exact = source.isin("numeric", "decimal")
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        source.alias("source_type"),
        F.col("p_type").alias("column_name"),
        F.when(size % 4 == 0, F.lit(-1)).otherwise(size).alias("size"),
        F.when(exact, size).alias("precision"),
        F.when(exact, size % 7).alias("scale"),
    )


def acl_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access-control string per customer: users, groups, the public; some are empty or malformed."""
    group, user = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    odd = {0: "", 1: "something", 2: "{=r/admin}", 3: "{reader=r/admin,reader}", 4: "{reader=r}"}
    usual = F.concat(
        F.lit("{user"), user, F.lit("=arwdRxtD/admin,reader"), user, F.lit('=a*r*Z/admin,"group '),
        group, F.lit(",all=r/owner"), F.col("c_nationkey").cast("string"), F.lit('"}'),
    )
    text = F.when(F.lit(False), F.lit(""))
    for nation, value in odd.items():
        text = text.when(F.col("c_nationkey") == nation, F.lit(value))
    return table(spark, sf_dir, "customer").select("c_custkey", text.otherwise(usual).alias("acl"))



def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One combination of settings per part."""
    size = F.col("p_size")

    def bit(n: int) -> Column:
        return F.getbit(size.cast("long"), F.lit(n)) == 1

    return table(spark, sf_dir, "part").select(
        "p_partkey",
        bit(0).alias("index_column"),
        bit(1).alias("index_sql"),
        bit(2).alias("append_only"),
        bit(3).alias("full_refresh"),
        bit(4).alias("query_file"),
        bit(5).alias("rebuild"),
        (F.col("p_type") == "STANDARD").alias("primary_key"),
        (F.col("p_type") == "PROMO").alias("truncate_file"),
        (F.col("p_type") == "ECONOMY").alias("schema_file"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """A table that customers and suppliers feed, and a staged batch of each."""
    def rows(name: str, p: str, key: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.col(key).alias("account_id"),
            F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"),
            F.col(f"{p}_acctbal").alias("balance"),
        )

    crm, erp = rows("customer", "c", "c_custkey"), rows("supplier", "s", "s_suppkey")
    target = crm.where("nation < 15").withColumn("source_alias", F.lit("crm")).unionByName(
        erp.where("nation < 15").withColumn("source_alias", F.lit("erp"))
    )
    staged = {
        alias: df.where("nation >= 10").withColumn("balance", F.col("balance") + 1)
        for alias, df in (("crm", crm), ("erp", erp))
    }
    return target, staged


def document_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A UUID per document, in one of three spellings."""
    digits = F.md5(F.col("text"))
    dashed = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")
    spelling = (
        F.when(F.col("lang") == "en", F.upper(digits))
        .when(F.col("lang") == "fr", F.concat(F.lit("{"), dashed, F.lit("}")))
        .otherwise(F.concat(F.lit("urn:uuid:"), dashed))
    )
    return table(spark, sf_dir, "documents").select("doc_id", spelling.alias("u"))


def logged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the state log, a run a day: clicks are read from the day's beginning, errors from two runs before, and one in
    seven of the sign-ups' runs ends half a week early; all others go on where the last run ended."""
    order = Window.partitionBy("table_name").orderBy("created_ts")
    kind, upper = F.col("table_name"), F.col("index_value").cast("timestamp_ntz")
    early = (kind == "signup") & (F.dayofweek("created_ts") == 1)
    ends = idx_log(spark, sf_dir).withColumn("upper_ts", F.when(early, upper - F.expr("INTERVAL 84 HOURS")).otherwise(upper))
    lower = (
        F.when(kind == "click", F.col("created_ts"))
        .when(kind == "error", F.lag("upper_ts", 2).over(order))
        .otherwise(F.lag("upper_ts", 1).over(order))
    )
    return ends.select("table_name", "created_ts", lower.alias("lower_ts"), "upper_ts")


def events_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties whose shape has drifted: purchases have a label and a list, views a decimal number, and some errors were
    cut short."""
    kind, props = F.col("event_type"), F.col("props")
    number = F.regexp_extract(props, r"(\d+)", 1)
    text = (
        F.when(kind == "purchase", F.concat(F.lit('{"k": '), number, F.lit(', "label": "n'), number, F.lit('", "tags": ["a", "b"]}')))
        .when(kind == "view", F.concat(F.lit('{"k": '), number, F.lit(".5}")))
        .when((kind == "error") & (F.col("event_id") % 5 == 0), F.substring(props, 1, 5))
        .when(kind != "signup", props)
    )
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("props"))
