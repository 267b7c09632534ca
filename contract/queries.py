"""Registered queries: each operator over the given tables."""

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import bindings as given
from ledgerlark.functions.time import as_timestamp, epoch_seconds, with_time_parts
from ledgerlark.operators import boosting, checks, encode, rolling
from ledgerlark.operators.balance import (
    class_balance,
    scale_pos_weight,
    with_event_seconds,
    with_label,
)
from ledgerlark.operators.decode import decode, to_bronze, undecodable, with_event_time
from ledgerlark.operators.ranking import ranking_metrics
from ledgerlark.operators.split import split_hash, split_time
from ledgerlark.plans.features import build_features
from ledgerlark.plans.ingest import to_silver
from ledgerlark.plans.training import TrainSpec, fit, prepare, score, train
from ledgerlark.schema import PAYLOAD
from ledgerlark.session import fresh_dir
from ledgerlark.sinks.publish import encode as encode_messages
from ledgerlark.sinks.runs import compare_runs, load_model, log_run, save_model
from ledgerlark.sinks.tables import write_run
from ledgerlark.sources import synthetic
from ledgerlark.sources.streams import LandingFolder
from ledgerlark.sources.tables import scan_features, scan_silver
from ledgerlark.streaming import ingest
from ledgerlark.streaming.accounted import scan_account, scan_accounted

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(name: str) -> Column:
    """Timestamps leave a query without zone."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def row_id() -> Column:
    return F.col("transaction_id").alias("id")


# Scans, bronze and silver


@query
def scan_transactions(spark, sf_dir):
    return given.from_events(spark, sf_dir)


@query
def scan_silver_partitions(spark, sf_dir):
    root = fresh_dir(spark, "silver")
    rows = with_event_time(given.from_events(spark, sf_dir))
    rows.write.partitionBy("event_date").parquet(root)
    return (
        scan_silver(spark, root)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount_sum"),
        )
    )


@query
def bronze_raw_records(spark, sf_dir):
    return to_bronze(given.messages(spark, sf_dir)).select("raw_json", plain("kafka_ts"))


@query
def bronze_ingest_stamp(spark, sf_dir):
    """Every row of a batch has the batch's one stamp."""
    bronze = to_bronze(given.messages(spark, sf_dir))
    return bronze.agg(
        F.count("ingest_ts").alias("stamped"), F.countDistinct("ingest_ts").alias("stamps")
    )


@query
def publish_encode(spark, sf_dir):
    sent = encode_messages(given.from_events(spark, sf_dir))
    return sent.select(*[F.col(c).cast("string").alias(c) for c in ("key", "value")])


@query
def silver_parse_json(spark, sf_dir):
    rows = decode(to_bronze(given.messages(spark, sf_dir)))
    return rows.select(*PAYLOAD, plain("kafka_ts"))


@query
def silver_event_time(spark, sf_dir):
    rows = with_event_time(decode(to_bronze(given.messages(spark, sf_dir))))
    rows = rows.where(F.col("transaction_id").isNotNull())
    return rows.select(row_id(), plain("event_time"), "event_date")


@query
def silver_dedup(spark, sf_dir):
    rows = to_silver(to_bronze(given.messages(spark, sf_dir)))
    return rows.select(row_id(), "user_id", "amount", "event_date", plain("kafka_ts"))


@query
def silver_keep_bad(spark, sf_dir):
    """One row with the NULL id stands for everything that did not decode."""
    rows = to_silver(to_bronze(given.messages(spark, sf_dir)), keep_bad=True)
    return rows.select(row_id(), "user_id", "amount", "event_date")


@query
def silver_quarantine(spark, sf_dir):
    bad = undecodable(to_bronze(given.messages(spark, sf_dir)))
    return bad.select("raw_json", plain("kafka_ts"), "reason")


# Streams: the table arrives in a landing folder, the stream runs to its end


def _landed(spark, sf_dir) -> tuple[str, str]:
    root = fresh_dir(spark, "stream")
    given.messages(spark, sf_dir).write.parquet(f"{root}/landing")
    return root, f"{root}/landing"


def _finish(*started) -> None:
    for one in started:
        one.awaitTermination()


@query
def stream_bronze_append(spark, sf_dir):
    root, landing = _landed(spark, sf_dir)
    messages = LandingFolder(landing).open(spark)
    _finish(ingest.start_bronze(messages, f"{root}/bronze", f"{root}/ckpt", drain=True))
    return spark.read.parquet(f"{root}/bronze").select("raw_json", plain("kafka_ts"))


@query
def stream_silver_dedup(spark, sf_dir):
    """Bronze and silver as two queries on the same source."""
    root, landing = _landed(spark, sf_dir)
    ingest.configure_state(spark)
    source = LandingFolder(landing)
    _finish(*ingest.start_ingest(spark, source, root, f"{root}/ckpt", drain=True))
    rows = scan_silver(spark, f"{root}/silver")
    return rows.select(row_id(), "user_id", "amount", "event_date")


@query
def stream_silver_from_bronze(spark, sf_dir):
    """Silver follows the committed bronze files; keys expire with the watermark."""
    root, landing = _landed(spark, sf_dir)
    ingest.configure_state(spark)
    started = ingest.start_ingest(
        spark,
        LandingFolder(landing),
        root,
        f"{root}/ckpt",
        mode="watermark",
        silver_from_bronze=True,
        drain=True,
    )
    _finish(*started)
    rows = scan_silver(spark, f"{root}/silver")
    return rows.select(row_id(), "user_id", "amount", "event_date")


@query
def stream_late_drop(spark, sf_dir):
    """Two halves of the table in order, then the first half again under new ids.

    Each step restarts the stream from its checkpoint. In the third step everything at or before
    the watermark, an hour behind the latest event, is late.
    """
    root = fresh_dir(spark, "late")
    ingest.configure_state(spark)
    rows = given.from_events(spark, sf_dir, "event_id", "ts")
    middle = rows.agg(F.floor(F.max("event_id") / 2)).head()[0]
    sent = (F.col("ts").cast("timestamp") + F.expr("interval 5 seconds")).alias("timestamp")
    late = rows.withColumn("transaction_id", F.concat(F.lit("late-"), "transaction_id"))
    steps = [rows.where(F.col("event_id") <= middle), rows.where(F.col("event_id") > middle), late]
    for step in steps:
        sent_rows = step.select(
            F.lit(None).cast("binary").alias("key"),
            F.to_json(F.struct(*PAYLOAD)).cast("binary").alias("value"),
            F.lit("transactions").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
            sent,
            F.lit(0).alias("timestampType"),
        )
        sent_rows.write.mode("append").parquet(f"{root}/landing")
        bronze = to_bronze(LandingFolder(f"{root}/landing").open(spark))
        _finish(ingest.start_silver(bronze, f"{root}/silver", f"{root}/ckpt", drain=True))
    return scan_silver(spark, f"{root}/silver").select(row_id(), "event_date")


def _accounted(spark, sf_dir) -> str:
    """Half of the table, the other half, then all of it again under its own and under new ids; the
    stream is started anew for each of the three."""
    root = fresh_dir(spark, "accounted")
    rows = given.from_events(spark, sf_dir, "event_id", "ts")
    middle = rows.agg(F.floor(F.max("event_id") / 2)).head()[0]
    late = rows.withColumn("transaction_id", F.concat(F.lit("late-"), "transaction_id"))
    halves = [rows.where(F.col("event_id") <= middle), rows.where(F.col("event_id") > middle)]
    for step in [*halves, rows.unionByName(late)]:
        sent = step.select(
            F.lit(None).cast("binary").alias("key"),
            F.to_json(F.struct(*PAYLOAD)).cast("binary").alias("value"),
            F.lit("transactions").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        sent.write.mode("append").parquet(f"{root}/landing")
        bronze = to_bronze(LandingFolder(f"{root}/landing").open(spark))
        _finish(ingest.start_silver(bronze, f"{root}/silver", f"{root}/ckpt", mode="table", drain=True))
    return f"{root}/silver"


@query
def stream_late_account(spark, sf_dir):
    """What every micro-batch received, found late or repeated, and kept, over three starts."""
    rows = scan_account(spark, _accounted(spark, sf_dir))
    return rows.select("batch", "rows", "late", "repeated", "kept", plain("latest"))


@query
def stream_dedup_table(spark, sf_dir):
    """Ids of the first micro-batch are still refused in the last one, without any state."""
    rows = scan_accounted(spark, _accounted(spark, sf_dir))
    return rows.select(row_id(), "user_id", "amount", "event_date", "batch")


# Features


@query
def feat_event_ts(spark, sf_dir):
    rows = given.from_events(spark, sf_dir, "ts")
    rows = rows.withColumn("as_ts", F.col("ts").cast("timestamp"))
    return rows.select(
        row_id(),
        as_timestamp(rows, "timestamp").cast("timestamp_ntz").alias("from_text"),
        as_timestamp(rows, "as_ts").cast("timestamp_ntz").alias("from_timestamp"),
    )


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_ts", as_timestamp(rows, "timestamp"))


def _with_seconds(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sec", epoch_seconds(rows, "event_ts"))


@query
def feat_time_parts(spark, sf_dir):
    rows = with_time_parts(_timed(given.from_events(spark, sf_dir)))
    return rows.select(row_id(), "hour", "dayofweek")


@query
def feat_epoch_seconds(spark, sf_dir):
    rows = _timed(given.from_events(spark, sf_dir, "ts"))
    return rows.select(
        row_id(),
        epoch_seconds(rows, "event_ts").alias("sec"),
        epoch_seconds(rows, "ts").alias("sec_of_ntz"),
    )


def _rolled(rows: DataFrame, spans: list[str], **how) -> DataFrame:
    chosen = {s: rolling.SPANS[s] for s in spans}
    rows = _with_seconds(_timed(rows)).select("transaction_id", "user_id", "amount", "sec")
    rolled = rolling.add_rolling(rows, second="sec", spans=chosen, **how)
    return rolled.select(row_id(), *[c for c in rolled.columns if c not in rows.columns])


@query
def feat_roll_1h(spark, sf_dir):
    return _rolled(given.from_events(spark, sf_dir), ["1h"])


@query
def feat_roll_24h(spark, sf_dir):
    return _rolled(given.from_events(spark, sf_dir), ["24h"])


@query
def feat_roll_running_sums(spark, sf_dir):
    return _rolled(given.from_events(spark, sf_dir), ["1h", "24h"], method=rolling.BY_ROW)


@query
def feat_roll_per_second(spark, sf_dir):
    return _rolled(given.from_events(spark, sf_dir), ["1h", "24h"], method=rolling.BY_SECOND)


@query
def feat_roll_peers(spark, sf_dir):
    """Orders fall on whole days: ties, and frames that end exactly a day back."""
    return _rolled(given.from_orders(spark, sf_dir), ["1h", "24h"], method=rolling.BY_ROW)


@query
def feat_roll_few_users(spark, sf_dir):
    return _rolled(given.from_lineitem(spark, sf_dir), ["1h", "24h"])


@query
def feat_roll_hot_user(spark, sf_dir):
    """A third of all rows belongs to one user, summed up per second before the shuffle."""
    rows = given.from_events(spark, sf_dir, "event_id")
    hot = F.when(F.col("event_id") % 3 == 0, 1000).otherwise(F.col("user_id"))
    return _rolled(rows.withColumn("user_id", hot), ["1h", "24h"], method=rolling.BY_SECOND)


def _feature_edges(features: DataFrame) -> DataFrame:
    return features.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query
def feat_project(spark, sf_dir):
    """A missing input column is missing from the output, nothing else changes."""
    return _feature_edges(build_features(given.from_events(spark, sf_dir).drop("currency")))


@query
def feat_table(spark, sf_dir):
    """Messages to silver to the whole feature table."""
    silver = to_silver(to_bronze(given.messages(spark, sf_dir)))
    return _feature_edges(build_features(silver))


@query
def sink_features(spark, sf_dir):
    """Three runs of two dates; the second run of a date replaces the first."""
    root, features = fresh_dir(spark, "features"), build_features(given.from_events(spark, sf_dir))
    write_run(features.where("user_id % 3 = 0"), root, "2024-01-01")
    write_run(features, root, "2024-01-01")
    write_run(features.where("user_id % 2 = 0"), root, "2024-01-02")
    dates = ["2024-01-01", "2024-01-02"]
    read = [scan_features(spark, f"{root}/date={d}").withColumn("date", F.lit(d)) for d in dates]
    return read[0].unionByName(read[1]).select(row_id(), "u_txn_cnt_24h", "date")


@query
def sink_run_ledger(spark, sf_dir):
    """Two runs, logged with metrics of the table and compared."""
    ledger, rows = fresh_dir(spark, "ledger"), given.from_events(spark, sf_dir, "event_id")
    for part in (0, 1):
        half = rows.where(F.col("event_id") % 2 == part)
        found = half.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total")
        ).head()
        log_run(spark, ledger, f"half-{part}", {"part": part}, found.asDict())
    return compare_runs(spark, ledger, ["n", "total"]).select("run_name", "n", "total")


@query
def sink_model(spark, sf_dir):
    """The scores of a stored and reloaded pipeline with boosted trees beside the original's."""
    rows, path = prepare(given.from_events(spark, sf_dir)), fresh_dir(spark, "model")
    model = fit(rows, TrainSpec().with_trees(max_iter=5)).model
    save_model(model, path)
    columns = ["probability", "margin"]
    kept = score(model, rows).select("transaction_id", F.struct(*columns).alias("a"))
    again = score(load_model(path), rows).select("transaction_id", F.struct(*columns).alias("b"))
    both = kept.join(again, "transaction_id")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") != F.col("b")).alias("differing")
    )


# Checks


def _faulty(spark, sf_dir) -> DataFrame:
    """F1 with faults put in by the event id."""
    e, when = F.col("event_id"), F.when
    rows = given.from_events(spark, sf_dir, "event_id")
    return rows.select(
        e.alias("id"),
        when(e % 53 != 0, F.col("transaction_id")).alias("transaction_id"),
        when(e % 11 == 0, 999)
        .when(e % 13 == 0, F.lit(None))
        .otherwise(F.col("user_id"))
        .cast("int")
        .alias("user_id"),
        when(e % 17 == 0, 0.0).when(e % 19 == 0, 10000.01).otherwise(F.col("amount")).alias("amount"),
        when(e % 23 == 0, "usd").when(e % 29 == 0, "USD\n").otherwise("USD").alias("currency"),
        "merchant",
        when(e % 41 == 0, "not a time")
        .when(e % 59 == 0, "2024")
        .when(e % 61 == 0, "12:30:00")
        .when(e % 67 == 0, "2024-01-01")
        .otherwise(F.col("timestamp"))
        .alias("timestamp"),
        when(e % 31 == 0, "us").when(e % 37 != 0, F.col("location")).alias("location"),
        when(e % 43 == 0, 2).when(e % 47 != 0, F.col("is_fraud")).alias("is_fraud"),
    )


def _passed(rows: DataFrame, faults) -> DataFrame:
    return rows.select("id", (~checks.any_fault(faults)).alias("ok"))


def _values(rows: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in rows.columns}


@query
def check_required(spark, sf_dir):
    rows = _faulty(spark, sf_dir)
    return _passed(rows, checks.required_faults(rows.columns))


@query
def check_ranges(spark, sf_dir):
    rows = _faulty(spark, sf_dir)
    return _passed(rows, checks.range_faults(_values(rows)))


@query
def check_patterns(spark, sf_dir):
    rows = _faulty(spark, sf_dir)
    return _passed(rows, checks.pattern_faults(_values(rows)))


@query
def check_timestamp(spark, sf_dir):
    rows = _faulty(spark, sf_dir)
    return _passed(rows, checks.timestamp_faults(_values(rows)))


@query
def check_quarantine(spark, sf_dir):
    _, bad = checks.validate(_faulty(spark, sf_dir))
    return bad.select(
        "id",
        F.size("errors").cast("int").alias("n_errors"),
        F.concat_ws("; ", "errors").alias("errors"),
    )


def _odd_messages(spark, sf_dir) -> DataFrame:
    """F1 as JSON text with type faults put in by the event id."""
    e = F.col("event_id")
    text = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    number = lambda c: F.col(c).cast("string")

    def member(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    members = [
        member(
            "transaction_id",
            F.when(e % 11 == 0, number("event_id")).otherwise(text("transaction_id")),
        ),
        F.when(
            e % 13 != 0,
            member(
                "user_id",
                F.when(e % 17 == 0, text("event_id"))
                .when(e % 19 == 0, "true")
                .when(e % 23 == 0, "1000.5")
                .otherwise(number("user_id")),
            ),
        ),
        member("amount", F.when(e % 29 == 0, "null").when(e % 73 == 0, "NaN").otherwise(number("amount"))),
        member("currency", F.when(e % 31 == 0, '["USD"]').otherwise(text("currency"))),
        F.when(
            e % 37 != 0,
            member("merchant", F.when(e % 41 == 0, "null").otherwise(text("merchant"))),
        ),
        member("timestamp", text("timestamp")),
        member("location", F.when(e % 43 == 0, '{"c":"US"}').otherwise(text("location"))),
        member(
            "is_fraud",
            F.when(e % 47 == 0, "0.5").when(e % 53 == 0, "1.0").otherwise(number("is_fraud")),
        ),
    ]
    body = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))
    # Texts that go on after the object, and a key that stands twice.
    raw = (
        F.when(e % 59 == 0, "not json")
        .when(e % 61 == 0, "[1]")
        .when(e % 67 == 0, F.concat(body, F.lit(" junk")))
        .when(e % 71 == 0, F.concat(body, body))
        .when(e % 79 == 0, F.concat(F.lit('{"amount":1,'), F.substring(body, 2, 1000)))
        .when(e % 83 == 0, F.concat(body, F.lit("] {}")))
        .otherwise(body)
    )
    rows = given.from_events(spark, sf_dir, "event_id")
    return rows.select(e.alias("id"), raw.alias("raw_json"))


@query
def check_types(spark, sf_dir):
    rows = checks.with_json_types(_odd_messages(spark, sf_dir))
    return _passed(rows, checks.type_faults())


@query
def check_json_quarantine(spark, sf_dir):
    _, bad = checks.validate_json(_odd_messages(spark, sf_dir))
    return bad.select(
        "id",
        F.size("errors").cast("int").alias("n_errors"),
        F.concat_ws("; ", "errors").alias("errors"),
    )


# Synthetic transactions: one per event id


PARAMS = synthetic.Params()


def _drawn(spark, sf_dir) -> DataFrame:
    events = given.table(spark, sf_dir, "events")
    ids = events.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    return synthetic.base_rows(ids, PARAMS, F.col("at"))


def _crafted(rows: DataFrame, **columns: Column) -> DataFrame:
    """Base rows on which a rare rule finds something to do."""
    changed = rows.withColumns(columns)
    return changed.withColumns(
        {"base_amount": F.col("amount"), "base_merchant": F.col("merchant")}
    )


def _touched(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(row_id(), *columns, "is_fraud", "pattern")


@query
def gen_base(spark, sf_dir):
    return _drawn(spark, sf_dir).select(*PAYLOAD)


@query
def gen_compromised_users(spark, sf_dir):
    """The compromised users, with the transactions each has drawn."""
    users = synthetic.compromised_users(spark, PARAMS)
    drawn = _drawn(spark, sf_dir).select("user_id")
    # A fixed number of rows out of a fixed range.
    hit = drawn.join(F.broadcast(users), "user_id", "left_semi")
    return hit.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query
def gen_takeover(spark, sf_dir):
    return _touched(synthetic.takeover(_drawn(spark, sf_dir), PARAMS), "amount", "merchant")


@query
def gen_card_testing(spark, sf_dir):
    rows = _crafted(
        _drawn(spark, sf_dir),
        user_id=(F.col("id") % 9 * 500 + 1000).cast("int"),
        amount=(F.col("id") % 400 + 1).cast("double") / F.lit(100.0),
    )
    return _touched(synthetic.card_testing(rows, PARAMS), "amount", "location")


@query
def gen_collusion(spark, sf_dir):
    names = F.array(*[F.lit(m) for m in synthetic.HIGH_RISK])
    risky = F.element_at(names, (F.col("id") % 3 + 1).cast("int"))
    merchant = F.when(F.col("id") % 2 == 0, risky).otherwise(F.col("merchant"))
    rows = _crafted(_drawn(spark, sf_dir), merchant=merchant)
    return _touched(synthetic.collusion(rows, PARAMS), "amount")


@query
def gen_geo(spark, sf_dir):
    rows = _crafted(_drawn(spark, sf_dir), user_id=(F.col("id") % 36 * 250 + 1000).cast("int"))
    return _touched(synthetic.geo_anomaly(rows, PARAMS), "location")


@query
def gen_baseline(spark, sf_dir):
    return _touched(synthetic.baseline(_drawn(spark, sf_dir), PARAMS), "amount")


@query
def gen_label_noise(spark, sf_dir):
    """Every row fraudulent before the noise."""
    rows = _drawn(spark, sf_dir).withColumn("is_fraud", F.lit(1))
    return _touched(synthetic.label_noise(rows, PARAMS))


def _synthesized(spark, sf_dir) -> DataFrame:
    events = given.table(spark, sf_dir, "events")
    ids = events.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    return synthetic.synthesize(ids, F.col("at"), PARAMS)


@query
def gen_transactions(spark, sf_dir):
    return _synthesized(spark, sf_dir)


@query
def gen_fraud_rate(spark, sf_dir):
    named = F.coalesce("pattern", F.lit("none")).alias("pattern")
    return (
        _synthesized(spark, sf_dir)
        .groupBy(named)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("is_fraud").alias("frauds"),
        )
    )


# Training and evaluation


@query
def train_label_filter(spark, sf_dir):
    rows = given.from_events(spark, sf_dir, "event_id")
    rows = rows.withColumn("is_fraud", F.when(F.col("event_id") % 7 != 0, F.col("is_fraud")))
    return with_label(rows).select(row_id(), "label")


@query
def train_event_ts_unix(spark, sf_dir):
    rows = with_event_seconds(_timed(given.from_events(spark, sf_dir)))
    return rows.select(row_id(), "event_ts_unix")


@query
def train_feature_columns(spark, sf_dir):
    """The selected features in order, each with the number of rows that have a value."""
    rows = prepare(build_features(given.from_events(spark, sf_dir), method=rolling.BY_ROW))
    chosen = encode.numeric_features(rows)
    counted = rows.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("pos"), F.lit(c).alias("name"), F.count(c).alias("n_filled")
                )
                for i, c in enumerate(chosen)
            ]
        ).alias("found")
    )
    return counted.select(F.inline("found"))


@query
def train_class_balance(spark, sf_dir):
    return class_balance(with_label(given.from_events(spark, sf_dir)))


@query
def train_scale_pos_weight(spark, sf_dir):
    balance = class_balance(with_label(given.from_events(spark, sf_dir)))
    return balance.select(scale_pos_weight().alias("scale_pos_weight"))


def _indexed(spark, sf_dir) -> DataFrame:
    rows = given.from_events(spark, sf_dir)
    return encode.category_indexer(rows, ["merchant", "location"]).transform(rows)


@query
def train_index_merchant(spark, sf_dir):
    return _indexed(spark, sf_dir).select("merchant", "merchant_idx").distinct()


@query
def train_index_location(spark, sf_dir):
    """Equal or nearly equal frequencies."""
    return _indexed(spark, sf_dir).select("location", "location_idx").distinct()


@query
def train_index_other(spark, sf_dir):
    """Only three categories of their own: the rest shares the next index."""
    rows = given.from_events(spark, sf_dir)
    indexed = encode.category_indexer(rows, ["merchant"], max_categories=3).transform(rows)
    return indexed.groupBy("merchant", "merchant_idx").agg(F.count(F.lit(1)).alias("n"))


@query
def train_index_wide(spark, sf_dir):
    """As many categories as rows."""
    rows = given.from_events(spark, sf_dir)
    table = encode.category_table(rows, "transaction_id")
    return encode.indexed_by(rows, "transaction_id", table).select(row_id(), "transaction_id_idx")


@query
def train_index_table(spark, sf_dir):
    rows = given.from_events(spark, sf_dir)
    return encode.category_table(rows, "merchant")


@query
def train_onehot(spark, sf_dir):
    indexed = _indexed(spark, sf_dir)
    encoded = encode.one_hot(["merchant"]).fit(indexed).transform(indexed)
    slots = vector_to_array("merchant_ohe")
    return encoded.select(
        "merchant",
        (F.array_position(slots, 1.0) - 1).cast("int").alias("slot"),
        F.size(slots).cast("int").alias("width"),
    ).distinct()


@query
def train_fill_missing(spark, sf_dir):
    """Missing amounts take the median of the others; a column without any value takes 0."""
    rows = given.from_events(spark, sf_dir, "event_id")
    rows = rows.withColumn("amount", F.when(F.col("event_id") % 7 != 0, F.col("amount")))
    rows = rows.withColumn("empty", F.lit(None).cast("double"))
    filled = encode.imputer(rows, ["amount", "empty"]).transform(rows)
    return filled.select(row_id(), "amount_filled", "empty_filled")


@query
def train_assemble(spark, sf_dir):
    rows = given.from_events(spark, sf_dir)
    vectors = encode.assembler(encode.numeric_features(rows)).transform(rows)
    return vectors.select(row_id(), F.posexplode(vector_to_array("features")).alias("pos", "x"))


@query
def train_split_hash(spark, sf_dir):
    return split_hash(given.from_events(spark, sf_dir)).select(row_id(), "part")


@query
def train_split_time(spark, sf_dir):
    return split_time(_timed(given.from_events(spark, sf_dir))).select(row_id(), "part")


def _train_features(spark, sf_dir) -> DataFrame:
    return build_features(given.from_events(spark, sf_dir), method=rolling.BY_ROW)


def _metrics(spark, sf_dir, model: str) -> DataFrame:
    trained = train(_train_features(spark, sf_dir), TrainSpec(model=model))
    return spark.createDataFrame(list(trained.metrics.items()), "metric string, value double")


@query
def train_gbt_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, "gbt")


@query
def train_weighted_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, "xgb")


@query
def train_boosted_tree(spark, sf_dir):
    """The margins of one regularised tree of depth 2 on two features of few values."""
    e = F.col("event_id")
    rows = given.from_events(spark, sf_dir, "event_id").withColumns({"a": e % 5, "b": e % 7})
    odd = ((F.col("a") >= 3) & (F.col("b") < 2)) | (e % 11 == 0)
    matrix = encode.assembler(["a", "b"]).transform(rows.withColumn("label", odd.cast("double")))
    cuts = boosting.find_cuts(matrix, 2, 2)
    trees = boosting.fit_trees(matrix.select("features", "label"), cuts, rounds=1, depth=2, step=0.3, l2=1.0)
    scored = boosting.BoostedTrees.of(cuts, trees).transform(matrix)
    return scored.select(row_id(), F.round(vector_to_array("rawPrediction")[1], 9).alias("margin"))


@query
def train_score(spark, sf_dir):
    features = _train_features(spark, sf_dir)
    model = fit(prepare(features), TrainSpec()).model
    return score(model, features).select(row_id(), "probability")


def _ranked(spark, sf_dir) -> DataFrame:
    return ranking_metrics(with_label(given.from_events(spark, sf_dir)), "amount")


@query
def eval_auc_roc(spark, sf_dir):
    return _ranked(spark, sf_dir).select(F.round("auc_roc", 6).alias("auc_roc"))


@query
def eval_auc_pr(spark, sf_dir):
    return _ranked(spark, sf_dir).select(F.round("auc_pr", 6).alias("auc_pr"))


@query
def eval_auc_skewed(spark, sf_dir):
    """49 of 50 rows share one score; rows without a label do not count."""
    rows = given.from_events(spark, sf_dir, "event_id")
    e = F.col("event_id")
    scored = rows.select(
        F.when(e % 50 == 3, F.col("amount")).otherwise(1.0).alias("score"),
        F.when(e % 7 != 0, (e % 3 == 0).cast("double")).alias("label"),
    )
    found = ranking_metrics(scored, "score")
    return found.select(*[F.round(c, 6).alias(c) for c in ("auc_roc", "auc_pr")])


@query
def feat_roll_large_amounts(spark, sf_dir):
    """Amounts of any size beside cents: nothing is lost, and nothing stays behind."""
    e = F.col("event_id")
    rows = given.from_events(spark, sf_dir, "event_id")
    odd = F.when(e % 10 == 0, 1e300).when(e % 10 == 1, -1e300).when(e % 10 == 2, 1e-30).when(e % 10 == 3, 1e-17)
    changed = F.when(e % 10 == 4, None).otherwise(F.coalesce(odd, F.col("amount")))
    return _rolled(rows.withColumn("amount", changed), ["1h", "24h"])


@query
def feat_roll_hot_hour(spark, sf_dir):
    """A third of all rows belongs to one user, within one hour; a tenth has no time."""
    rows, e = given.from_events(spark, sf_dir, "event_id"), F.col("event_id")
    hot = _with_seconds(_timed(rows)).select(
        "transaction_id",
        F.when(e % 3 == 0, 1000).otherwise(F.col("user_id")).alias("user_id"),
        "amount",
        F.when(e % 10 == 0, None).when(e % 3 == 0, e % 3600).otherwise(F.col("sec")).alias("sec"),
    )
    rolled = rolling.add_rolling(hot, second="sec", method=rolling.BY_BLOCK, chunk_seconds=60)
    return rolled.select(row_id(), *[c for c in rolled.columns if c.startswith("u_")])
