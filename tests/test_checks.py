import json

from ledgerlark.operators import checks
from ledgerlark.operators.checks import timestamp_faults, validate, validate_json
from ledgerlark.schema import TRANSACTION

GOOD = ("t", 1000, 0.01, "USD", "m", "2024-01-01T00:00:00+00:00", "US", 0)
NAMES = TRANSACTION.fieldNames()


def row(**changes):
    return tuple({**dict(zip(NAMES, GOOD)), **changes}.values())


def errors_of(spark, *rows):
    df = spark.createDataFrame([*rows], TRANSACTION)
    valid, bad = validate(df)
    assert valid.count() + bad.count() == len(rows)
    return [r["errors"] for r in bad.collect()]


def test_bounds_are_inclusive(spark):
    rows = [row(), row(user_id=9999), row(amount=10000.0), row(is_fraud=1)]
    assert errors_of(spark, *rows) == []


def test_one_step_outside_the_bounds(spark):
    for bad in ({"user_id": 999}, {"user_id": 10000}, {"amount": 0.0}, {"amount": 10000.01},
                {"is_fraud": 2}, {"is_fraud": -1}):
        (name,) = bad
        assert errors_of(spark, row(**bad)) == [[f"{name}: range"]]


def test_patterns_match_the_whole_text(spark):
    for value in ("usd", "USD\n", "US", "USDX", ""):
        assert errors_of(spark, row(currency=value)) == [["currency: pattern"]]
    assert errors_of(spark, row(location="us")) == [["location: pattern"]]


def test_optional_and_required_fields(spark):
    assert errors_of(spark, row(merchant=None, location=None)) == []
    for name in ("transaction_id", "user_id", "amount", "currency", "timestamp", "is_fraud"):
        assert errors_of(spark, row(**{name: None})) == [[f"{name}: required"]]


def test_all_faults_are_listed(spark):
    found = errors_of(spark, row(user_id=1, currency="x", timestamp="?"))
    assert found == [["user_id: range", "currency: pattern", "timestamp: date-time"]]


def test_a_frame_without_a_required_column(spark):
    df = spark.createDataFrame([row()], TRANSACTION).drop("amount")
    assert [r["errors"] for r in validate(df)[1].collect()] == [["amount: required"]]


def test_raw_json(spark):
    good = dict(zip(NAMES, GOOD))
    cases = [
        (good, None),
        ({**good, "extra": [1]}, None),
        ({**good, "user_id": 1000.5}, None),
        ({k: v for k, v in good.items() if k not in ("merchant", "location")}, None),
        ({**good, "is_fraud": 1.0}, None),
        ({**good, "is_fraud": 0.5}, ["is_fraud: type"]),
        ({**good, "is_fraud": True}, ["is_fraud: type"]),
        ({**good, "user_id": "1000"}, ["user_id: type"]),
        ({**good, "merchant": None}, ["merchant: type"]),
        ({**good, "merchant": 5}, ["merchant: type"]),
        ({**good, "amount": 10 ** 30}, ["amount: range"]),
        ({k: v for k, v in good.items() if k != "amount"}, ["amount: required"]),
        ({**good, "currency": "USD\n"}, ["currency: pattern"]),
    ]
    texts = [(json.dumps(c), e) for c, e in cases]
    texts += [("{", ["not JSON"]), ("[]", ["not an object"]), ("5", ["not an object"])]
    df = spark.createDataFrame([(t,) for t, _ in texts], "raw_json string")
    valid, bad = validate_json(df)
    found = {r["raw_json"]: r["errors"] for r in bad.collect()}
    found |= {r["raw_json"]: None for r in valid.collect()}
    assert found == dict(texts)
    assert valid.columns == ["raw_json"]


def test_a_repeated_key_has_a_reason_of_its_own(spark):
    good = '{"transaction_id":"a","user_id":1000,"amount":1.5,"currency":"USD","timestamp":"2024-01-01T00:00:00Z","is_fraud":0}'
    rows = [(1, good), (2, good[:-1] + ',"amount":2}'), (3, "{")]
    valid, bad = validate_json(spark.createDataFrame(rows, "id int, raw_json string"))
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.errors for r in bad.collect()} == {2: ["repeated key"], 3: ["not JSON"]}


def test_one_whole_json_value(spark):
    good = '{"transaction_id":"a","user_id":1000,"amount":5.5,"currency":"USD","timestamp":"2024-01-01T00:00:00Z","is_fraud":0}'
    tails = ["", " \n", " junk", good, "," + good, "]", "}", "] {}", "]}", '],"w":[1', ',"w":1', "]} {", ', 1]  {}']
    rows = [(i, good + tail) for i, tail in enumerate(tails)]
    rows += [(100, good.replace("5.5", "NaN")), (101, good.replace("{", '{"user_id":1000,')), (102, None), (103, ""), (104, "[1]"), (105, "1 2")]
    rows += [(106, good.replace("{", '{"x":[1,{"y":"]"}],'))]
    valid, bad = validate_json(spark.createDataFrame(rows, "id int, raw_json string"))
    assert sorted(r.id for r in valid.collect()) == [0, 1, 106]
    found = {r.id: r.errors for r in bad.collect()}
    assert found.pop(101) == ["repeated key"] and found.pop(104) == ["not an object"]
    assert set(map(tuple, found.values())) == {("not JSON",)}


def test_only_full_date_times_pass(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5+02:00", "2024", "12:30:00", "2024-01-01", "2024-13-01T00:00:00Z", "2024-01-01T00:00:00Z\n"]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    bad = timestamp_faults({"timestamp": df["timestamp"]})[0][1]
    assert [r[0] for r in df.select(bad).collect()] == [False, False, True, True, True, True, True]


def test_a_message_is_judged_once(spark):
    """The filter on the result does not repeat the work on a message."""
    messages = spark.createDataFrame([('{"amount": 5}',), ("x",)], "raw_json string")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        plan = checks.validate_json(messages)[1]._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("currency: pattern") == 1
