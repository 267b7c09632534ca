import dataclasses

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.checks import validate
from ledgerlark.schema import PAYLOAD
from ledgerlark.sources import synthetic
from ledgerlark.sources.synthetic import HIGH_RISK, Params, base_rows, generate

AT = "2024-01-01 00:00:00"


def at():
    return F.lit(AT).cast("timestamp")


def made(spark, n, params=None, partitions=None):
    return generate(spark, n, at(), params, partitions)


def sure(**rates):
    """Params under which the given rules always fire and labels are kept."""
    return Params(label_noise=0.0, **rates)


def crafted(spark, params, rows):
    """Base rows with (user, amount, merchant) put in."""
    ids = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, u int, a double, m string")
    base = base_rows(ids, params, at()).join(ids, "id")
    base = base.withColumns({"user_id": F.col("u"), "amount": F.col("a"), "merchant": F.col("m")})
    return base.withColumns({"base_amount": F.col("a"), "base_merchant": F.col("m")})


def test_rows_do_not_depend_on_partitions(spark):
    one, many = made(spark, 2000, partitions=1), made(spark, 2000, partitions=8)
    assert one.exceptAll(many).count() == many.exceptAll(one).count() == 0
    other = made(spark, 2000, Params(seed=7))
    assert one.select("transaction_id").intersect(other.select("transaction_id")).count() == 0


def test_base_rows_stay_in_their_ranges(spark):
    rows = base_rows(spark.range(20000), Params(), at())
    r = rows.agg(
        F.min("user_id"), F.max("user_id"), F.min("amount"), F.max("amount"),
        F.min("timestamp"), F.max("timestamp"), F.countDistinct("transaction_id"),
        F.countDistinct("location"), F.countDistinct("merchant"), F.avg("amount"),
    ).head()
    assert 1000 <= r[0] < 1010 and 9990 < r[1] <= 9999
    assert 0.01 <= r[2] < 5 and 9990 < r[3] <= 10000
    assert "2023-12-31T23:55:0" <= r[4] and r[5] <= "2024-01-01T00:50:00.000000+00:00"
    assert r[6] == 20000 and r[7] == len(synthetic.PLACES) and r[8] > 5000
    assert 4900 < r[9] < 5100
    assert rows.where("amount <> round(amount, 2)").count() == 0


def test_all_rows_pass_the_checks(spark):
    rows = made(spark, 5000)
    assert rows.columns == [*PAYLOAD, "pattern"]
    assert validate(rows)[1].count() == 0


def test_fraud_rate_follows_from_the_rules(spark):
    n = 400_000
    rates = {
        r["pattern"]: r["n"] / n
        for r in made(spark, n).groupBy("pattern").agg(F.count("*").alias("n")).collect()
    }
    # Users 1000 to 9999; 50 compromised, 18 multiples of 500.
    assert rates["account_takeover"] == pytest.approx(50 / 9000 * 0.95 * 0.3, rel=0.15)
    assert rates["geo_anomaly"] == pytest.approx(18 / 9000 * 0.1, rel=0.3)
    assert rates["baseline"] == pytest.approx(0.002, rel=0.1)
    assert "merchant_collusion" not in rates
    fraud = made(spark, n).agg(F.avg("is_fraud")).head()[0]
    suspicious = sum(v for k, v in rates.items() if k)
    assert fraud == pytest.approx(suspicious * 0.985, rel=0.05)


def test_high_risk_share(spark):
    params = Params(high_risk_share=0.2)
    rows = base_rows(spark.range(20000), params, at())
    share = rows.groupBy("merchant").count().where(F.col("merchant").isin(HIGH_RISK)).collect()
    assert len(share) == 3 and sum(r["count"] for r in share) == pytest.approx(4000, rel=0.1)
    patterns = {r[0] for r in made(spark, 20000, params).select("pattern").distinct().collect()}
    assert "merchant_collusion" in patterns


def test_compromised_users(spark):
    users = [r[0] for r in synthetic.compromised_users(spark, Params()).collect()]
    assert len(set(users)) == 50 and all(1000 <= u < 9999 for u in users)
    again = [r[0] for r in synthetic.compromised_users(spark, Params()).collect()]
    assert sorted(users) == sorted(again)


def test_card_testing_needs_a_small_amount_and_a_round_user(spark):
    p = sure(testing_rate=1.0)
    rows = crafted(spark, p, [(1000, 1.5, "m"), (1000, 2.0, "m"), (1001, 1.5, "m")])
    found = synthetic.card_testing(rows, p).orderBy("id").collect()
    assert [r["is_fraud"] for r in found] == [1, 0, 0]
    assert found[0]["location"] == "US" and 0.01 <= found[0]["amount"] <= 2
    assert found[1]["amount"] == 2.0


def test_collusion_looks_at_the_base_row(spark):
    p = sure(collusion_rate=1.0)
    rows = crafted(
        spark, p, [(1001, 3001.0, "QuickCash"), (1001, 3000.0, "QuickCash"), (1001, 9000.0, "m")]
    )
    # An earlier rule changed amount and merchant; the conditions ignore that.
    rows = rows.withColumns({"amount": F.lit(1.0), "merchant": F.lit("other")})
    found = synthetic.collusion(rows, p).orderBy("id").collect()
    assert [r["is_fraud"] for r in found] == [1, 0, 0]
    assert 300 <= found[0]["amount"] < 1500


def test_takeover_needs_a_compromised_user_and_a_large_amount(spark):
    p = sure(takeover_rate=1.0)
    users = {r[0] for r in synthetic.compromised_users(spark, p).collect()}
    bad, good = min(users), next(u for u in range(1000, 2000) if u not in users)
    rows = crafted(spark, p, [(bad, 500.01, "m"), (bad, 500.0, "m"), (good, 900.0, "m")])
    found = synthetic.takeover(rows, p).orderBy("id").collect()
    assert [r["is_fraud"] for r in found] == [1, 0, 0]
    assert found[0]["merchant"] in HIGH_RISK and 500 <= found[0]["amount"] < 5000


def test_a_fraud_keeps_its_first_pattern(spark):
    p = sure(geo_rate=1.0, baseline_rate=1.0)
    rows = crafted(spark, p, [(1500, 10.0, "m"), (1501, 10.0, "m")])
    found = synthetic.baseline(synthetic.geo_anomaly(rows, p), p).orderBy("id").collect()
    assert [r["pattern"] for r in found] == ["geo_anomaly", "baseline"]
    assert found[0]["amount"] == 10.0 and found[0]["location"] in ("CN", "RU", "GB")


def test_noise_relabels_but_keeps_the_change(spark):
    p = dataclasses.replace(sure(baseline_rate=1.0), label_noise=1.0)
    rows = synthetic.label_noise(synthetic.baseline(crafted(spark, p, [(1001, 10.0, "m")]), p), p)
    row = rows.head()
    assert (row["is_fraud"], row["pattern"]) == (0, "baseline") and row["amount"] >= 100
