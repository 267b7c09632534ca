"""Synthetic card transactions with known fraud patterns.

Every value is a function of the seed and the row id, so rows can be made by any number of tasks,
again after a failure, and come out the same. Each rule takes a frame and returns it changed; a
rule looks at the amount and merchant of the base row, not at what an earlier rule put there.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.draws import Draws, bits32
from ledgerlark.operators.checks import validate
from ledgerlark.schema import PAYLOAD

# Merchants of the high-risk group.
HIGH_RISK = ["QuickCash", "GlobalDigital", "FastMoneyX"]
# Countries of the geographic rule.
FAR_PLACES = ["CN", "RU", "GB"]
# Sample values for company names and locations of base rows.
SURNAMES = [
    "Adams", "Baker", "Carter", "Dixon", "Ellis", "Foster", "Grant", "Hayes",
    "Irwin", "Jensen", "Keller", "Lawson", "Mason", "Norris", "Owens", "Parker",
    "Quinn", "Reyes", "Sutton", "Turner", "Upton", "Vargas", "Walsh", "Young",
]
COMPANY_ENDINGS = ["Inc", "LLC", "Ltd", "PLC", "Group", "and Sons"]
PLACES = [
    "AR", "AU", "BR", "CA", "CH", "CN", "DE", "EG", "ES", "FR", "GB", "IN", "IT", "JP", "KE",
    "KR", "MX", "NG", "NL", "NO", "PL", "RU", "SE", "TR", "US", "VN", "ZA",
]

DRAWS = [
    "user", "amount", "jitter", "location",
    "company_form", "company_a", "company_b", "company_c",
    "company_ending", "takeover", "takeover_amount", "takeover_merchant",
    "testing", "testing_amount", "collusion", "collusion_amount",
    "geo", "geo_location", "baseline", "baseline_amount",
    "label",
]


@dataclass(frozen=True)
class Params:
    seed: int = 42
    users: tuple[int, int] = (1000, 9999)
    compromised: int = 50
    jitter_seconds: tuple[int, int] = (-300, 3000)
    # Share of base rows at a high-risk merchant. At 0 the collusion rule has nothing to act on.
    high_risk_share: float = 0.0
    takeover_rate: float = 0.3
    testing_rate: float = 0.25
    collusion_rate: float = 0.15
    geo_rate: float = 0.1
    baseline_rate: float = 0.002
    label_noise: float = 0.015
    draws: Draws = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "draws", Draws(DRAWS, self.seed))


def compromised_users(spark: SparkSession, params: Params) -> DataFrame:
    """``params.compromised`` distinct users below the top of the range: those with the smallest
    hashes."""
    low, high = params.users
    hashed = F.md5(F.concat_ws("|", F.lit(params.seed), F.lit("user"), F.col("user_id").cast("string")))
    users = spark.range(low, high).select(F.col("id").cast("int").alias("user_id"))
    return users.orderBy(bits32(hashed), "user_id").limit(params.compromised)


def _company(d: Draws) -> Column:
    a, b, c = (d.pick(f"company_{x}", SURNAMES) for x in "abc")
    form = d.integer("company_form", 0, 2)
    return (
        F.when(form == 0, F.concat(a, F.lit(" "), d.pick("company_ending", COMPANY_ENDINGS)))
        .when(form == 1, F.concat(a, F.lit("-"), b))
        .otherwise(F.concat(a, F.lit(", "), b, F.lit(" and "), c))
    )


def _uuid(digest: Column) -> Column:
    """A version 4 style UUID from 32 hex digits."""
    part = lambda start, length: F.substring(digest, start, length)
    return F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("4"), part(14, 3)),
        F.concat(F.lit("a"), part(18, 3)),
        part(21, 12),
    )


def base_rows(ids: DataFrame, params: Params, base_ts: Column, row_id: str = "id") -> DataFrame:
    """One unsuspicious transaction per id, with the draws the rules need."""
    d = params.draws
    merchant = _company(d)
    if params.high_risk_share > 0:
        # The lane is shared with the company form, which such a row does not use.
        share = d.unit("company_form") / F.lit(params.high_risk_share)
        index = F.floor(share * F.lit(float(len(HIGH_RISK)))).cast("int")
        risky = F.get(F.array(*[F.lit(m) for m in HIGH_RISK]), index)
        merchant = F.when(d.chance("company_form", params.high_risk_share), risky).otherwise(merchant)
    event = F.timestamp_add("SECOND", d.integer("jitter", *params.jitter_seconds), base_ts)
    name = F.md5(F.concat_ws("|", F.lit(params.seed), F.lit("id"), F.col(row_id).cast("string")))
    drawn = d.attach(ids, row_id).withColumn("_name", name)
    return drawn.select(
        _uuid(F.col("_name")).alias("transaction_id"),
        d.integer("user", *params.users).cast("int").alias("user_id"),
        d.cents("amount", 1, 1_000_000).alias("amount"),
        F.lit("USD").alias("currency"),
        merchant.alias("merchant"),
        F.date_format(event, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        d.pick("location", PLACES).alias("location"),
        F.lit(0).alias("is_fraud"),
        row_id,
        *d.columns,
    ).withColumns(
        {
            "base_amount": F.col("amount"),
            "base_merchant": F.col("merchant"),
            "pattern": F.lit(None).cast("string"),
        }
    )


def _mark(df: DataFrame, pattern: str, hit: Column, changes: dict[str, Column]) -> DataFrame:
    """Applies the changes to rows that are hit and not yet fraudulent."""
    applies = (F.col("is_fraud") == 0) & hit
    changed = {c: F.when(applies, v).otherwise(F.col(c)) for c, v in changes.items()}
    changed["pattern"] = F.when(applies, F.lit(pattern)).otherwise(F.col("pattern"))
    changed["is_fraud"] = F.when(applies, 1).otherwise(F.col("is_fraud"))
    return df.withColumns(changed)


def takeover(df: DataFrame, params: Params) -> DataFrame:
    d = params.draws
    flagged = compromised_users(df.sparkSession, params).withColumn("compromised", F.lit(True))
    # At most params.compromised rows out of a fixed range of user ids.
    joined = df.join(F.broadcast(flagged), "user_id", "left")
    hit = F.coalesce("compromised", F.lit(False)) & (F.col("base_amount") > 500)
    changes = {
        "amount": d.between("takeover_amount", 500, 5000),
        "merchant": d.pick("takeover_merchant", HIGH_RISK),
    }
    hit = hit & d.chance("takeover", params.takeover_rate)
    return _mark(joined, "account_takeover", hit, changes).drop("compromised")


def card_testing(df: DataFrame, params: Params) -> DataFrame:
    d = params.draws
    hit = (F.col("base_amount") < 2.0) & (F.col("user_id") % 1000 == 0)
    hit = hit & d.chance("testing", params.testing_rate)
    changes = {"amount": d.cents("testing_amount", 1, 200), "location": F.lit("US")}
    return _mark(df, "card_testing", hit, changes)


def collusion(df: DataFrame, params: Params) -> DataFrame:
    d = params.draws
    hit = F.col("base_merchant").isin(HIGH_RISK) & (F.col("base_amount") > 3000)
    hit = hit & d.chance("collusion", params.collusion_rate)
    return _mark(df, "merchant_collusion", hit, {"amount": d.between("collusion_amount", 300, 1500)})


def geo_anomaly(df: DataFrame, params: Params) -> DataFrame:
    d = params.draws
    hit = (F.col("user_id") % 500 == 0) & d.chance("geo", params.geo_rate)
    return _mark(df, "geo_anomaly", hit, {"location": d.pick("geo_location", FAR_PLACES)})


def baseline(df: DataFrame, params: Params) -> DataFrame:
    d = params.draws
    hit = d.chance("baseline", params.baseline_rate)
    return _mark(df, "baseline", hit, {"amount": d.between("baseline_amount", 100, 2000)})


def label_noise(df: DataFrame, params: Params) -> DataFrame:
    """Relabels a small share as legitimate; what a rule changed stays changed."""
    kept = params.draws.chance("label", 1 - params.label_noise)
    return df.withColumn("is_fraud", F.when(kept, F.col("is_fraud")).otherwise(0))


RULES = [takeover, card_testing, collusion, geo_anomaly, baseline, label_noise]


def synthesize(
    ids: DataFrame, base_ts: Column, params: Params | None = None, row_id: str = "id"
) -> DataFrame:
    """One transaction per id, with its fraud ``pattern``. Only rows that pass the checks."""
    params = params or Params()
    rows = reduce(
        lambda df, rule: rule(df, params), RULES, base_rows(ids, params, base_ts, row_id)
    )
    valid, _ = validate(rows)
    return valid.select(*PAYLOAD, "pattern")


def generate(
    spark: SparkSession,
    n: int,
    base_ts: Column | None = None,
    params: Params | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``n`` draws around ``base_ts`` (default: now)."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return synthesize(ids, F.current_timestamp() if base_ts is None else base_ts, params)
