"""Transaction checks: every row ends up in the valid frame or, with reasons, in quarantine."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.once import one, one_row
from ledgerlark.functions.time import parse_timestamp

# Field, JSON type and whether the field is required.
FIELDS = [
    ("transaction_id", "string", True),
    ("user_id", "number", True),
    ("amount", "number", True),
    ("currency", "string", True),
    ("merchant", "string", False),
    ("timestamp", "string", True),
    ("location", "string", False),
    ("is_fraud", "integer", True),
]
# Inclusive ranges.
RANGES = {"user_id": (1000, 9999), "amount": (0.01, 10000), "is_fraud": (0, 1)}
# Whole-text patterns. `$` would also accept a trailing newline.
PATTERNS = {"currency": r"\A[A-Z]{3}\z", "location": r"\A[A-Z]{2}\z"}

# Fields whose values, not only types, are constrained.
_CONSTRAINED = {*RANGES, *PATTERNS, "timestamp"}
_DOCUMENT, _MEMBERS, _KINDS = "_document", "_members", "_kinds"


def any_fault(faults: list[tuple[str, Column]]) -> Column:
    """True where at least one of the constraints is violated."""
    return reduce(lambda a, b: a | b, [F.coalesce(bad, F.lit(False)) for _, bad in faults])


def _listed(faults: list[tuple[str, Column]]) -> Column:
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in faults]))
    # Most rows have no fault; only the others build a list.
    return F.when(any_fault(faults), names).otherwise(F.array().cast("array<string>"))


def required_faults(columns: list[str]) -> list[tuple[str, Column]]:
    """A typed frame cannot tell an absent field from a NULL one; both count as missing."""
    return [
        (f"{name}: required", F.col(name).isNull() if name in columns else F.lit(True))
        for name, _, required in FIELDS
        if required
    ]


def range_faults(values: dict[str, Column]) -> list[tuple[str, Column]]:
    return [
        (f"{name}: range", ~values[name].between(low, high))
        for name, (low, high) in RANGES.items()
        if name in values
    ]


def pattern_faults(values: dict[str, Column]) -> list[tuple[str, Column]]:
    return [
        (f"{name}: pattern", ~values[name].rlike(pattern))
        for name, pattern in PATTERNS.items()
        if name in values
    ]


def timestamp_faults(values: dict[str, Column]) -> list[tuple[str, Column]]:
    if "timestamp" not in values:
        return []
    text = values["timestamp"]
    return [("timestamp: date-time", text.isNotNull() & parse_timestamp(text).isNull())]


def _value_faults(values: dict[str, Column]) -> list[tuple[str, Column]]:
    return range_faults(values) + pattern_faults(values) + timestamp_faults(values)


def faults_of_rows(df: DataFrame) -> Column:
    """Names of the violated constraints of a typed transaction row."""
    values = {name: F.col(name) for name, _, _ in FIELDS if name in df.columns}
    return _listed(required_faults(df.columns) + _value_faults(values))


def _member(name: str, kind: str) -> Column:
    return F.try_variant_get(F.col(f"{_MEMBERS}.{name}"), "$", kind)


def whole_document(raw: str) -> Column:
    """The text's JSON value as a variant; NULL unless the text is one value and white space.

    A parser stops at the end of the first value. Put into an array, the text must go on to the array's end: a
    second value shows as a second element, any other rest is an error unless it closes the array itself.
    Only a text with a closing bracket can do that, and put into an object it is an error then.
    """
    text = F.col(raw)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    lone = F.try_variant_get(listed, "$[1]", "variant").isNull()
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    ends = ~F.contains(text, F.lit("]")) | named.isNotNull()
    return F.when(lone & ends, F.try_variant_get(listed, "$[0]", "variant"))


def has_repeated_key(raw: str) -> Column:
    """Whether the text is an object in which a key stands twice."""
    keys = F.json_object_keys(raw)
    return F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False))


def with_json_types(messages: DataFrame, raw: str = "raw_json") -> DataFrame:
    """Adds the parsed document, its members and, as ``_kind_<field>``, the JSON type of every field:
    ``string``, ``integer``, ``number``, ``boolean``, ``null``, ``array`` or ``object``, NULL where
    the field is absent. A number without a fraction is an integer.

    Each step is a projection of its own, so that the next one reads columns instead of parsing
    again.
    """
    names = [name for name, _, _ in FIELDS]
    parsed = messages.withColumn(_DOCUMENT, whole_document(raw))
    # One walk over the document; NULL if it is not an object.
    layout = ", ".join(f"{n}: variant" for n in names)
    members = F.try_variant_get(_DOCUMENT, "$", f"struct<{layout}>")
    kinds = F.transform(F.array(*[F.col(f"{_MEMBERS}.{n}") for n in names]), _kind)
    found = parsed.withColumn(_MEMBERS, members).withColumn(_KINDS, kinds)
    return found.withColumns({f"_kind_{n}": F.col(_KINDS)[k] for k, n in enumerate(names)}).drop(_KINDS)


def _kind(member: Column) -> Column:
    # One expression for all fields: written out for each, it would be a method too long to be compiled.
    seen, number = F.schema_of_variant(member), F.try_variant_get(member, "$", "double")
    return (
        F.when(seen == "STRING", "string")
        .when(seen.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "integer")
        .when(
            seen.isin("DOUBLE", "FLOAT") | seen.startswith("DECIMAL"),
            F.when(number == F.floor(number), "integer").otherwise("number"),
        )
        .when(seen == "BOOLEAN", "boolean")
        .when(seen == "VOID", "null")
        .when(seen.startswith("ARRAY"), "array")
        .when(seen.startswith("OBJECT"), "object")
    )


def _has_kind(name: str, wanted: str) -> Column:
    kind = F.col(f"_kind_{name}")
    return kind.isin("number", "integer") if wanted == "number" else kind == wanted


def type_faults() -> list[tuple[str, Column]]:
    """On a frame ``with_json_types``. A JSON null in a typed field is a type fault, an absent
    optional field is not."""
    return [(f"{name}: type", ~_has_kind(name, kind)) for name, kind, _ in FIELDS]


def with_json_faults(messages: DataFrame, raw: str = "raw_json") -> DataFrame:
    """Adds ``errors``: names of the violated constraints of a raw JSON message."""
    typed = with_json_types(messages, raw)
    # Value constraints apply only to a value of the right type.
    values = {
        name: F.when(
            _has_kind(name, kind), _member(name, "string" if kind == "string" else "double")
        )
        for name, kind, _ in FIELDS
        if name in _CONSTRAINED
    }
    facts = F.struct(
        F.col(_DOCUMENT).isNotNull().alias("_is_json"),
        F.col(_MEMBERS).isNotNull().alias("_is_object"),
        *[F.col(f"_kind_{name}") for name, _, _ in FIELDS],
        *[v.alias(f"_value_{name}") for name, v in values.items()],
    )
    valued = typed.select(*messages.columns, one_row(facts))
    missing = [
        (f"{name}: required", F.col(f"_kind_{name}").isNull())
        for name, _, required in FIELDS
        if required
    ]
    read = {name: F.col(f"_value_{name}") for name in values}
    errors = (
        F.when(~F.col("_is_json") & has_repeated_key(raw), F.array(F.lit("repeated key")))
        .when(~F.col("_is_json"), F.array(F.lit("not JSON")))
        .when(~F.col("_is_object"), F.array(F.lit("not an object")))
        .otherwise(_listed(missing + type_faults() + _value_faults(read)))
    )
    return valued.select(*messages.columns, one(errors).alias("errors"))


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = checked.where(F.size("errors") == 0).drop("errors")
    return valid, checked.where(F.size("errors") > 0)


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits typed rows into (valid, quarantine); quarantine adds ``errors``."""
    return _split(df.select("*", one(faults_of_rows(df)).alias("errors")))


def validate_json(messages: DataFrame, raw: str = "raw_json") -> tuple[DataFrame, DataFrame]:
    """Splits raw messages into (valid, quarantine) by the full wire contract."""
    return _split(with_json_faults(messages, raw))
