import random
import re
from hashlib import sha256

import numpy as np
import pytest

from ledgerlark.llm import secret_scan
from ledgerlark.llm.queries import op13_secret_scan

SYLLABLES = "ion ter ment con pre sta lis ver tra der ness ing able por ci ge schaft lich über a e o".split()


def rules(text: str) -> list[tuple[int, int, int]]:
    """The rules, each pattern as it is written down, one character after the other."""
    out = []
    word = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for kind, pattern, least in (
        (0, word + "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
        (1, "(AKIA[A-Z0-9]+)", 20),
        (2, "([0-9a-f]+)", 24),
    ):
        at, compiled = 0, re.compile(pattern)
        while at <= len(text):
            m = compiled.match(text, at)
            if m and len(m[1]) >= least:
                out.append((m.start(), kind, m.end()))
            at = m.end() if m else at + 1
    return sorted(out)


def secret(rng: random.Random) -> str:
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    kind = rng.randrange(3)
    if kind == 0:
        return f"password={hexes(18)}"
    if kind == 1:
        return f'token = "{hexes(40)}"'
    return "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))


def text(rng: random.Random, with_secret: bool) -> str:
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    words = [w.upper() if rng.random() < 0.1 else w for w in words] + [str(rng.randrange(10**15, 10**16)), "mail2.example.com"]
    if with_secret:
        words.append(secret(rng))
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, i % 2 == 0)) for i in range(600)]
    return secret_scan.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_rules_equal_patterns():
    rng = random.Random(1)
    bits = ["password", "PassWD", "ApiKey", "api_key", "token", "TOKENs", "secret", "'", '"', " ", "  ", ":", "=", "==", "AKIA", "AKIAZ9", "abcdef",
            "0123456789", "a1b2c3d4e5f6a7b8c9d0e1f2", "xyz", "é", "ſecret", "\n", "Q" * 17, ".", "-"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert secret_scan.findings(t) == rules(t), t


def test_gradient():
    rng = np.random.default_rng(2)
    net = secret_scan.fresh()
    net.output[:] = rng.normal(size=len(net.output))
    examples = [("ab= ", "q9é" * 5, "x"), ("", "AKIA7", ""), ("zz", "words", " and")]
    label = np.array([1.0, 1.0, 0.0])
    _, found = secret_scan.gradients(net, examples, label)
    for weights, gradient in zip((net.places, net.filters, net.bias, net.output), found):
        for _ in range(12):
            k = tuple(rng.integers(0, n) for n in weights.shape)
            if weights is net.places and k[0] == secret_scan.GAP:
                continue
            kept, losses = weights[k], []
            for move in (1e-6, -1e-6):
                weights[k] = kept + move
                losses.append(secret_scan.gradients(net, examples, label)[0])
            weights[k] = kept
            assert gradient[k] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-5)


def test_long_candidates_are_read_whole(monkeypatch):
    rng = np.random.default_rng(2)
    net = secret_scan.fresh()
    net.output[:] = rng.normal(size=len(net.output))
    examples = [("a=", "xY3/" * 300, "..."), ("", "b" * 77, ""), ("q", "", "r")]
    whole = secret_scan.outputs(net, examples)
    monkeypatch.setattr(secret_scan, "PIECE", 13)
    assert np.allclose(secret_scan.outputs(net, examples), whole)
    changed = secret_scan.outputs(net, [("a=", "xY3/" * 299 + "ZZZZ", "..."), *examples[1:]])
    assert changed[0] != pytest.approx(whole[0]) and np.allclose(changed[1:], whole[1:])


def test_held_out(learned):
    rng = random.Random(8)
    hits = wrong = 0
    for _ in range(300):
        for kind in (True, False):
            value = secret(rng) if kind else text(rng, False)
            # A strange key word and a strange surrounding: no rule of an assignment applies.
            t = value.replace("password", "kennwort").replace("token", "schlüssel")
            own = secret_scan.candidates(t)
            p = secret_scan.chances(learned, secret_scan.outputs(learned, [secret_scan._surrounded(t, a, b) for a, b, _ in own]))
            caught = sum(x >= learned.thresholds[form] for x, (_, _, form) in zip(p, own))
            hits, wrong = hits + (kind and caught > 0), wrong + (not kind) * caught
    assert hits >= 0.95 * 300 and wrong <= 3


def test_thresholds_keep_recall():
    net = secret_scan.fresh()
    z = np.concatenate([np.linspace(-1, 9, 200), np.linspace(-9, 1, 300)])
    label, form = np.repeat([1.0, 0.0], [200, 300]), np.arange(500) % 2
    secret_scan.calibrate(net, z, label, form, recall=0.9)
    p = secret_scan.chances(net, z)
    for f in (0, 1):
        own = p[(label > 0) & (form == f)]
        assert 0.9 <= np.mean(own >= net.thresholds[f]) <= 0.92
    # Calibrated: of the ones given a chance near x, a share near x is positive.
    assert np.mean(p) == pytest.approx(np.mean(label), abs=0.02)


def test_every_value_is_learned_and_judged(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "GROUP", 300)
    monkeypatch.setattr(secret_scan, "FEW", 40)
    monkeypatch.setattr(secret_scan, "STEPS", 5)
    rng = random.Random(7)
    texts = [text(rng, i % 5 == 0) for i in range(150)] + [None, ""]
    wanted = {}
    for t in texts:
        for a, b, _ in secret_scan.candidates(t or ""):
            found = any(x < b and a < y for x, _, y in rules(t))
            wanted[t[a:b]] = max(wanted.get(t[a:b], 0), int(found))
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    examples = secret_scan._examples(df, "text").cache()
    rows = examples.collect()
    assert len(rows) == len(wanted) and {r.value: r.label for r in rows} == wanted
    counts = {(r.label, r.half): r["count"] for r in examples.groupBy("label", "half").count().collect()}
    groups = secret_scan._dealt(examples, counts, 3)
    held = {net: [r for r in groups.collect() if r.net == net] for net in range(3)}
    assert len(held[0]) > 2 and all(len({*r.label}) == 2 for own in held.values() for r in own)
    for net, own in held.items():
        assert {v for r in own for v in r.value} == {r.value for r in rows if not net or r.half == 2 - net}
    nets = secret_scan._turned(groups, [secret_scan.fresh() for _ in range(3)], 0)
    again = secret_scan._turned(groups.repartition(1), [secret_scan.fresh() for _ in range(3)], 0)
    assert all((a == b).all() for x, y in zip(nets, again) for a, b in zip(secret_scan._weights(x), secret_scan._weights(y)))
    z, label, _, count = secret_scan._judged(examples, nets)
    assert count.sum() == len(wanted) and count[label > 0].sum() == sum(wanted.values())
    single = secret_scan.outputs(nets[1 + rows[0].half], [(rows[0].before, rows[0].value, rows[0].after)])[0]
    assert np.floor(single * secret_scan.GRID) / secret_scan.GRID in z


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, text(rng, i % 3 == 0), 1, "x") for i in range(500)]
    rows += [(700, None, 1, "x"), (701, "", 1, "x"), (None, "é token=abcdef12 AKIA" + "Q7" * 9, 1, "x"), rows[0], (702, "a1" * 40_000, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int, _text string")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_secret_scan(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    wanted = []
    for doc_id, t, _, _ in rows:
        base = rules(t or "")
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        wanted.append((doc_id, *[sum(k == n for _, k, _ in base) for n in range(3)], sha256(listed.encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r)[:5] for r in out))) == sorted(map(repr, wanted))
    for r in out:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert [kinds.count(k) for k in ("assign", "access", "hex")] == [r.n_assign, r.n_access, r.n_hex]
    assert secret_scan.fit(df.filter("doc_id = 701")) is None
    none = secret_scan.find(df, None)
    assert none.columns == ["doc_id", "text", "_text", "spans"] and none.filter("doc_id is null").head().spans[0].kind == "assign"
    assert secret_scan.find(df.limit(0), None).count() == 0
