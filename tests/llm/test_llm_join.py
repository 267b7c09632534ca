import random
import re

from pyspark.sql import functions as F

from ledgerlark.llm import similarity_join
from ledgerlark.llm.components import components
from ledgerlark.llm.similarity_join import link

SCHEMA = "doc_id long, text string, n long, c int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs: list[tuple], width: int, percent: int) -> dict:
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
        grams = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets[i] = sets.get(i, grams)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def documents(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    common = ["the", "of", "And", "to"]
    words = [f"w{i}" for i in range(300)] + common * 40
    docs = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([5, 12, 40, 120, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    # A chain: each text is near the next one, the ends are not near each other.
    chain = [f"x{i}" for i in range(120)]
    for step in range(12):
        docs.append(" ".join(chain[step * 3 : step * 3 + 80]))
    docs += ["", None, " \t\n", "one", "ONE", "one two", "w1 w2 w3", "W1\nw2\tw3", "é É", "é é"]
    rng.shuffle(docs)
    return list(enumerate(docs, 100))


def test_same_as_all_pairs(spark):
    for seed, width, percent, frequent in ((1, 3, 90, 64), (2, 3, 90, 2), (3, 5, 80, 3), (4, 3, 100, 64)):
        docs = documents(seed)
        df = spark.createDataFrame([(*d, 5, 6) for d in docs], SCHEMA)
        got = link(df, width, percent, frequent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, width, percent)
        assert len(got) == len(docs)


def test_hot_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"h{i}" for i in range(60)]
    docs = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(60)] = f"e{i}"
        docs.append((i, " ".join(copy)))
    docs += [(1000 + i, " ".join(base[:30] + [f"o{i}x{j}" for j in range(30)])) for i in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(spark.createDataFrame([(*d, 0, 0) for d in docs], SCHEMA), 3, 90, 4).collect()}
    assert got == brute(docs, 3, 90)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"t{i}" for i in range(60))
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "q r s"), (None, None), (7, "A b c d"), (None, "d e f g"), (5, "d E f g")]
    # One id, two texts: each is compared. Copies among rows without an id, near ones too.
    rows += [(9, long), (9, "u v w x"), (8, "u v W x"), (None, long + " end"), (None, "solo " + long), (None, long)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in link(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()]
    wanted = [(1, 2, 1), (1, 2, 1), (7, 2, 1), (None, 1, None), (None, 0, None), (None, 2, 5), (5, 2, 5)]
    wanted += [(9, 58, 9), (9, 2, 8), (8, 2, 8), (None, 59, 9), (None, 59, 9), (None, 58, 9)]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert link(spark.createDataFrame([], SCHEMA)).count() == 0
    nameless = link(spark.createDataFrame([(None, long, 0, 0), (None, long + " end", 0, 0), (None, "x y z", 0, 0)], SCHEMA)).collect()
    assert all(r.component_id is None for r in nameless) and len({r.component for r in nameless}) == 2


def test_shared_boilerplate_makes_few_candidates(spark):
    rng = random.Random(6)
    plate = " ".join(f"legal{i}" for i in range(40))
    docs = [(i, plate + " " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(150))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    profiles = similarity_join._profiles(df.select("doc_id", "text", *similarity_join.row_keys(F.col("doc_id"), F.col("text"))), 3, 90)
    held = similarity_join._entries(profiles, 90).groupBy("key").count()
    # By hash alone some key holds all 600; what all share stands last, behind a prefix's end.
    assert held.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).head()[0] < 600
    assert link(df).filter("doc_id <> component_id").count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.v: r.c for r in components(links.union(spark.createDataFrame([(90, 80), (80, 95)], "a long, b long"))).collect()}
    assert got == {**{i: 0 for i in range(41)}, 80: 80, 90: 80, 95: 80}


def test_groups_of_near_copies_are_not_paired_with_themselves(spark, monkeypatch):
    """Copies with few changes are alike, those with many are not, whichever class is the first hub."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    docs, sets = [], []
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(10, 290), 1 + i % 6):
            words[at] = f"n{rng.random()}"
        docs.append((i, " ".join(words)))
        sets.append({tuple(words[k : k + 5]) for k in range(296)})
    parent = list(range(240))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(240):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    made, candidates = [], similarity_join._candidates
    monkeypatch.setattr(similarity_join, "_candidates", lambda *a: made.append(candidates(*a).count()) or candidates(*a))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for rounds in (similarity_join.MORE, 0):
        monkeypatch.setattr(similarity_join, "MORE", rounds)
        got = {r.doc_id: r.component_id for r in similarity_join.link(df, 5, 80).collect()}
        assert got == {i: top(i) for i in range(240)}
    assert made[1] > 240 and made[0] < made[1] / 3, made


def test_plans_stay_small_and_rounds_without_hubs_are_left_out(spark, monkeypatch):
    """The driver plans every table; a large plan or a round on empty tables is its memory."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    rows = [(2 * i + k, text + " end" * k, 0, 0) for i, text in enumerate(base) for k in (0, 1)]
    written, kept = [], similarity_join.stored

    def watched(df, purpose):
        written.append((purpose, len(df._jdf.queryExecution().executedPlan().toString())))
        return kept(df, purpose)

    monkeypatch.setattr(similarity_join, "stored", watched)
    found = {r.doc_id: r.component_id for r in link(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {2 * i + k: 2 * i for i in range(20) for k in (0, 1)}
    # Pairs of the first hub and of what is left; no round of drawn hubs between them.
    assert [p for p, _ in written].count("join-pairs") == 2
    assert max(size for _, size in written) < 60_000


def test_elements_of_few_prefixes_are_done_after_the_first_pairs(spark, monkeypatch):
    """What unrelated texts share by chance grows with the table; none of it travels on, and no link is lost."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(20)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(300)]
    for i in range(0, 60, 2):
        copy = docs[i][1].split(" ")
        copy[rng.randrange(60)] = rng.choice(words)
        docs.append((300 + i, " ".join(copy)))
    written, kept = [], similarity_join.stored

    def watched(df, purpose):
        found = kept(df, purpose)
        written.append((purpose, found.count()))
        return found

    monkeypatch.setattr(similarity_join, "stored", watched)
    got = link(spark.createDataFrame([(*d, 0, 0) for d in docs], SCHEMA), 3, 90, 4).collect()
    wanted = brute(docs, 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert sum(i != c for i, (_, c) in wanted.items()) > 10
    assert [n for purpose, n in written if purpose == "join-open"][0] < 100, written
