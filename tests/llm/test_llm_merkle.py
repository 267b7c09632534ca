import random
import re
from hashlib import sha256
from zlib import crc32

from pyspark.sql import functions as F

from ledgerlark.llm import merkle
from ledgerlark.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, place string, path int, other int, s int"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def up(nodes: list[str]) -> list[str]:
    return [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]


def levels(nodes: list[str]) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        found.append(up(found[-1]))
    return found


def sides(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for now in tree[:-1]:
        a = i - i % 3
        out.append(("".join(now[a:i]), "".join(now[i + 1 : a + 3])))
        i //= 3
    return out


def plainly(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof, folded root, verified of every row, one tree after the other."""
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        by[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(levels([leaf(r) for r in by[name]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, name in enumerate(names):
        for i, r in enumerate(by[name]):
            way = sides(trees[k], i) + sides(top, k)
            now = leaf(r)
            if r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0:
                now = leaf((*r[:4], None if r[4] is None else r[4].replace("\n", "")))
            for left, right in way:
                now = h(left, now, right)
            proof = h(*[x + y for x, y in way])
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def key(row) -> str:
    return repr(tuple(row))


def compared(spark, rows, tmp_path):
    path = f"{tmp_path}/d"
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    found = op11_merkle_manifest(spark, path).collect()
    assert sorted(map(key, found)) == sorted(map(key, plainly(rows)))
    return found


def test_equals_plain_trees(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "hot", "en", 3, f"text\n{i}", "x", 1, 2, 3) for i in rng.sample(range(-3000, 9000), 2400)]
    rows += [(i * 10**15 - 2**62, "far", None, i, "é" * i, "x", 1, 2, 3) for i in range(90)]
    rows += [(7, f"lone{i}", "de", 1, "\n", "x", 1, 2, 3) for i in range(14)]
    rows += [(5, None, None, None, None, "x", 1, 2, 3), (6, None, "fr", 0, "", "x", 1, 2, 3), (9, "", "", 0, "long " * 50_000, "x", 1, 2, 3)]
    # Repeated ids, repeated rows and missing ids.
    rows += [(4, "hot", "en", i, "again", "x", 1, 2, 3) for i in range(70)] + [(4, "hot", "en", 1, "again", "x", 1, 2, 3)] * 5
    rows += [(None, "hot", "en", i % 9, "none", "x", 1, 2, 3) for i in range(40)] + [(None, None, None, None, None, "x", 1, 2, 3)] * 3
    found = compared(spark, rows, tmp_path)
    assert {r.verified for r in found} == {True, False}


def test_lone_and_empty(spark, tmp_path):
    row = (1, "a", "en", 2, "x\ny", "x", 1, 2, 3)
    (found,) = compared(spark, [row], tmp_path / "one")
    assert found.leaf == found.subroot == found.root and found.proof_sha256 == h()
    compared(spark, [row, (2, "b", "en", 2, "x\ny", "x", 1, 2, 3)], tmp_path / "two")
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).count() == 0


def test_places_are_ranks_and_repeat(spark):
    rows = [(i, "s", "en", 1, "t", "x", 1, 2, 3) for i in range(0, 200_000, 97)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = merkle.manifest(df).select("doc_id", "place", "root", F.size("path").alias("n")).collect()
    assert sorted((r.place, r.doc_id) for r in a) == list(enumerate(range(0, 200_000, 97)))
    b = merkle.manifest(df.repartition(11, "text", "doc_id")).select("root").distinct().collect()
    assert [r.root for r in b] == [a[0].root] and re.fullmatch("[0-9a-f]{64}", a[0].root)
