import random
import uuid
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from ledgerlark.llm import token_files
from ledgerlark.llm.queries import word_tokenizer

SCHEMA = "doc_id long, text string, start int, frames string"
TEXTS = [
    None, "", " ", "Hello World", "it's  the\n\nEnd\t\x0b x y", "don't <|endoftext|> a<|startoftext|>b",
    "é ́x ﬁ ẞ ΣΣ İi", "no.space" * 400, "\x1c\x85​ z", "漢字 mixed 12345 ½",
]


@pytest.fixture(scope="module")
def path(spark):
    from ledgerlark.session import fresh_dir

    return fresh_dir(spark, f"tokens-{uuid.uuid4().hex}")


def test_round_trip(spark, path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 7)
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    rng = random.Random(1)
    pieces = ["the", "of", "'s", "\n", " ", "\t", " ", "　", "É", "é", "!?", "99", "<|endoftext|>", "naïve", "\U0001f600"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(60)) for _ in range(40)]
    rows = [(3 * i, t, 1, "clash") for i, t in enumerate(texts)] + [(0, None, 1, ""), (None, "nobody's", 1, "")]
    manifest = token_files.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, word_tokenizer())
    assert manifest.count() > 3
    whole = Tokenizer.from_file(word_tokenizer())
    wanted, start = [], 0
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        wanted.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = [tuple(r) for r in token_files.read(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == wanted
    some = token_files.read(spark, path, [9, 30, 999]).collect()
    assert sorted((r.doc_id, r.start) for r in some) == [(r[0], r[1]) for r in wanted if r[0] in (9, 30)]


def test_files_are_plain_zstandard_and_checked(spark, path):
    name = sorted((r["range"], r.file) for r in spark.read.parquet(f"{path}/manifest").collect())[-1][1]
    file = f"{path}/files/{name}".removeprefix("file://")
    one = token_files.TokenFile(file)
    everything = b"".join(one.ids(i).tobytes() for i in range(len(one.places)))
    with open(file, "rb") as raw:
        data = raw.read()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == everything
    assert one.find(int(one.places["doc_id"][0])) == [0]
    broken = bytearray(data)
    table = len(data) - 9 - len(one.entries) * token_files.ENTRY.itemsize
    broken[table + 8] ^= 1
    with open(file + ".broken", "wb") as out:
        out.write(broken)
    with pytest.raises(ValueError, match="checksum"):
        token_files.TokenFile(file + ".broken").ids(0)


def test_empty_table(spark):
    from ledgerlark.session import fresh_dir

    folder = fresh_dir(spark, "tokens-empty")
    token_files.write(spark.createDataFrame([], SCHEMA), folder, word_tokenizer())
    assert token_files.read(spark, folder).count() == 0


def test_words_stand_for_texts_only_under_known_rules():
    """Ids of whole texts, for a tokenizer whose words can be encoded apart and for one whose cannot."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(12)
    letters = "abcXYZ éÉßñÅǅ İıſ ŉ  ' .,!?-_ 0123 \t\n\x0b\u0301\u00a0漢字 αΣς ẞɏɎ µªº <|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["<|endoftext|> x<|startoftext|>y", "don't WE'LL it's", "", " "]
    for name, whole in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        ids, tokenizer = token_files.WordIds(path, "<u4"), Tokenizer.from_file(path)
        assert ids._whole is whole
        for text, found in zip(texts, ids.texts(texts)):
            assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


def test_few_words_are_remembered(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    ids = token_files.WordIds(public_tokenizers.path("word_bpe_49k.json"), "<u2")
    texts = [f"one{i} two{i} three" for i in range(50)]
    again = token_files.WordIds(public_tokenizers.path("word_bpe_49k.json"), "<u2")
    assert ids.texts(texts) == [again.texts([t])[0] for t in texts] and len(ids) <= 13
