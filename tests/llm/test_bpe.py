"""BPE: equal to the tokenizers library, and an exact round trip."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from fanwrite.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_equal_to_the_library(spark, sf_small):
    library, own = Tokenizer.from_file(PATH), bpe.ByteBPE(open(PATH, encoding="utf-8").read())
    rnd = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "日", "🙂", "́", "²", "Ⅷ", "٣", "_", "'s", "'", "<|endoftext|>", "<|endof", "\u200b", "ก", "1"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += [r[0] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    texts += ["x" * 5000, " " * 3000, "ab" * 4000]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.encode(text)
        assert ids == want.ids, text[:100]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_incomplete_bytes_decode_as_the_library_does():
    library, own = Tokenizer.from_file(PATH), bpe.ByteBPE(open(PATH, encoding="utf-8").read())
    ids = own.encode("é日🙂")
    for part in (ids[:1], ids[1:], ids[:2], ids[-1:], ids[::-1]):
        assert own.decode(part) == library.decode(part, skip_special_tokens=False)


def test_edge_rows(make_docs, no_docs):
    long = "lorem ipsum é " * 60_000
    docs = make_docs([(1, None, None), (2, "", "en"), (3, long, "en"), (None, "a b", "en"), (4, "a b", "en"), (4, "a b", "en")])
    coded = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert set(docs.columns) <= set(coded.columns)
    got = {(r["doc_id"], r["text"]): (len(r["ids"]), r["decoded"]) for r in coded.collect()}
    assert got[1, None] == (0, "") and got[2, ""] == (0, "") and got[3, long][1] == long and got[4, "a b"] == got[None, "a b"] == (2, "a b")
    assert bpe.digests(docs, PATH).count() == 6 and bpe.digests(no_docs, PATH).count() == 0


def test_a_full_memory_changes_nothing(monkeypatch):
    spec = open(PATH, encoding="utf-8").read()
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 5))) for _ in range(50)) for _ in range(200)]
    plain = bpe.ByteBPE(spec)
    want = [plain.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 40)
    own = bpe.loaded(spec)
    assert [own.encode(t) for t in texts] == want and len(own.known) <= 40 and len(own.before) == 40
    assert bpe.loaded(open(PATH, encoding="utf-8").read()) is own
