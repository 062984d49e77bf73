import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from tapewright.llm.queries import tokenizer_path
from tapewright.llm.token_files import Encoder, read_tokens, token_report, write_tokens

pytest.importorskip("public_tokenizers")


def plain(text):
    """Ids by the tokenizer as it is loaded, with nothing of the operator's in between."""
    return np.array(Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_added_tokens_keep_their_id():
    encoder = Encoder(tokenizer_path())
    for text in ("<|endoftext|> hello", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftext", "x <|endoftext|>\n"):
        assert encoder.ids(text) == plain(text), text
    assert np.frombuffer(encoder.ids("<|endoftext|>"), "<u4").tolist() == [50256]


def test_pieces_give_the_ids_of_whole_texts():
    encoder, rng = Encoder(tokenizer_path()), random.Random(1)
    fresh = Tokenizer.from_file(tokenizer_path())
    alphabet = ["a", "The", " ", " ", "  ", "\n", "\t", ",", ".", "'s", "'", "can't", "ß", "é", "ñ", "12", "3", "%%%", " ", "中", "µ", "<|endoftext|>", "\x1c", "ª"]
    for _ in range(5000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(14)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids, repr(text)


def test_files_hold_ids_in_order_and_read_back_selectively(spark, tmp_path):
    texts = {5: "Hello there.\n\nIt's 10 o'clock", 1: None, 9: "", 3: "long words " * 20000, 7: "Ünïcödé 中文", 8: "end <|endoftext|> mark"}
    docs = spark.createDataFrame([Row(doc_id=k, text=v, ids="clash", part="p") for k, v in texts.items()])
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, tokenizer_path(), metadata=("ids",))
    start = 0
    got = {r["doc_id"]: r for r in token_report(spark, path).collect()}
    for k in sorted(texts):
        ids = np.frombuffer(plain(texts[k] or ""), "<u4").tolist() + [0]
        data = np.array(ids, "<u4").tobytes()
        assert tuple(got[k])[1:] == (start, len(ids), zlib.crc32(data))
        start += len(ids)
    row = read_tokens(spark, path, "doc_id = 9", ("doc_id", "ids", "meta_ids")).collect()
    assert [tuple(r) for r in row] == [(9, [0], "clash")]


def test_empty_table_and_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([Row(doc_id=2, text="a b"), Row(doc_id=2, text="a b"), Row(doc_id=None, text="c")])
    write_tokens(docs, str(tmp_path / "a"), tokenizer_path())
    rows = sorted(token_report(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 2, 2] and rows[2]["start"] == rows[0]["n_tokens"] + rows[1]["n_tokens"]
    write_tokens(docs.limit(0), str(tmp_path / "b"), tokenizer_path())
    assert token_report(spark, str(tmp_path / "b")).count() == 0


def test_kept_pieces_are_bounded_in_number_and_length():
    encoder = Encoder(tokenizer_path(), most=3)
    for text in (" ".join(f"word{chr(97 + k)}" for k in range(20)), "ab" * 5000, "again " * 50):
        assert encoder.ids(text) == plain(text)
        assert len(encoder) <= 3 and len(encoder.before) <= 3 and max(map(len, encoder)) <= 64


def test_pipeline_keeps_fewer_pieces(spark, monkeypatch):
    import corpus_pipeline

    given = {}
    monkeypatch.setattr(corpus_pipeline, "write_tokens", lambda docs, path, tokenizer, **options: given.update(options))
    monkeypatch.setattr(corpus_pipeline, "token_report", lambda *_: None)
    corpus_pipeline.token_files(spark, None, "")
    assert given["cached_pieces"] <= 100_000
