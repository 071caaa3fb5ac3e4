"""Token files against the tokenizer on whole texts."""

import random
import zlib

import numpy as np
import pytest

from regiostar.llm import token_files
from regiostar.llm.queries import tokenizer_file

PIECES = ["a", "the", "B", " ", " ", "\n", "\t", "\r", ".", ",", "$$$", "'s", "'", "_", "1", "²", "ª", "é", "́", " ", "中", "٣", "β", "<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    return token_files.UnitEncoder(tokenizer_file(), "<u4").opened()


def whole(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_units_equal_whole_texts(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 200)  # generations end during the test
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choices(PIECES, k=draw.randint(0, 12)))
        assert encoder(text) == whole(encoder, text), text


def test_rows_without_id_are_dealt_over_parts(spark, encoder, tmp_path):
    texts = [f"{i * 7919 % 1000:03d} words of no known document" for i in range(1000)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(4, None)], "doc_id long, text string")
    index = token_files.write_tokens(docs, tokenizer_file(), str(tmp_path / "set"), parts=4)
    assert index.count() > 1
    assert index.agg({"docs": "max"}).first()[0] < 600
    rows = token_files.read_tokens(spark, index, str(tmp_path / "set"), "<u2").orderBy("start").collect()
    end = np.array([token_files.END_ID], "<u4").tobytes()
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(whole(encoder, t) + end) for t in [*sorted(texts), ""]]
    assert [r.doc_id for r in rows] == [None] * 1000 + [4]
    assert [r.start for r in rows[1:]] == list(np.cumsum([r.n_tokens for r in rows])[:-1])


def test_parts_follow_the_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x" * 1000), (2, None)], "doc_id long, text string")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert token_files._parts(docs) == least == token_files._parts(docs.limit(0))
    monkeypatch.setattr(token_files, "PART_BYTES", 10)
    assert token_files._parts(docs) == 100
