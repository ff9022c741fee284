import random

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import documents, edge_rows, importable
from tokenizers import Tokenizer

from weekwise.llm import trie_bpe
from weekwise.llm.queries import word_bpe_file

POOL = "abcdefgtheinganrsABCΣσςİßÅé中文語🙂👍🏽 \t\n\x1c\x85\xa0'’'s'll're123٣½²0_-%$#@!&;:<|>́̀ẞǅ\x00​‍ ةไทย"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(word_bpe_file())
    t.no_truncation()
    t.no_padding()
    return t


def test_equals_the_library_on_odd_texts(library):
    r = random.Random(1)
    texts = ["".join(r.choice(POOL) for _ in range(r.randint(0, 60))) for _ in range(5000)]
    texts += ["<|endoftext|>hello<|startoftext|> WORLD<|endoftext|", "a" * 5000, "aaaa aaaaa aaa", "ab" * 3000,
              "!!!!!!????......", "", "the " * trie_bpe.SEGMENT]
    pieces = [t.replace("</w>", "") for t in library.get_vocab()]
    texts += ["".join(r.choice(pieces) for _ in range(4)) for _ in range(5000)]
    codec = trie_bpe.Codec(trie_bpe.BpeTable(word_bpe_file()))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected
    assert [codec.decode(x) for x in got] == library.decode_batch(expected, skip_special_tokens=False)


def test_few_kept_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "KEPT_WORDS", 3)
    codec = trie_bpe.Codec(trie_bpe.BpeTable(word_bpe_file()))
    for text in ["one two three four", "three five", "one one two"]:
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, library):
    rows = edge_rows()
    found = trie_bpe.decode_documents(
        trie_bpe.encode_documents(documents(spark, rows), word_bpe_file()), word_bpe_file()).collect()
    assert len(found) == len(rows)
    expected = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in found) == expected
    assert all(r.text == library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) for r in found)


def test_an_idle_worker_keeps_no_table(spark):
    """The dictionaries of a table are many; what a worker still holds after its tasks are none of them."""
    def held(batches):
        import gc
        for batch in batches:
            gc.collect()
            found = sum(isinstance(x, (trie_bpe.BpeTable, trie_bpe.TrieEncoder)) for x in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"n": pa.array([found] * batch.num_rows)})

    importable(spark)
    rows = [(i, f"some words {i}") for i in range(200)]
    assert trie_bpe.encode_and_decode(documents(spark, rows).repartition(4), word_bpe_file()).count() == 200
    assert trie_bpe.encode_documents(documents(spark, rows).repartition(4), word_bpe_file()).count() == 200
    left = spark.range(0, 400, 1, 8).mapInArrow(held, "n long").collect()
    assert {r.n for r in left} == {0}


def test_empty_table(spark):
    assert trie_bpe.round_trip(documents(importable(spark), []), word_bpe_file()).collect() == []
