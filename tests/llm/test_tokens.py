import public_tokenizers
import pytest
from llm_helpers import documents, edge_rows, ordered

from weekwise.llm import token_scan

TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@pytest.mark.parametrize("block_tokens", [1 << 19, 50, 1])
def test_equals_the_library(spark, block_tokens):
    encoding = token_scan._load(*TOKENIZER)
    rows = [x for x in edge_rows() if block_tokens > 1000 or len(x[1] or "") < 200]
    rows += [(-5, "hello"), (2**63 - 1, None), (-2**63, "x"), (7, "a"), (7, "a")]
    got = token_scan.document_token_counts(documents(spark, rows), TOKENIZER, block_tokens).collect()
    assert ordered(got) == ordered((i, len(encoding.encode_ordinary(t or ""))) for i, t in rows)


def test_empty(spark):
    assert token_scan.document_token_counts(documents(spark, []), TOKENIZER).collect() == []
