import base64
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from helpers_llm import texts_of

from claimloom.llm import common, token_counts

PATH, EOT = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256


def _flat(docs, block):
    return common.stored(
        token_counts.flatten(docs, PATH, public_tokenizers.PATTERN, EOT, block=block), "flat"
    )


def _expected(docs):
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return Counter((d, len(coder.encode_ordinary(t or ""))) for d, t in texts_of(docs))


def _found(docs, block, span):
    blocks = _flat(docs, block)
    counts = token_counts.count_tokens(blocks, EOT, span=span)
    joined = counts.join(token_counts.named(blocks, span), ["file", "place"])
    assert joined.filter("not closed").count() == 0
    return Counter(map(tuple, joined.select("doc_id", "n_tokens").collect()))


def test_counts_equal_the_tokenizer_for_any_block_and_span(odd, small):
    for block, span in ((7, 2), (64, 3), (1 << 16, 1024)):
        assert _found(odd, block, span) == _expected(odd)
    assert _found(small, 500, 4) == _expected(small)


def test_scan_of_raw_files(spark):
    """Documents across blocks, empty documents, an open end, empty and null blocks."""
    raw = lambda *t: bytearray(np.array(t, "<u2").tobytes())
    rows = [
        (0, 0, raw(5, 6, 7)), (0, 1, raw(8, 9, 1)), (0, 2, raw(9, 9)), (0, 3, raw()), (0, 4, None), (0, 5, raw(2, 3)),
        (1, 0, raw(4, 9)), (2, 0, raw()), (None, 0, raw(9)),
    ]
    blocks = spark.createDataFrame(rows, "file int, block long, tokens binary")
    for span in (1, 2, 100):
        got = token_counts.count_tokens(blocks, 9, span=span).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(
            [(0, 0, 0, 4, True), (0, 1, 5, 1, True), (0, 2, 7, 0, True), (0, 3, 8, 2, False),
             (1, 0, 0, 1, True), (None, 0, 0, 0, True)], key=repr,
        )


def test_empty(empty):
    assert _found(empty, 64, 2) == Counter()
