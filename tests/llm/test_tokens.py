import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import queries, tokens

PATH = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")
BPE = tokens.ByteBpe(tokens.read_ranks(PATH)) if os.path.exists(PATH) else None


def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_equals_library_and_decodes(text):
    ids = BPE.encode(text)
    assert ids == library().encode_ordinary(text)
    assert BPE.decode(ids) == text


def test_long_and_odd_texts():
    rng = random.Random(1)
    for text in ["a" * 20_000, "组合" * 5_000, " " * 3_000 + "x", "<|endoftext|>", "\r\n\t 1234567890", "".join(chr(rng.randrange(32, 0xD7FF)) for _ in range(3_000))]:
        assert BPE.encode(text) == library().encode_ordinary(text)
        assert BPE.decode(BPE.encode(text)) == text


def test_documents_null_empty_repeated_clashing(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "the bars", "z"), (3, "the bars", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r["doc_id"], list(r["ids"])) for r in tokens.encode_documents(df, PATH).collect())
    want = BPE.encode("the bars")
    assert got == [(1, []), (2, []), (3, want), (3, want)]
    assert tokens.encode_documents(df.limit(0), PATH).collect() == []
    back = sorted(map(tuple, tokens.decode_documents(tokens.encode_documents(df, PATH), PATH).collect()))
    assert back == [(1, ""), (2, ""), (3, "the bars"), (3, "the bars")]
    nothing = spark.createDataFrame([(1, None), (2, [255])], "doc_id long, ids array<int>")
    assert [r["text"] for r in tokens.decode_documents(nothing, PATH).orderBy("doc_id").collect()] == ["", BPE.decode([255])]


def test_every_document_round_trips(spark, sf):
    from barloom.llm.queries import p6_ids

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r["ids"] for r in p6_ids(spark, sf).collect()}
    assert got.keys() == texts.keys()
    assert all(BPE.decode(ids) == (texts[d] or "") for d, ids in got.items())
