import random

import pytest
from tokenizers import Tokenizer

from lakemart.llm.queries import tokenizer_path
from lakemart.llm.token_counts import Counter, op7_token_counts

from .conftest import documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_equals_the_library_on_strange_texts(library):
    rng = random.Random(3)
    alphabet = "aAbeézÉΣςİß ıK   \u0085\x1c\x1f​'’12²½Ⅷ日本!?_-\n\ţ́<|>ſstrellmvd"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(0x3000, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(20)) for _ in range(4000)]
    texts += ["a<|endoftext|>b<|startoftext|>", "<|endoftext|>" * 3, "aaaaaaa aaaa!!!!!!!!!!!", "x" * 5000, "<|endoftext|", "I'll he's 'sx 'S", ""]
    assert Counter(tokenizer_path()).count([t.encode() for t in texts]) == lengths(library, texts)


def test_equals_the_library_on_documents(spark, library, sf001):
    docs = documents(spark, sf001)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = dict(zip(texts, lengths(library, list(texts.values()))))
    for r in op7_token_counts(docs, tokenizer_path()).collect():
        assert r["n_tokens"] == want[r["doc_id"]]
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())
        assert r["over_limit"] == (r["n_tokens"] > 2048)


def test_odd_rows_and_empty_table(spark, library, odd_docs, odd_rows, no_docs):
    want = lengths(library, [r[1] or "" for r in odd_rows])
    found = op7_token_counts(odd_docs, tokenizer_path()).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in found] == [(r[0], n) for r, n in zip(odd_rows, want)]
    assert op7_token_counts(no_docs, tokenizer_path()).count() == 0
