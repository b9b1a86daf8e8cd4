"""Token alignment against a plain version, for tables of pairs that travel, in part or not at all."""

import numpy as np
import pytest
import sentencepiece
from brute import alignments, sha
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from crisis_posts.llm import alignment

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "\n\n  x", "Hello world, <|endoftext|> ok </s>", "naïve café", "日本語 テスト", "🙂🙂 x",
    "a▁b", "x" * 2_500, "Hello world", "Hello world", "\x00 a", "ﬁ Ａ é", "tab\tand\r\nline", "don't we'll",
    "1234567890 12 3.5", " " * 1_500 + "end", "Hello worlds and words",
]


@pytest.fixture(scope="module")
def expected():
    tokenizers = alignment._tokenizers(A, B)
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return alignments(TEXTS, a, tokenizers.a_bytes, b, tokenizers.b_bytes)


def documents(spark, texts=TEXTS):
    rows = [(i, text, "k", 7) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, keys string, bucket int")


@pytest.mark.parametrize("most_pairs", [1_000_000, 10, 0])
def test_equals_plain_version(spark, expected, most_pairs):
    found = alignment.align_documents(documents(spark), A, B, most_pairs=most_pairs).collect()
    assert {row.doc_id: tuple(row)[1:] for row in found} == dict(enumerate(expected))
    assert sum(row.n_a == 0 for row in found) == 3


def test_ids_equal_those_of_the_library():
    tokenizers = alignment._tokenizers(A, B)
    assert tokenizers.fast is not None
    by_ranks = [text for text in filter(None, TEXTS) if tokenizers.by_ranks(text.encode())]
    for text in by_ranks:
        assert tokenizers.encode_a(text, True) == tokenizers.encode_a(text, False)
    assert len(by_ranks) == 11


def test_repeated_rows_null_ids_and_invalid_texts(spark):
    docs = spark.sql(
        "select cast(id as long) doc_id, text from values (1, 'one two'), (1, 'one two'), (null, 'one') t(id, text)"
        " union all select 4, cast(unhex('6fff') as string)"
    )
    rows = alignment.align_documents(docs, A, B, digests=True).collect()
    by_id = {row.doc_id: row for row in rows}
    assert len(rows) == 4 and by_id[4].n_links == 0 and by_id[4].groups == ""
    assert by_id[1].groups == sha(alignment.align_documents(docs, A, B).where("doc_id = 1").first().groups)
    # " one" is linked in three rows, " two" in two.
    assert by_id[None].count_sum == 3 and by_id[1].count_sum == 5


def test_empty_table(spark):
    for most_pairs in (1_000_000, 0):
        assert alignment.align_documents(documents(spark).where("false"), A, B, most_pairs=most_pairs).count() == 0


def test_pair_counts_are_those_of_the_documents(spark):
    docs = documents(spark, ["one two", "one", "one one"])
    table = alignment.pair_table(alignment.encode_both(docs, A, B), A, B)
    counts = {(r.a, r.b): (r.docs, r.best) for r in alignment.pair_counts(table, B).collect()}
    assert sorted(counts.values()) == [(1, True), (3, True)]


def test_hash_functions_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 50_257 * 32_000, 50_000))
    buckets = alignment.bucket_of(keys, 32_000)
    rows = []
    for bucket in range(alignment._BUCKETS):
        sizes, bits, by_slot = alignment.perfect_hash(own := keys[buckets == bucket])
        assert sorted(by_slot) == sorted(own)
        assert len(bits) * 64 <= 6 * len(own) + 64 * 12
        rows.append((bucket, sizes.tobytes(), bits.tobytes(), by_slot.tobytes()))
    functions = alignment.PerfectHashes(rows, 32_000)
    assert sorted(functions.slots(keys)) == list(range(len(keys)))
    assert (functions.keys[functions.slots(keys)] == keys).all()
    others = np.setdiff1d(rng.integers(0, 50_257 * 32_000, 50_000), keys)
    assert (functions.slots(others) == -1).all()


def test_op13(spark):
    from test_queries import result, table

    found = result(spark, "op13_token_alignment")
    texts = table("documents", "doc_id, text")
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    assert found.keys() == {doc for doc, _ in texts}
    for doc, text in texts:
        row = found[doc]
        assert row.n_a == len(a.encode(" " + text, add_special_tokens=False).ids)
        assert row.n_b == len(b.encode(text))
        assert row.n_links == row.n_a + row.n_b - row.n_groups and 0 < row.n_best <= row.n_links
        assert row.count_sum >= row.n_links and len(row.groups_sha256) == 64
