"""The registered queries over a whole table, against the plain versions."""

import os
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from brute import (
    chats, components, contamination, edited_texts, passages, personal, secrets, sha,
)
from public_tokenizers import path as tokenizer_path

from __spark_entry__ import queries
from crisis_posts.llm import language, pii

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


def table(name, columns):
    return duckdb.sql(f"select {columns} from '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents():
    return table("documents", "doc_id, text")


def result(spark, name):
    rows = queries()[name](spark, SF_DIR).collect()
    out = {row[0]: row for row in rows}
    assert len(out) == len(rows)
    return out


def digest(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def test_op1(spark, documents):
    found = result(spark, "op1_ngram_jaccard_join")
    expected = components(documents)
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == expected
    assert any(component < doc for doc, (_, component) in expected.items())


def test_op2(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    found = result(spark, "op2_token_counts")
    for doc, text in documents:
        n = len(library.encode(text, add_special_tokens=False).ids)
        row = found[doc]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 2048)
        assert (row.fit_chars is not None) == (n > 2048)


def test_op3(spark, documents):
    found = result(spark, "op3_pii")
    assert len(found) == len(documents)
    for doc, text in documents:
        spans = personal(text)
        row = found[doc]
        assert row.base_sha256 == sha(digest(spans))
        counts = [sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone")]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert set(digest(spans).split(",")) <= set(row.spans.split(","))
        assert row.n_added == len([s for s in row.spans.split(",") if s]) - len(spans)


def test_op4(spark, documents):
    found = result(spark, "op4_substring_dedup")
    expected = passages(documents)
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in found.items()} == {
        d: (n, gone, sha(kept)) for d, (n, gone, kept) in expected.items()
    }
    assert sum(gone for _, gone, _ in expected.values()) > 0


def test_op5(spark, documents):
    found = result(spark, "op5_fingerprints")
    texts = dict(documents)
    edited = edited_texts(documents)
    assert found.keys() == texts.keys()
    by_text = {}
    for doc, text in documents:
        row = found[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == sha(edited[doc])
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
    long = [found[d] for d, t in texts.items() if len(t) > 1000]
    assert sum(row.near_edited for row in long) / len(long) > 0.4
    assert sum(row.near_next for row in long) / len(long) < 0.1


def test_op6(spark):
    found = result(spark, "op6_language_id")
    rows = table("documents", "doc_id, lang")
    assert len(found) == len(rows)
    right = total = 0
    for doc, lang in rows:
        held = zlib.crc32(str(doc).encode()) % 4 == 2
        assert found[doc].held_out == held
        assert found[doc].lang_pred in ("en", "de", "fr", "es")
        assert 0 <= found[doc].score <= 1
        right, total = right + (held and found[doc].lang_pred == lang), total + held
    assert right / total > 0.95


def test_op7(spark, documents):
    found = result(spark, "op7_secret_scan")
    assert len(found) == len(documents)
    for doc, text in documents:
        spans = secrets(text)
        row = found[doc]
        counts = [sum(s[0] == kind for s in spans) for kind in ("assign", "access", "hex")]
        assert [row.n_assign, row.n_access, row.n_hex] == counts
        assert row.base_sha256 == sha(digest(spans))
        assert set(digest(spans).split(",")) <= set(row.spans.split(","))


def test_op8(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    found = result(spark, "op8_sentencepiece")
    for doc, text in documents:
        ids = library.encode(text)
        row = found[doc]
        assert (row.n_pieces, row.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert row.round_trip and row.n_chars == len(text)


def test_op9(spark, documents):
    found = result(spark, "op9_decontamination")
    expected = contamination(documents, table("benchmark", "item_id, text"))
    for doc, (n_words, n_hit, items) in expected.items():
        row = found[doc]
        assert (row.n_words, row.n_hit, row.n_items) == (n_words, n_hit, len(items))
        assert row.items_sha256 == sha(",".join(items))
        assert row.contaminated == (n_hit > 0)
    assert any(hit for _, hit, _ in expected.values())


def test_op10(spark):
    conversations = table("conversations", "conv_id, turn, role, text")
    planted = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    expected = chats(conversations + planted)
    found = result(spark, "op10_chat_format")
    assert {
        c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in found.items()
    } == expected
    length = {c: r.formatted_chars for c, r in found.items()}
    assert all(length[c] > sum(len(t or "") for k, _, _, t in conversations if k == c) for c in
               random.Random(1).sample(sorted(length), 20) if c >= 0)


def test_texts_of_random_letters_are_rejected(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    dictionaries, margin = language.learn(docs.where(~language.held_out()))
    noise = [
        (i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(400)))
        for i in range(50)
    ]
    noise = spark.createDataFrame(noise, "doc_id long, text string")
    assert language.identify_language(noise, dictionaries).where("rejected").count() < 25
    assert language.identify_language(noise, dictionaries, margin).where("rejected").count() == 50
    clean = language.identify_language(docs.where("lang is not null"), dictionaries, margin)
    assert clean.where("rejected").count() < 0.05 * clean.count()


def masked_texts(texts):
    """Texts by doc_id with spans replaced: the shapes' and those of patterns, scored round by round."""
    spans = {doc: personal(text) for doc, text in texts.items()}
    found = [(doc, *c) for doc, text in texts.items() for c in pii.candidates(text, spans[doc])]
    seeds = defaultdict(lambda: defaultdict(str))
    for *_, instance, kind, patterns in found:
        for pattern in patterns:
            seeds[pattern][instance] = max(seeds[pattern][instance], kind or "")
    known = {(i, kind) for own in seeds.values() for i, kind in own.items() if kind}
    belief, accepted = dict.fromkeys(known, 1.0), {}
    for _ in range(60):
        accepted = {}
        for pattern, own in seeds.items():
            for kind in pii.KINDS:
                support = sum(belief.get((i, kind), 0) for i in own)
                if support >= pii.MIN_SEEDS and support / len(own) >= pii.MIN_CONFIDENCE:
                    accepted[pattern, kind] = support / len(own)
        doubt = defaultdict(lambda: 1.0)
        for (pattern, kind), confidence in accepted.items():
            for i, seed in seeds[pattern].items():
                if not seed:
                    doubt[i, kind] *= max(1 - confidence, 1e-6)
        belief = {key: 1 - d for key, d in doubt.items()} | dict.fromkeys(known, 1.0)
    for doc, start, end, _, kind, patterns in found:
        best = max(((c, k) for (p, k), c in accepted.items() if p in patterns), default=None)
        if kind is None and best:
            spans[doc].append((best[1], start, end))
    out = {}
    for doc, text in texts.items():
        out[doc], reach = "", 0
        for start, end, kind in sorted((s, e, k) for k, s, e in spans[doc]):
            if start >= reach:
                out[doc] += text[reach:start] + f"[{kind.upper()}]"
            reach = max(reach, end)
        out[doc] += text[reach:]
    return out


def test_pipeline(spark, tmp_path):
    import sentencepiece

    phones = "SELECT 900000 + i, 'call +1 (269) 555-' || (1000 + i) || ' about lot ' || sha256(i::varchar), 'en', 's', 0 FROM range(30) t(i)"
    odd = "SELECT 910000, 'call 030 123 4567 about lot of the old house', 'en', 's', 0"
    source = "/root/testdata/sf0.001"
    duckdb.sql(f"COPY (SELECT * FROM '{source}/documents.parquet' UNION ALL {phones} UNION ALL {odd}) TO '{tmp_path}/documents.parquet'")
    duckdb.sql(f"COPY (SELECT * FROM '{source}/benchmark.parquet') TO '{tmp_path}/benchmark.parquet'")
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{tmp_path}/documents.parquet'").fetchall()
    benchmark = duckdb.sql(f"SELECT item_id, text FROM '{tmp_path}/benchmark.parquet'").fetchall()
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    dictionaries, margin = language.learn(table.where(~language.held_out()))
    compressors = language.Compressors(dictionaries)
    sizes = [len(docs)]
    judged = {doc: compressors.classify((text or "").encode()) for doc, text in docs}
    docs = [(d, t) for d, t in docs if judged[d][0] != "und" and judged[d][1] >= margin]
    sizes.append(len(docs))
    groups = components(docs)
    docs = [(d, t) for d, t in docs if groups[d][1] == d]
    sizes.append(len(docs))
    leaks = contamination(docs, benchmark)
    docs = [(d, t) for d, t in docs if not leaks[d][2]]
    sizes.append(len(docs))
    assert len(set(sizes[1:])) == 3  # the middle stages drop some
    texts = masked_texts(dict(docs))
    assert texts[910000].startswith("call [PHONE] about")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows = queries()["pipeline"](spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {d: library.encode(t) for d, t in texts.items()}
    assert all(r.n_pieces == len(r.ids) for r in rows) and len(rows) == len(texts)
