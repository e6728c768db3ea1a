"""Word-by-word encoding against encoding whole texts."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.encode import Encoder
from tidemark.llm.token_files import ids_crc32, read_token_files, write_token_files
from pyspark.sql import functions as F

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {"byte": (Encoder(BYTE, "byte", 2), Tokenizer.from_file(BYTE)), "word": (Encoder(WORD, "word", 1), Tokenizer.from_file(WORD))}


def whole(kind, text):
    encoder, tokenizer = ENCODERS[kind]
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, encoder.end]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_pieces_give_the_ids_of_whole_texts(kind, texts):
    ids, offsets = ENCODERS[kind][0].encode(texts)
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == whole(kind, text)


@pytest.mark.parametrize("kind", ["byte", "word"])
@hypothesis_settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("aB1 \n\t'.,s<|> ́̈é \x1c\x85ΣΣﬁ日") | st.characters(codec="utf-8"), max_size=40))
def test_any_text(kind, text):
    ids, _ = ENCODERS[kind][0].encode([text])
    assert ids.tolist() == whole(kind, text)


def test_no_texts():
    ids, offsets = ENCODERS["byte"][0].encode([])
    assert len(ids) == 0 and offsets.tolist() == [0]


def test_files_hold_every_text_in_order(spark, awkward, tmp_path):
    path = f"file://{tmp_path}/tokens"
    write_token_files(awkward, path, BYTE)
    got = read_token_files(spark, path).select("*", ids_crc32("tokens").alias("crc")).orderBy("start").collect()
    at = 0
    for row in got:
        assert row.start == at and row.n_tokens == len(row.tokens)
        assert row.crc == zlib.crc32(np.array(row.tokens, "<u4").tobytes())
        at += row.n_tokens
    ids = [row.doc_id for row in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted(str((r.doc_id, whole("byte", r.text))) for r in awkward.collect())
    assert sorted(str((r.doc_id, list(r.tokens))) for r in got) == want


def test_selective_reads(spark, awkward, tmp_path):
    path = f"file://{tmp_path}/tokens"
    write_token_files(awkward, path, BYTE)
    plan = spark.read.parquet(path).where(F.col("doc_id") == 3).select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "EqualTo(doc_id,3)" in plan


def test_empty_table(spark, nothing, tmp_path):
    write_token_files(nothing, f"file://{tmp_path}/none", BYTE)
    assert read_token_files(spark, f"file://{tmp_path}/none").count() == 0


def test_a_task_encodes_on_its_own_core(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte", 2)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


# Latin pieces whose runs need care: case, marks, digits, line ends, quotes, special tokens, neighbours of the letters.
LATIN = [
    "Stnd stnd. stnd*** STND 2024 a1b2c3 x.y,z", "Éch éch ÀÖØÞßÿ áí­ ª×÷µ", "one.\nDe two\n\nthree\nfour 5\n6", "don't DON'T l'été 'tis",
    "a<b <|endoftext|>! a<|startoftext|>", "é é́ ﬁn ŉ ǅ", "_x_ __ -- --a a-- `~^", "a", ".", "a\n", "\na", "a\x1fb \x1f", "~ \x7f ~\x80~ \xa0 é\x85é", "١٢ 1١a",
]


@pytest.mark.parametrize("kind", ["byte", "word"])
@hypothesis_settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("abZ09.,!'<\n  éÉÀßÿíà×÷_~\x1fĠ́"), max_size=30))
def test_any_latin_text(kind, text):
    ids, _ = ENCODERS[kind][0].encode([text])
    assert ids.tolist() == whole(kind, text)


@pytest.mark.parametrize("kind", ["byte", "word"])
@pytest.mark.parametrize("remembered", [0, 8, 400_000])
def test_latin_pieces_and_forgetting(kind, remembered):
    """Each text alone, all at once, and again when parts have been forgotten."""
    made = Encoder(BYTE if kind == "byte" else WORD, kind, 2 if kind == "byte" else 1, remembered)
    for texts in (*([one] for one in LATIN), [None, *LATIN, "", *LATIN], LATIN):
        ids, offsets = made.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [whole(kind, text) for text in texts]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_a_part_is_encoded_once_for_all_pieces_that_hold_it(kind):
    """Pieces that differ only in the signs around a word do not have the word encoded anew."""
    made = Encoder(BYTE if kind == "byte" else WORD, kind, 2 if kind == "byte" else 1)
    made.encode(["x thndshin a. a, a! a***"])
    before = len(made.known)
    made.encode(["x thndshin. thndshin, thndshin! thndshin***"])
    assert len(made.known) == before
