import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catspark.llm import token_files, tokens
from catspark.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {f: Encoder(P.path(f)) for f in FILES}
LIBRARY = {f: Tokenizer.from_file(P.path(f)) for f in FILES}
for t in LIBRARY.values():
    t.encode_special_tokens = True
ODD = ["", " ", "\n\n", "  two  spaces ", "it's we'll 'S don't", "a\tb\r\nc", "é́ éx ́",
       "<|endoftext|> x", "word,next.Done!? (par)", "x" * 500, "1234 5a6b", "日本語 テキスト", "a b c",
       "tail ", "\nlead", " .", ". .", "ÀÉÎ ß ÿ", "foo!!\nBar", "\n\nBar", " \nBar", "İI ıi Σς",
       "naïve,​zero", "a\x1cb \x85c"]


def library_ids(name, texts):
    return [np.asarray(e.ids, "<u4").tobytes()
            for e in LIBRARY[name].encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = [r[0] for r in duckdb.sql(
        f"SELECT text FROM '{SF001}/documents.parquet'").fetchall()] + ODD
    want = [x + b"\1\0\0\0" for x in library_ids(name, texts)]
    assert [zlib.crc32(x) for x in ENCODERS[name].encode(texts, 1)] == [
        zlib.crc32(x) for x in want]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,!'aBcéÀß1-_"), st.characters(
    exclude_categories=("Cs", "Cn"))), max_size=40))
def test_random_texts(name, text):
    assert ENCODERS[name].encode([text, None], 1) == [
        library_ids(name, [text])[0] + b"\1\0\0\0", b"\1\0\0\0"]


@pytest.mark.parametrize("name", FILES)
def test_piece_tables_stay_small_within_a_call(name, monkeypatch):
    """One long list of texts with more pieces than are kept: the ids stay right."""
    monkeypatch.setattr(tokens, "KEPT_PIECES", 40)
    texts = [" ".join(f"common w{i * j}x, {chr(97 + i % 26)}é{j}" for j in range(9)) for i in range(60)]
    codes = Encoder(P.path(name))
    want = [x + b"\1\0\0\0" for x in library_ids(name, texts)]
    assert codes.encode(texts, 1) == want == codes.encode(texts, 1)
    assert max(len(t) for t in (codes.pieces, codes.spaced, codes.marks)) <= 40


def test_a_word_in_several_cases_is_worked_out_once(monkeypatch):
    codes, asked = Encoder(P.path("word_bpe_49k.json")), []
    run = codes._run
    monkeypatch.setattr(codes, "_run", lambda x: asked.append(x) or run(x))
    texts = ["a Word word, wORD.\nWord\nword! Éé éé, ÉÉ"]
    assert codes.encode(texts, 1) == [x + b"\1\0\0\0" for x in library_ids("word_bpe_49k.json", texts)]
    assert sorted(x for x in asked if x.isalpha()) == ["word", "éé"]


def test_reading_ids_back_frees_the_encoders():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([0, 0]), pa.array([0, 2]), pa.array([2, 1]),
         pa.array([[5, 1], [1]], pa.list_(pa.int32()))],
        ["doc_id", "part", "local_start", "n_tokens", "ids"])
    tokens.encoder(P.path(FILES[0])).encode(["a text"], 1)
    sums = [r for b in token_files.ids_crc32([batch]) for r in b.column("ids_crc32").to_pylist()]
    assert sums == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ([5, 1], [1])]
    assert not tokens._ENCODERS
