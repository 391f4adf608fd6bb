from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.tokens import Encoder, public_path

KINDS = {"words": "word_bpe_49k.json", "spaced": "byte_bpe_50k.json"}
WHOLE = {cut: Encoder(public_path(name), None) for cut, name in KINDS.items()}
CUT = {cut: Encoder(public_path(name), cut, memo_words=50) for cut, name in KINDS.items()}
letters = st.text(st.sampled_from(" \n\t  \x1c　a.B'ésll1<|>́ΣİΐǅÅ"), max_size=60)


@pytest.mark.parametrize("cut", KINDS)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(letters | st.text(max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(cut, texts):
    assert CUT[cut].encode(texts) == WHOLE[cut].encode(texts)


@pytest.mark.parametrize("cut", KINDS)
def test_edge_texts(cut):
    encoder = Encoder(public_path(KINDS[cut]), cut, end_id=7)
    end = np.uint32(7).tobytes()
    assert encoder.encode([None, ""]) == [end, end]
    texts = [" a", "a ", " ", "  ", "a  b", "a \nb", "word " * 5000, "x" * 20000, "<|endoftext|> a"]
    assert encoder.encode(texts) == [ids + end for ids in WHOLE[cut].encode(texts)]


def test_plain_words_are_encoded_as_one_text(monkeypatch):
    """One call for all new words of letters; others, and marks at the end of words, are encoded each."""
    encoder, asked = Encoder(public_path(KINDS["words"]), "words"), []
    each = encoder._each
    monkeypatch.setattr(encoder, "_each", lambda words: asked.extend(words) or each(words))
    texts = ["Thor, \u00e9lan au. x!", "thr33 don't au. \u00c9LAN", "", " \t", "a..b ?! z\u0301 \u0130x \x1c \u0085"]
    assert encoder.encode(texts) == WHOLE["words"].encode(texts)
    assert set(asked) - {""} == {".", ",", "!", "thr33", "don't", "a..b", "?!", "z\u0301", "\u0130x", "\x1c", "\u0085"}


def test_letters_are_encoded_apart_from_marks_and_line_ends(monkeypatch):
    """A word is learned once, whatever marks or line ends stand beside it; apostrophes stay with it."""
    encoder = Encoder(public_path(KINDS["spaced"]), "spaced")
    texts = ["on word. word, word\nword. (word)", "on word### word.\nword élà.\nÉl don't 'word", "a×.b\n÷ é́. word"]
    assert encoder.encode(texts) == WHOLE["spaced"].encode(texts)
    learned = {piece.decode() for piece in encoder.memo}
    assert {piece for piece in learned if "word" in piece} == {" word", "word", " 'word"}
    assert {" élà", "Él", " don't", "\n", ".", "###"} <= learned


def test_a_tokenizer_that_does_not_part_marks_is_cut_at_spaces_only():
    from tokenizers import Tokenizer, models, pre_tokenizers

    encoder = Encoder(public_path(KINDS["spaced"]), "spaced")
    encoder.tokenizer = Tokenizer(models.BPE({"a": 0, ".": 1, "a.": 2, "Ġ": 3, "Ċ": 4}, [("a", ".")]))
    encoder.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    assert encoder.encode(["a. a.\na. a"]) == [np.array([2, 3, 2, 4, 2, 3, 0], dtype="<u4").tobytes()]
    assert not encoder.fine
