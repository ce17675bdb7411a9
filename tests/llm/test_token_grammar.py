import itertools
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yearwheel.llm import token_grammar
from yearwheel.llm.files import coalesced
from yearwheel.operators.staging import Staging

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@given(st.lists(st.lists(st.integers(3, 9), max_size=60), min_size=1, max_size=6))
@settings(deadline=None)
def test_blocks_decode_exactly(documents):
    ids = [np.array([*d, 2], np.uint32) for d in documents]
    sizes = np.array([len(i) for i in ids])
    names = [None if k == 1 else k for k in range(len(ids))]
    block = token_grammar.Block(token_grammar.block_bytes(names, np.concatenate(ids), sizes, 10, 2))
    whole, ends = block.all()
    assert block.doc_ids == names and np.array_equal(np.diff(ends, prepend=0), sizes)
    assert np.array_equal(whole, np.concatenate(ids))
    assert all(np.array_equal(block.ids_of(k), i) for k, i in enumerate(ids))


def test_repetition_is_compressed():
    ids = np.tile(np.arange(3, 19, dtype=np.uint32), 500)
    seq, rules = token_grammar.re_pair(ids, 100, 2)
    assert len(seq) < len(ids) / 4 and token_grammar.expansion_lengths(rules, 100).max() > 4


@given(st.text(max_size=80))
@settings(deadline=None)
def test_words_give_the_tokenizers_ids(text):
    encoder = token_grammar.word_encoder(PATH)
    whole = tokenizers.Tokenizer.from_file(PATH)
    ids, sizes = encoder([text, None, text + " foo<|endoftext|>bar, É́x²'s"])
    want = [whole.encode(t, add_special_tokens=False).ids for t in (text, "", text + " foo<|endoftext|>bar, É́x²'s")]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_files(docs, no_docs, stage, spark):
    whole = tokenizers.Tokenizer.from_file(PATH)
    rows = docs.select("doc_id", "text").distinct()
    index = token_grammar.write_tokens(rows, stage.folder, PATH, end_id=2, block_ids=500)
    got = token_grammar.read_tokens(index).orderBy("start").collect()
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in rows.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    digests = {(r.start, r.ids_crc32) for r in token_grammar.read_tokens(index, digest=True).collect()}
    assert digests == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    one = index.orderBy("part", "block").first()
    ((_, data),) = coalesced([(one.file, one.offset, one.length)])
    assert token_grammar.Block(data).ids_of(0).tolist() == got[0].ids
    assert token_grammar.read_tokens(token_grammar.write_tokens(no_docs, Staging(spark).folder, PATH, 2)).count() == 0


def test_many_new_words_are_encoded_together():
    """No Python call for each new word (F1); the ids are the tokenizer's, across the runs of words that are spelled together."""
    encoder, whole = token_grammar.WordEncoder(PATH), tokenizers.Tokenizer.from_file(PATH)
    encoder(["Warm, up é."])  # imports of the libraries
    plain = ["".join("abcdefghij"[int(c)] for c in str(k)) for k in range(2000)]
    calls = 0

    def counted(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    before = sys.getprofile()
    sys.setprofile(counted)
    try:
        ids, _ = encoder([" ".join(plain)])
    finally:
        sys.setprofile(before)
    assert ids.tolist() == whole.encode(" ".join(plain), add_special_tokens=False).ids
    assert calls < len(plain) / 2
    # Latin letters of two bytes, letters that change in length or meaning, signs after them, words in between that take the whole path
    odd = ["É", "ß", "ſ", "İ", "ǅ", "ÿ", "Ĳ", "ŉ", "é", "日本", "Σ", "x1", "don't", "'"]
    mixed = [w + o + w[::-1] + sign for w, o, sign in zip(plain, itertools.cycle(odd), itertools.cycle(["", ".", "\"),", "'", "…"]))]
    texts = [" ".join(mixed), "\n".join(mixed[::3]), None, " ".join(plain[::7]) + "."]
    ids, sizes = encoder(texts)
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_pairs_next_to_end_ids_and_ties_of_full_slots():
    rng = np.random.default_rng(5)
    ids = np.minimum(3 + rng.geometric(0.05, 60_000), 399).astype(np.uint32)
    ids[rng.integers(0, len(ids), 3000)] = 2
    ids[[0, 1, -1]] = 2
    seq, rules = token_grammar.re_pair(ids, 400, 2, per_round=64)
    assert len(rules) and not (rules == 2).any() and (seq == 2).sum() == (ids == 2).sum()
    sizes = np.diff(np.flatnonzero(ids == 2), prepend=-1)
    block = token_grammar.Block(token_grammar.block_bytes(list(range(len(sizes))), ids, sizes, 400, 2))
    assert np.array_equal(block.all()[0], ids) and np.array_equal(np.diff(block.all()[1], prepend=0), sizes)
