import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yearwheel.llm import viterbi_pieces

pytest.importorskip("sentencepiece")
PATH = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return viterbi_pieces.PieceModel(PATH)


@given(st.text(max_size=60))
@settings(deadline=None)
def test_round_trip_and_best_path(text):
    model = viterbi_pieces._loaded(PATH)[0]
    units = model.units(text) if text else []
    coded = model.encode_units(units)
    assert coded == [model.encode_slowly(u) for u in units]
    assert not text or model.decode([i for ids in coded for i in ids]) == text


def test_no_better_segmentation(model):
    """All ways to cut short units, against the one found."""

    def best(text):
        found = {0: 0.0}
        for end in range(1, len(text) + 1):
            found[end] = max(
                found[k] + (model.score_of[text[k:end]][0] if text[k:end] in model.score_of else model.fallback * len(text[k:end].encode()))
                for k in range(end)
                if text[k:end] in model.score_of or end - k == 1
            )
        return found[len(text)]

    for unit in (" internationalization", " Straßenbahn", " 日本語", " zzzzqqq", "🎉x"):
        ids = model.encode_units([unit])[0]
        pieces = {i: s for s, i in model.score_of.values()}
        assert abs(sum(pieces.get(i, model.fallback) for i in ids) - best(unit.replace(" ", "▁"))) < 1e-6


@pytest.fixture(scope="module")
def own():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def encoded(model, text):
    return [i for ids in model.encode_units(model.units(text) if text else []) for i in ids]


@given(st.one_of(st.text(max_size=80), st.text(alphabet="aehinorst l\n.,1日é", max_size=120)))
@settings(deadline=None, max_examples=300)
def test_ids_are_those_of_the_model(text):
    from sentencepiece import SentencePieceProcessor

    text = text.replace("▁", "_")
    assert encoded(viterbi_pieces._loaded(PATH)[0], text) == SentencePieceProcessor(model_file=PATH).encode(text)


def test_ids_of_words_and_long_units(model, own, texts):
    rng = random.Random(8)
    syllables = ["the", "d", "in", "er", "at", "ion", "qu", "zz", "Stra", "ß", "日本", "0", "9", "==", "ing", "é"]
    words = ["thed", "   thed", "internationalizationalism"] + ["".join(rng.choices(syllables, k=rng.randrange(1, 12))) for _ in range(3000)]
    long = ["".join(rng.choices(syllables, k=k)) for k in (200, 1500, 6000)] + ["a" * 5000, "日" * 4500, " " * 5000, "=" * 3000]
    some = [t for t in texts if t]
    assert max(map(len, long)) > viterbi_pieces.STEPPED
    for text in [*words, " ".join(words), *long, *some]:
        assert encoded(model, text) == own.encode(text)
    units = [" " + w for w in words] + long
    assert model.encode_units(units) == [model.encode_slowly(u) for u in units]


def test_viterbi_of_a_ranked_model():
    model = viterbi_pieces.PieceModel(PATH, viterbi=True)
    units = [" thed", " internationalization", " 日本語", "🎉x", " zzzzqqq"]
    coded = model.encode_units(units)
    assert coded == [model.encode_slowly(u) for u in units]
    assert [model.joined(ids).decode() for ids in coded] == units


def test_tables(docs, no_docs):
    coded = viterbi_pieces.encode_texts(docs, PATH, ["doc_id", "text", "kept"])
    back = viterbi_pieces.decode_ids(coded.drop("text"), PATH, ["doc_id", "kept"]).collect()
    want = docs.select("doc_id", "text").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")
    assert [key(r) for r in sorted(back, key=key)] == [key(r) for r in sorted(want, key=key)]
    checked = viterbi_pieces.encode_and_check(docs, PATH, ["doc_id"]).collect()
    assert all(r.round_trip for r in checked) and len(checked) == len(want)
    by_text = {(r.doc_id, r.text): r.piece_ids for r in coded.collect()}
    digests = {zlib.crc32(np.array(i, "<u4").tobytes()) for i in by_text.values()}
    assert {r.ids_crc32 for r in checked} == digests
    assert {r.decoded_sha256 for r in checked} == {sha256((t or "").encode()).hexdigest() for _, t in by_text}
    assert viterbi_pieces.encode_and_check(no_docs, PATH, ["doc_id"]).count() == 0
