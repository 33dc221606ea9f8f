import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import piece_bpe
from tidemark.llm.common import load
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.load_model(PATH)


def odd_texts(model):
    rng = random.Random(1)
    letters = "▁ aeiotnhrs.ABC019\n\t<>é梦Ⅷ😀 \x00�"
    texts = ["", " ", "  a", "a▁b", "<s> </s> <0x0A>", " " * 70 + "the", "abcdefghij" * 3000, "\x1c\x85"]
    for k in range(2500):
        body = ("".join(rng.choices(letters, k=rng.randint(0, 60))) if k % 3 else
                "".join(rng.choice(model.pieces[259:]) for _ in range(rng.randint(1, 12))))
        texts.append(" " * (rng.randint(0, 70) if k % 7 == 0 else 0) + body)
    return texts


def test_ids_and_texts_equal_the_library(model, library):
    for text in odd_texts(model):
        ids = model.encode(text)
        assert ids == library.encode(text)
        assert model.decode(ids) == library.decode(ids)


def test_whole_texts_without_word_cuts(model, library):
    """The same ids come out when a text is backtracked as one word."""
    for text in odd_texts(model)[:800]:
        marked = piece_bpe.MARK + text.replace(" ", piece_bpe.MARK)
        if text and all(c in model.units for c in marked):
            assert [i for u in model.split(marked) for i in model.unit_ids(u)] == library.encode(text)


def test_broken_bytes_decode_as_the_library_does(model, library):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.randrange(3, 259) if rng.random() < .7 else rng.randrange(32000)
               for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids)


def test_small_caches_change_nothing(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(piece_bpe, "MAX_PAIRS", 5)
    for text in odd_texts(model)[:300]:
        assert model.encode(text) == library.encode(text)


def test_other_models_are_refused():
    with open(PATH, "rb") as f:
        raw = f.read()
    assert piece_bpe.PieceModel(raw).prefix
    unigram = raw.replace(b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01")    # model_type
    assert unigram != raw
    with pytest.raises(ValueError):
        piece_bpe.PieceModel(unigram)


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in load(spark, sf, "documents").collect():
        ids = library.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, QUERIES["op12_piece_bpe"](spark, sf).collect())) == sorted(want)


def test_odd_tables(spark, odd_docs, no_docs, library):
    got = piece_bpe.encode(odd_docs, PATH).collect()
    want = [(r["doc_id"], library.encode(r["text"] or "")) for r in odd_docs.collect()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    assert piece_bpe.encode(no_docs, PATH).collect() == []


def test_texts_cut_at_spaces_equal_the_library(model, library):
    import numpy as np
    for text in ["the cat", "a  b", " a", "a ", " ", "a▁ b", "a b▁", "x\ny z", "梦 é\tq the", "the " + "ab" * 90 + " the"]:
        found = model.packed(text)
        assert found.dtype == np.int32 and found.tolist() == library.encode(text)
    assert "cat" in model.spaced and not any(" " in w for w in model.spaced)
    assert model.packed(None).tolist() == model.packed("").tolist() == []


def test_batches_equal_the_library(model, library):
    texts = [*odd_texts(model), None, "", "the " + "ab" * 90 + " the", "▁▁ x", " ", "é\n梦\n梦 \U00010348"]
    for some in (texts, [], [None, ""]):
        ids, ends = model.packed_batch(some)
        got = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert got == [library.encode(t or "") for t in some]
        assert model.decode_batch(ids, ends) == [library.decode(i) for i in got]


def test_a_batch_merges_its_short_words_side_by_side(library, monkeypatch):
    with open(PATH, "rb") as f:
        fresh = piece_bpe.PieceModel(f.read())
    seen = []
    split = fresh.split
    monkeypatch.setattr(fresh, "split", lambda word: seen.append(word) or split(word))
    long = "ab" * 90
    ids, _ = fresh.packed_batch(["shninganing ofth.\nOnonon " + long, "Ofreshwhou " * 50])
    assert seen == [piece_bpe.MARK + long] and len(fresh.words) == 0
    assert ids.tolist() == library.encode("shninganing ofth.\nOnonon " + long) + library.encode("Ofreshwhou " * 50)


def test_a_batch_backtracks_its_short_words(library, monkeypatch):
    """Short words take the longest piece that goes with its left neighbour, else a shorter one."""
    with open(PATH, "rb") as f:
        fresh = piece_bpe.PieceModel(f.read())
    asked, fits = {}, fresh._fits

    def seen(left, right):
        found = fits(left, right)
        asked.update(zip(zip(left.tolist(), right.tolist(), strict=True), found.tolist(), strict=True))
        return found

    monkeypatch.setattr(fresh, "_fits", seen)
    texts = [t for t in odd_texts(fresh) if t][:400]
    ids, ends = fresh.packed_batch(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [library.encode(t) for t in texts]
    names = [*fresh.unit_texts, None]
    known = {(a, b): f for (a, b), f in asked.items() if a <= fresh.edge and b < fresh.edge}
    assert {names[a] for a, _ in known} > {None} and set(known.values()) == {True, False}
    for (a, b), found in known.items():
        assert found == fresh.compatible(names[a], names[b])
    taken = {(a, b) for text in texts if "  " not in text and not set(text) - set("".join(fresh.id)) - {" "}
             for word in text.split(" ") if 0 < len(word) < 60 and piece_bpe.MARK not in word
             for units in [fresh.split(piece_bpe.MARK + word)] for a, b in zip([None, *units], units)}
    number = {u: n for n, u in enumerate(names)}
    assert len(taken) > 50 and all(known[number[a], number[b]] for a, b in taken)


def test_small_tables_of_pairs_change_nothing_in_batches(library, monkeypatch):
    with open(PATH, "rb") as f:
        raw = f.read()
    for name, value in (("MAX_PAIRS", 5), ("WIDTHS", (6, 9)), ("COLUMNS", 7)):
        with monkeypatch.context() as m:
            m.setattr(piece_bpe, name, value)
            fresh = piece_bpe.PieceModel(raw)
            texts = odd_texts(fresh)[:300]
            ids, ends = fresh.packed_batch(texts)
            assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [
                library.encode(t) for t in texts]
            assert name != "MAX_PAIRS" or len(fresh.known_pairs) < 2000
