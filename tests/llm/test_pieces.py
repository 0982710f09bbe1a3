import random
import time
from pathlib import Path

import pytest

from lexiframe.llm import pieces
from lexiframe.llm.queries import PIECES_PATH

spm = pytest.importorskip("sentencepiece")
from sentencepiece import sentencepiece_model_pb2 as pb  # noqa: E402

needs_model = pytest.mark.skipif(not Path(PIECES_PATH).exists(), reason="no public model file here")
ALPHABET = list(" \n\tabcdefghijklmnopqrstuvwxyzABCéüñß中文。0123456789.,-_()[]{}<>=+*/\\\"'😀▁") + [" "] * 20 + list("etaoinshr") * 5


def noise(draw, n=60):
    return "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, n)))


@pytest.fixture(scope="module")
def model():
    return pieces.load_pieces(PIECES_PATH)


def by_hand(kind, byte_fallback):
    """A small model stated piece by piece; nothing is trained."""
    proto = pb.ModelProto()
    proto.trainer_spec.model_type = kind
    proto.trainer_spec.byte_fallback = byte_fallback
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.remove_extra_whitespaces = False
    rows = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    if byte_fallback:
        rows += [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    draw = random.Random(6)
    seen = list("▁abcde") + ["ab", "bc", "abc", "▁a", "▁ab", "de", "cd", "bcd", "ee", "eee", "▁d", "ea", "aa", "aaa"]
    for n, piece in enumerate(seen):
        score = -float(n) if kind == 2 else -draw.randint(2, 40) / 4 - 2 * (len(piece) == 1)
        rows.append((piece, score, 1))
    for piece, score, kind_of in rows:
        proto.pieces.add(piece=piece, score=score, type=kind_of)
    return proto


@needs_model
def test_ids_are_the_library_s(model):
    library = spm.SentencePieceProcessor(model_file=PIECES_PATH)
    draw, cache = random.Random(1), {}
    texts = [noise(draw) for _ in range(1500)] + ["", " ", "   a  b ", "▁", "\n\n a", "a" * 3000, " " * 100, "abc " * 5000]
    texts += ["".join(draw.choice(model.pieces[259:]) for _ in range(8)) for _ in range(500)]
    for text, ids in zip(texts, model.encode(texts, cache)):
        assert ids.tolist() == library.encode(text), repr(text[:80])
        assert model.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace("▁", " ")


@needs_model
def test_long_units_in_windows(model):
    """Without a space: letters, scripts, runs of one piece and of odd lengths, and a megabyte in seconds."""
    library = spm.SentencePieceProcessor(model_file=PIECES_PATH)
    draw = random.Random(5)
    texts = ["".join(draw.choice(letters) for _ in range(4000)) for letters in ("etaoinshrdlu", "abcé中文。ß0", "ab", "0123456789", "/:.-_")]
    texts += ["ab" * 3000, "x" * 5000, "license" * 900, "the" * 1201 + "é", "<html>" * 700, "=" * 3001]
    for text, ids in zip(texts, model.encode(texts, {})):
        assert ids.tolist() == library.encode(text), text[:20]
    long = "".join(draw.choice("etaoinshrdlu/") for _ in range(1_000_000))
    began = time.process_time()
    ids = model.encode([long], {})[0].tolist()
    assert time.process_time() - began < 40
    assert ids == library.encode(long)


@needs_model
def test_windows_join_where_they_agree(model):
    draw = random.Random(7)
    window = pieces.WINDOW_STEP + max(pieces.OVERLAP, 2 * model.longest)
    joined = 0
    for letters in ("etaoinshrdlu", "aehilnorst", "中文的一是不了人我在"):
        word = "".join(draw.choice(letters) for _ in range(3000))
        ids = model.joined(word, window)
        joined += ids is not None
        assert ids is None or ids == model.merged(word)
    assert joined >= 2


@pytest.mark.parametrize("kind", [pieces.UNIGRAM, pieces.BPE])
@pytest.mark.parametrize("byte_fallback", [True, False])
def test_models_of_both_kinds_by_hand(kind, byte_fallback):
    proto = by_hand(kind, byte_fallback)
    ours, library = pieces.from_proto(proto), spm.SentencePieceProcessor(model_proto=proto.SerializeToString())
    draw = random.Random(2)
    for _ in range(1500):
        text = "".join(draw.choice("aabbccddee  \nxé") for _ in range(draw.randint(0, 25)))
        assert ours.encode([text], {})[0].tolist() == library.encode(text), repr(text)


@needs_model
def test_cache_and_stretches_change_nothing(model, monkeypatch):
    draw = random.Random(3)
    texts = [noise(draw, 400) for _ in range(60)]
    whole = [ids.tolist() for ids in model.encode(texts, {})]
    monkeypatch.setattr(pieces, "STRETCH", 16)
    monkeypatch.setattr(pieces, "CACHED", 20)
    monkeypatch.setattr(pieces, "CELLS", 100)
    assert [ids.tolist() for ids in model.encode(texts, {})] == whole


@needs_model
def test_rows(spark, model):
    rows = [(1, "Hello  world\n", 5), (1, "Hello  world\n", 5), (2, None, 5), (3, "", 5), (None, "x" * 100_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    encoded = pieces.encode_texts(docs, model)
    found = {r.doc_id: r for r in pieces.decode_ids(encoded, model).collect()}
    assert encoded.count() == 5 and found[1].text == "Hello  world\n" and found[2].text == "" and found[2].ids == []
    assert found[None].text == "x" * 100_000
    assert pieces.encode_texts(docs.limit(0), model).count() == 0


def test_unsupported_models_are_refused():
    proto = by_hand(pieces.UNIGRAM, False)
    proto.normalizer_spec.precompiled_charsmap = b"x"
    with pytest.raises(ValueError):
        pieces.from_proto(proto)
    proto = by_hand(pieces.UNIGRAM, False)
    proto.pieces.add(piece="own", score=0, type=4)
    with pytest.raises(ValueError):
        pieces.from_proto(proto)
