import random
import subprocess
import sys

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ledgermill.llm import piece_lattice as q
from ledgermill.llm.queries import PIECE_MODEL

ODD = ["", " ", "  a", "a\n\nb\t", "\x00x", "日本語 テスト", "▁▁a b▁", "<s> <0x0A> </s>", "a" * 3000, " " * 100, "🎉🎉 party", "aaaa bbbb  cccc", "=====-----", "\\\\\\\\", "é"]


def texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("abcdehilnorst  ▁1234=.-/\né") for _ in range(rng.randint(1, 60))) for _ in range(3000)]


@pytest.fixture(scope="module")
def model():
    return q.read_model(PIECE_MODEL)


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]


def test_equals_the_library(model):
    coder, library = q.Coder(q.load(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    own = texts()
    ids, ends = coder.encode(own)
    want = library.encode(own)
    assert split(ids, ends) == want
    assert coder.decode(ids, ends) == library.decode(want)


def toy(kind, pieces, fallback):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = kind
    proto.trainer_spec.byte_fallback = fallback
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if fallback]
    for piece, score, type_ in rows + [(p, s, 1) for p, s in pieces]:
        proto.pieces.add(piece=piece, score=score, type=type_)
    return proto.SerializeToString()


@pytest.mark.parametrize("kind", [q.UNIGRAM, q.BPE])
@pytest.mark.parametrize("fallback", [True, False])
def test_small_models_equal_the_library(kind, fallback):
    rng = random.Random(kind)
    words = {"".join(rng.choice("abc▁") for _ in range(rng.randint(2, 5))) for _ in range(40)}
    words |= {w[:k] for w in words for k in range(2, len(w))}  # merges need their parts
    pieces = [(w, -float(k) - 1 + (k % 7) / 8) for k, w in enumerate(sorted(words, key=lambda w: (len(w), w)))] + [(c, -100.0 - k) for k, c in enumerate("abc▁")]
    model = toy(kind, pieces, fallback)
    coder, library = q.Coder(q.load(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    own = ["".join(rng.choice("abc xyé") for _ in range(rng.randint(0, 25))) for _ in range(600)]
    got = split(*coder.encode(own))
    assert got == library.encode(own)


def test_column(spark, model):
    own = [*ODD, None, ODD[9]]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").withColumn("round_trip", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("extra", F.lit(2))
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = q.encode(docs, model)
    assert out.columns == ["doc_id", "extra", "ids", "round_trip"] and {r["extra"] for r in out.collect()} == {2}
    got = {r.doc_id: (r.ids, r.round_trip) for r in out.collect()}
    assert got == {k: (None, None) if t is None else (library.encode(t), True) for k, t in enumerate(own)}
    back = {r.doc_id: r.text for r in q.decode(out.select("doc_id", "ids", F.lit(3).alias("text")), model).collect()}
    assert back == {k: t if t is None else t.replace("▁", " ") for k, t in enumerate(own)}
    assert q.encode(docs.limit(0), model).count() == 0


def test_long_text_without_spaces(model):
    coder, library = q.Coder(q.load(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(60_000))
    assert split(*coder.encode([text]))[0] == library.encode(text)


@pytest.mark.parametrize("kind", [q.UNIGRAM, q.BPE])
@pytest.mark.parametrize("fallback", [True, False])
def test_groups_slices_and_forgetting_change_nothing(kind, fallback, monkeypatch):
    monkeypatch.setattr(q, "GROUP", 40)
    monkeypatch.setattr(q, "STORE", 90)
    monkeypatch.setattr(q, "PLACE_BITS", 4)
    rng = random.Random(7)
    words = {"".join(rng.choice("abc▁") for _ in range(rng.randint(2, 5))) for _ in range(40)}
    words |= {w[:k] for w in words for k in range(2, len(w))}
    pieces = [(w, -float(k) - 1 + (k % 7) / 8) for k, w in enumerate(sorted(words, key=lambda w: (len(w), w)))] + [(c, -100.0 - k) for k, c in enumerate("abc▁")]
    model = toy(kind, pieces, fallback)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    own = ["".join(rng.choice("aabc xé") for _ in range(rng.choice([0, 3, 20, 30, 100, 400]))) for _ in range(150)]
    coder = q.Coder(q.load(model))
    for k in range(0, len(own), 10):
        ids, ends = coder.encode(own[k:k + 10])
        assert split(ids, ends) == library.encode(own[k:k + 10])
        assert coder.decode(ids, ends) == library.decode(library.encode(own[k:k + 10]))


MEMORY = """
import random, resource, sys
from ledgermill.llm import piece_lattice as q
rng = random.Random(1)
letters = "abcdefghijklmnopqrstuvwxyz\u00e4\u00f6\u00fc\u0431\u0433\u0434"
text = (" " if sys.argv[2] == "words" else "").join("".join(rng.choice(letters) for _ in range(rng.randint(2, 14))) for _ in range(250_000))
coder = q.Coder(q.load(q.read_model(sys.argv[1])))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids, ends = coder.encode([text, text[:1000]])
assert coder.decode(ids, ends) == [text, text[:1000]]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""


@pytest.mark.parametrize("kind", ["words", "one word"])
def test_memory_of_a_worker(kind):
    """Two million characters of ever new words, and as many without a space."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", MEMORY, PIECE_MODEL, kind], capture_output=True, text=True, check=True, cwd=root)
    assert float(out.stdout) < 150
