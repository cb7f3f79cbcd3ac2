"""Segmentation against the library's unigram encoder and brute force; exact round trips."""

import random

import pytest

from termtide.llm import pieces
from termtide.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def usable(node, piece=""):
    for key, below in node.items():
        if key == "":
            yield piece, below
        else:
            yield from usable(below, piece + key)


def test_best_sums(vocabulary):
    known = {piece: score for piece, (_, score) in usable(vocabulary.root)}
    names = {id_: piece for piece, (id_, _) in usable(vocabulary.root)}
    rng = random.Random(3)
    words = sorted({pieces.MARK + "".join(rng.choice("theaionrs漢é") for _ in range(rng.randint(0, 14))) for _ in range(1500)})
    for word, ids in zip(words, pieces.segment(words, vocabulary)):
        best = [0.0]
        for end in range(1, len(word) + 1):
            best.append(max([best[end - 1] + vocabulary.unknown, *(best[i] + known[word[i:end]] for i in range(end) if word[i:end] in known)]))
        # letters without a piece stand as their bytes
        total, at = 0.0, 0
        while at < len(ids):
            if ids[at] in names:
                total += vocabulary.scores[ids[at]]
                at += 1
            else:
                first = next(b for b, i in vocabulary.byte_ids.items() if i == ids[at])
                total += vocabulary.unknown
                at += 3 if first >= 0xE0 else 2 if first >= 0xC0 else 1
        assert abs(total - best[-1]) < 1e-6


def test_library_agrees_on_a_unigram_model(tmp_path, vocabulary):
    sentencepiece = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    for i, piece in enumerate(proto.pieces):
        piece.score = vocabulary.scores[i]
    proto.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["The thermodynamics of internationalization", "un été très chaud à Québec", "Straßenbahnhaltestelle und Überraschung", "x = y + 42;"]
    for text in texts:
        assert pieces.encode_texts([text], vocabulary)[0].tolist() == library.encode(text)


def test_round_trip_of_the_table(spark, sf):
    rows = QUERIES["op3_shared_prefix_viterbi"](spark, sf).collect()
    assert rows and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)


def test_odd_rows(spark, vocabulary):
    texts = [None, "", " ", "  two  spaces ", "▁", "a▁ ▁b", "tab\tand\nline\x00", "漢字 😀 é", "word " * 40_000, "same", "same"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id int, text string, Ids string")
    out = pieces.encode(df, vocabulary)
    assert out.columns == ["doc_id", "text", "n_pieces", "ids", "decoded_sha256", "round_trip"]
    back = pieces.decode(out, vocabulary).collect()
    assert [r.text for r in sorted(back, key=lambda r: r.doc_id)] == [t or "" for t in texts] and all(r.round_trip for r in back)
    assert pieces.encode(df.limit(0), vocabulary).collect() == []
    loose = spark.createDataFrame([(1, None), (2, [])], "a int, ids array<int>")
    assert {r.text for r in pieces.decode(loose, vocabulary).collect()} == {""}
