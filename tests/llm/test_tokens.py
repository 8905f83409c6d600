"""SentencePiece encoding and token counts against the library."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from kabuto.llm import pieces as P
from kabuto.llm import sentencepiece_fst as S
from kabuto.llm import token_counts as T
from kabuto.llm.queries import queries

from .conftest import ODD, SF


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=P.read_model())


@pytest.fixture(scope="module")
def samples(library, texts):
    rng = random.Random(4)
    pieces = [library.id_to_piece(i) for i in range(259, 32000)]
    out = [t for _, t in texts] + [t for _, t in ODD if t]
    out += ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    out += ["".join(rng.choice("ab c\n,.1\u2581\u65e5") for _ in range(rng.randrange(1, 60))) for _ in range(500)]
    return [*out, " " * 37, "a" * 700, "<0x41>", "\r\n\t", "x\u200b"]


def test_counts_match_the_library(library, samples):
    counts = T.Counts(P.parse_model(P.read_model()))
    assert [T.count_text(t, counts) for t in samples] == [len(x) for x in library.encode(samples)]


def test_ids_and_decoding_match_the_library(library, samples):
    fst = S.transducer(P.read_model())
    found = [memoryview(fst.encode(t)).cast("i").tolist() for t in samples]
    assert found == library.encode(samples)
    assert [fst.decode(x) for x in found] == [t.replace(P.SPACE, " ") for t in samples]


def test_odd_rows(odd, library):
    rows = T.token_counts(odd).collect()
    expected = sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or ""))) for i, t in ODD)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == expected
    assert [r.over_limit for r in rows if r.doc_id == 6] == [True]
    out = S.encode_documents(odd, decoded="back")
    assert out.where(~S.round_trip(F.col("text"), F.col("back"))).count() == 0
    assert {c: t for c, t in out.dtypes if c in ("ids", "key", "n_tokens")} == {"ids": "array<int>", "key": "string", "n_tokens": "int"}


def test_empty_table(odd):
    assert T.token_counts(odd.limit(0)).count() == 0
    assert S.encode_documents(odd.limit(0), decoded="back").count() == 0


def test_queries(spark, library, texts):
    counts = {r.doc_id: r.n_tokens for r in queries()["op9_token_counts"](spark, SF).collect()}
    rows = {r.doc_id: r for r in queries()["op1_sentencepiece"](spark, SF).collect()}
    for i, t in texts:
        assert rows[i].ids == library.encode(t) and rows[i].same and rows[i].n_tokens == counts[i] == len(rows[i].ids)


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(P.read_model())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        P.parse_model(proto.SerializeToString())
