import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb2

from longtrace.llm import pieces

MODEL = pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = ["", " ", "a", "Hello  wörld ①\t\n x ▁ y ", "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " é é", "  lead", "ﬁ ㌔ ｱﾞ Ａ", "a\0b", "x" * 30000, "word " * 5000]


@pytest.mark.parametrize("name", ["identity", "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_normaliser_matches_library(name, prefix, trim):
    base = pb2.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=name).serialized_model_proto())
    base.normalizer_spec.add_dummy_prefix = prefix
    base.normalizer_spec.remove_extra_whitespaces = trim
    base.normalizer_spec.escape_whitespaces = True
    model = base.SerializeToString()
    library = sentencepiece.SentencePieceNormalizer(model_proto=model)
    for text in TEXTS:
        out, align = pieces.normalise(text.encode(), pieces.Rules.of(model))
        assert out.decode() == library.normalize(text)
        assert len(align) == len(out) + 1 and (align[1:] >= align[:-1]).all() and align[-1] <= len(text.encode())


def test_spans_agree_with_library_offsets():
    encoder, sp = pieces.Encoder(MODEL), sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in TEXTS[:8]:
        ids, spans = encoder.encode(text)
        raw = text.encode()
        assert ids == sp.encode(text)
        proto = sp.encode(text, return_type="proto")
        for p, (a, b) in zip(proto.pieces, spans.tolist(), strict=True):
            if not sp.is_byte(p.id):
                assert (a, b) == (p.begin, p.end)
        assert not ids or (spans[0, 0] == 0 and spans[-1, 1] == len(raw))


def test_query_digests_and_edges(spark):
    rows = [(1, t, "n") for t in TEXTS] + [(None, "null id", "n"), (7, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted(str((i, len(sp.encode(t or "")), sha(",".join(map(str, sp.encode(t or "")))), sha(sp.decode(sp.encode(t or ""))))) for i, t, _ in rows)
    got = sorted(str(tuple(r)[:4]) for r in pieces.round_trip(docs, MODEL).collect())
    assert got == want
    assert pieces.round_trip(docs.limit(0), MODEL).count() == 0
    encoded = pieces.encode(docs, MODEL)
    assert {r.text for r in pieces.decode(encoded, MODEL).collect()} == {sp.decode(sp.encode(t or "")) for _, t, _ in rows}
    assert encoded.where(F.size("ids") != F.size("starts")).count() == 0
