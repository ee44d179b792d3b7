"""Spans of the encoder: against text-by-text encoding, and of a model with a compiled character map."""

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from strata.llm.sp_codec import Model

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [None, "", " ", "a", "one two", " lead", "tail ", "two  spaces", "x▁y", "tab\there", "line\nbreak here", "日本語 テキスト 漢", "😀 a🏳️‍🌈b", "naïve façade",
         "\x00 zero", "a" * 300, "w " * 50 + "end", "<0x41> </s>", "ab\n cd", "é é", "ﬁne ①② Ｆull ½"]


def blob():
    with open(PATH, "rb") as f:
        return f.read()


def test_words_give_what_whole_texts_give(tables):
    texts = TEXTS + [t if t == t else None for t in tables("documents").text.tolist()]
    model, library = Model(blob()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t, (ids, start, end, decoded) in zip(texts, model.encode_all(pa.array(texts, pa.string())), strict=True):
        want = model.encode(t)
        assert ids.tolist() == want[0].tolist() == library.encode(t or "")
        assert start.tolist() == want[1].tolist() and end.tolist() == want[2].tolist()
        assert decoded == library.decode(ids.tolist())


def with_rule(rule, squeeze):
    """The public model with a compiled character map of the library's own."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(blob())
    if rule:
        norm = pb.ModelProto()
        norm.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = norm.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    return proto.SerializeToString()


@pytest.mark.parametrize("rule,squeeze", [("nmt_nfkc", True), ("nfkc", False), ("", True), ("", False)])
def test_character_map_and_spans(rule, squeeze):
    file = with_rule(rule, squeeze)
    library, model = sentencepiece.SentencePieceProcessor(model_proto=file), Model(file)
    assert bool(model.map.firsts) == bool(rule)
    texts = ["ka lo", "  ka   lo ", "ﬁka ①２ Ｋa", "né né", "ka\tlo\nmi", "½ ﬀ", "", None, "ｋａ　ｌｏ"]
    for t, (ids, start, end, decoded) in zip(texts, model.encode_all(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == library.encode(t or "")
        assert decoded == library.decode(ids.tolist())
        n = len((t or "").encode())
        assert all(0 <= a <= b <= n for a, b in zip(start, end, strict=True))
        assert all(a <= b for a, b in zip(start[:-1], start[1:], strict=True)) and all(a <= b for a, b in zip(end[:-1], end[1:], strict=True))
