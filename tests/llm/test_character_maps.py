"""Whole texts through a model with a compiled character map, against the library."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from ledgerloom.llm import queries, sentencepieces

ODD = ["", " ", "a", "ab", "e\u0301", "ab e\u0301x  y", "ﬁne ﬃ ① Ａ㌔ ｱﾞ", "a\u00a0b\u3000c\tq\n\nz ", "x\u200by\ufeffz", "~~``^^ |<>|", "日本語  テスト½", "👩‍👩‍👧 ok", "A\u030a a\u0308\u0304 q\u0307\u0323", "tail  "]


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf"])
def test_maps_agree_with_the_library(spark, rule):
    import sentencepiece

    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        model = sentencepieces.with_map(f.read(), rule)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sentencepieces.encode_pieces(df, P.path("piece_bpe_32k.model"), rule=rule).collect():
        ids = library.encode(r.text, add_bos=True, add_eos=True)
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.decoded == library.decode(ids)
        spans = np.frombuffer(bytes(r.spans), "<u4").reshape(-1, 2)
        assert (spans[1:, 0] == spans[:-1, 1]).all() and (spans[:, 0] <= spans[:, 1]).all() and spans[-1, 1] <= len(r.text.encode())


def test_query_with_a_map(spark):
    out = queries.normalised_pieces(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert len({r.ids_sha256 for r in out}) > 100 and all(len(r.spans_sha256) == len(hashlib.sha256().hexdigest()) for r in out)


def test_runs_take_words_with_their_blanks():
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        own = sentencepieces.Normaliser.of(sentencepieces.with_map(f.read(), "nmt_nfkc"))
    asked, longest = [], own.charmap.longest
    own.charmap.longest = lambda data, at: asked.append(at) or longest(data, at)
    text = "plain words and größere Wörter; слова тоже. " * 20
    normal, places = own(text.encode())
    assert normal == ("▁" + text.replace(" ", "▁")).encode()
    assert places[-1] == len(text.encode()) and len(asked) < 10  # one by one, it would be hundreds
    assert [int(x) for x in places[3:6]] == [0, 1, 2] and places[normal.index("ö".encode())] == places[normal.index("ö".encode()) + 1]
