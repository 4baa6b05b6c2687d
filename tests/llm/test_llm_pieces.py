import hashlib

import pytest
import sentencepiece
from llm_helpers import DOCS, by_value, odd_texts, with_clashes

from visitscope.llm import piece_encoding as P
from visitscope.llm.catalog import PIECE_MODEL, op3_piece_encoding, tokenizer_path

MODEL = tokenizer_path(PIECE_MODEL)
ODD = ["", " ", "  ", " a", "a ", "a  b", "  a   b  ", "\n\n a \n", "▁x ▁▁ y", "a▁ b", "日本語 テキスト 😀😀", "a b\tc\x00d", "x" * 5000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def digest(library, text):
    ids = library.encode(text or "")
    decoded = library.decode(ids) if ids else ""
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_digests_equal_the_library(library):
    enc = P.PieceEncoder(MODEL)
    assert enc.by_word
    for _ in range(2):  # the second time from memory
        assert enc.digests(ODD) == [digest(library, t) for t in ODD]


def test_digests_come_from_ids_and_spans(monkeypatch):
    enc = P.PieceEncoder(MODEL)
    more = [*ODD, "é " * 40 + "x" * 100 + "  ü", "日本 " + "語" * 200 + " ", "the cat and the cat"]
    for _ in range(2):  # remembered words give the spans of the whole text's own encoding
        for text, found in zip(more, enc.encode_all(more), strict=True):
            assert tuple(c.tolist() for c in found) == (enc.encode(text) if text else ([], [], []))
    assert max(map(len, enc._row)) <= P.LONGEST_REMEMBERED and len(enc._row) == len(enc._count)
    decoded = []
    monkeypatch.setattr(enc, "sp", type("Spy", (), {"encode": enc.sp.encode, "decode": lambda self, ids: decoded.append(ids) or "spied"})())
    found = enc.digests(["the cat", ""])
    assert len(decoded) == 1 and found[0][2] == hashlib.sha256(b"spied").hexdigest()
    enc._end.data += 1
    with pytest.raises(ValueError, match="spans"):
        enc.digests(["the cat"])


def test_odd_rows(spark, library):
    rows = odd_texts()
    found = P.encode_digest(with_clashes(spark, rows), MODEL).collect()
    assert by_value(found) == by_value([(i, *digest(library, t)) for i, t in rows])
    assert P.encode_digest(spark.createDataFrame([], DOCS), MODEL).count() == 0


def test_query_over_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert by_value(op3_piece_encoding(spark, sf).collect()) == by_value([(r.doc_id, *digest(library, r.text)) for r in docs])


def test_spans_cover_the_source(spark, library):
    rows = [r for r in odd_texts() if len(r[1] or "") < 10000]
    for row in P.encode(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], DOCS), MODEL).collect():
        raw = (rows[row.doc_id][1] or "").encode()
        assert row.ids == library.encode(raw.decode())
        if raw:
            assert row.begins[0] == 0 and row.ends[-1] == len(raw)
            assert row.ends[:-1] == row.begins[1:]
            for i, a, b in zip(row.ids, row.begins, row.ends, strict=True):
                if not library.is_byte(i):
                    assert raw[a:b].decode().replace(" ", "▁") == library.id_to_piece(i)[a == 0:] or a == 0


def test_decode_round_trip(spark):
    rows = [(1, "plain words, and more."), (2, "日本語 😀"), (3, None)]
    encoded = P.encode(spark.createDataFrame(rows, DOCS), MODEL)
    assert {r.doc_id: r.text for r in P.decode(encoded, MODEL).collect()} == {1: rows[0][1], 2: rows[1][1], 3: ""}


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_equals_the_library(rule):
    ours = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = P.Normalizer.of_model(ours.serialized_model_proto())
    for text in ["ﬁ①  ｱ a", "  lead  trail  ", "ｶﾞ x　y", "é á", "​z\ttab", "①①  ", "ÀÉ ß ＡＢＣ", "   ", "", "Ⅷ ㍿ ½"]:
        want, offsets = ours.normalize(text, with_offsets=True)
        got, origin = spec(text)
        assert got.decode() == want
        # The library counts characters, we count bytes of both texts.
        starts = [len(text[:k].encode()) for k in range(len(text) + 1)]
        at = [len(want[:k].encode()) for k in range(len(want) + 1)]
        assert [origin[k] for k in at] == [starts[o] for o in offsets]
