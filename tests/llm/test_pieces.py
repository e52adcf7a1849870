import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from sievework.llm.pieces import Normalizer, PieceEncoder, encode_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "▁x", "日本語 テスト\n\t☃ 😀", "a\u0000b", "<s> </s> <0x0A>", "\n", "É é\r\n"]


def test_spans_equal_the_library_s():
    encoder = PieceEncoder(PATH)
    for text in ODD:
        pieces = encoder.model.encode(text, return_type="proto").pieces
        assert [tuple(s) for s in encoder.spans(text, encoder.encode([text])[0]).tolist()] == [(p.begin, p.end) for p in pieces], text


def test_compiled_map_equals_the_library_s():
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    spec = proto.normalizer_spec
    assert len(spec.precompiled_charsmap) > 100_000
    own = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
    rng = random.Random(2)
    for _ in range(2000):
        text = "x" + "".join(rng.choice("aé ﬁ①\u3000\t\n½ｶﾞe\u0301한각  Å\u200b日ⅷ™") for _ in range(rng.randint(0, 12)))
        out, origin = own(text.encode())
        want, places = normalizer.normalize(text, with_offsets=True)
        assert out.decode() == want
        chars = np.cumsum([0] + [len(c.encode()) for c in want])
        assert [len(text.encode()[:origin[b]].decode()) for b in chars] == list(places), text


def test_documents(odd, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = {r["doc_id"]: r["text"] or "" for r in odd.filter("doc_id is not null").collect()}
    rows = encode_pieces(odd, PATH).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is None:
            continue
        ids = library.encode(text[r["doc_id"]])
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), library.decode(ids) if ids else "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
        both = np.array([r["begins"], r["ends"]], "<u4").T
        assert r["spans_crc32"] == zlib.crc32(np.ascontiguousarray(both).tobytes())
        if ids:
            assert both[0, 0] == 0 and both[-1, 1] == len(text[r["doc_id"]].encode()) and (both[1:, 0] == both[:-1, 1]).all()
    assert encode_pieces(nothing, PATH).count() == 0
