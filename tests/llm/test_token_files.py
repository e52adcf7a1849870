import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sievework.llm.token_files import BLOCK, Reader, Writer, decode_blocks, encode_blocks, token_files, write_tokens
from sievework.llm.files import opened
from sievework.llm.tokens import Encoder, worker_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("kind", range(4))
def test_blocks_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = [rng.integers(0, 50_257, n), rng.integers(0, 7, n), np.full(n, 2**32 - 1), np.where(rng.random(n) < 0.03, rng.integers(0, 2**32, n), 700)][kind].astype(np.uint32)
    blocks = encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype(np.int64)
    assert len(blocks) == -(-n // BLOCK) and (decode_blocks(b"".join(blocks), starts) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[::200] = 2**31
    assert len(encode_blocks(ids)[0]) < 1024 * 5 // 8 + 100


def test_memory_of_words_gives_the_library_s_ids(texts):
    more = ["a  b\n\n c \t x", "  ", "x y  \n z ", " lead", "e\u0301 \u0301x", "a\n b", "a \nb", "don't I'LL 'sx", "naïve café — «x» 12 345", "İx ŸA ſ", "a\r\nb", "a\u00a0b"]
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encode = Encoder(public_tokenizers.path(name), spaces)
        every = [t or "" for t in texts] + more
        assert encode(every) == encode.whole(every) == encode(every)


def test_documents(odd, nothing):
    library, want, at = Tokenizer.from_file(PATH), [], 0
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in rows:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_files(odd, PATH, 2).collect()), key=lambda r: r[1]) == want
    assert token_files(nothing, PATH, 2).count() == 0


def test_ranges_through_the_index(odd, tmp_path):
    files = write_tokens(odd, PATH, 2, f"file://{tmp_path}").collect()
    for f in files:
        with opened(f["path"]) as file:
            reader = Reader(file)
            whole = reader.blocks(0, len(reader.starts) - 1)
            last = len(reader.starts) - 2
            assert len(whole) == f["tokens"] and (reader.blocks(last, last + 1) == whole[last * BLOCK:]).all()


def test_a_document_longer_than_a_stride(tmp_path):
    import pyarrow as pa
    path = tmp_path / "x.pfor"
    ids = np.arange(2_500_000, dtype=np.uint32) % 50_000
    writer = Writer(pa.OSFile(str(path), "wb"))
    for k, part in enumerate((ids, ids[:0], ids[:5])):
        writer.add(k if k else None, part.tobytes())
    writer.close()
    found = list(Reader(pa.OSFile(str(path))).documents())
    assert [(k, s, sum(map(len, p))) for k, s, p in found] == [(None, 0, len(ids)), (1, len(ids), 0), (2, len(ids), 5)]
    assert (np.concatenate(found[0][2]) == ids).all()


def test_a_chunk_of_letters_is_one_pre_token(monkeypatch):
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encode = Encoder(public_tokenizers.path(name), spaces)
        assert encode(["Straße naïve plain words plain"]) == encode.whole(["Straße naïve plain words plain"])
        assert not encode.words  # nothing was split, nor kept twice
        assert encode(["plain, it's 12"]) == encode.whole(["plain, it's 12"]) and encode.words


def test_a_word_before_marks_or_a_line_break_is_encoded_once(monkeypatch):
    texts = ["x plain plain, plain.\nplain plain!! plain\nplain, plain", "plain.\nx", "a,\n b", "a\tb.\nc d", "a.\r\nb a,'s 'll, a\n\nb", "é,\né.\n", "Plain, PLAIN"]
    for name, spaces in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        word, seen = Encoder._word, []
        monkeypatch.setattr(Encoder, "_word", lambda self, w: seen.append(w) or word(self, w))
        encode = Encoder(public_tokenizers.path(name), spaces)
        assert encode(texts[:1]) == encode.whole(texts[:1])
        assert sorted(w for w in seen if "plain" in w) == ([" plain", "plain"] if spaces else ["plain"])
        monkeypatch.undo()
        assert encode(texts) == encode.whole(texts) == encode(texts)


def test_what_is_met_again_outlives_a_generation():
    encode, seen = Encoder(PATH, True, 20), []
    word = encode._word
    encode._word = lambda w: seen.append(w) or word(w)
    for k in range(0, 520, 13):
        new = " ".join(chr(97 + j % 26) * (2 + j // 26) for j in range(k, k + 13))
        assert encode([f"x often {new}"]) == encode.whole([f"x often {new}"])
        assert len(encode.chunks) <= 10 + 14 and len(encode.chunks.older) <= 10 + 14
    assert seen.count(" often") == 1 and len(seen) == 522


def test_the_tasks_of_a_job_share_an_encoder_in_a_worker():
    first = worker_encoder(PATH, True, 100, "job")
    first(["a word"])
    assert worker_encoder(PATH, True, 100, "job") is first and first.chunks
    assert not worker_encoder(PATH, True, 100, "another").chunks
