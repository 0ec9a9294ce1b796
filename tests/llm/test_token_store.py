import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from asofia.llm import token_store as S
from asofia.llm.common import work_dir
from asofia.llm.tokens import default_path, library_encoder

from .helpers import bag, documents, odd


def plain_ids(path=None):
    t = Tokenizer.from_file(path or default_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64).astype("<u4")
    data = S.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (S.unpack(data, 1001, bits) == ids).all()


@pytest.mark.parametrize("bits,block", [(16, 64), (13, 64), (13, 7)])
def test_random_access(bits, block):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 2**bits, n).astype("<u4") for n in (0, 5, 63, 64, 65, 400, 1, 0)]
    f = S.TokenFile(b"".join(S.encode_file([3, None, 4, 5, 6, 7, 8, 9], [d.tobytes() for d in docs], bits, block)))
    assert f.doc_ids == [3, None, 4, 5, 6, 7, 8, 9]
    for k, d in enumerate(docs):
        assert (f.document(k) == d).all()
    flat = np.concatenate(docs)
    for a, b in ((0, 1), (62, 66), (130, 133), (0, len(flat)), (10, 10)):
        assert (f.ids(a, b) == flat[a:b]).all()


def test_stretches_equal_whole_texts():
    e = library_encoder(default_path("byte_bpe_50k.json"))
    plain = plain_ids()
    texts = ["", " a", "a ", "a  b", "\n", "a\n\nb", "a\n b", "it's 'll '", "<|endoftext|> a", "日本 語", "a\tb", "é\n", "a   b c", "one two\nthree", "x" * 500]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.many(texts * 2)] == [plain(t) for t in texts] * 2


def test_store(spark):
    docs = odd(documents(spark))
    got = S.read_tokens(spark, S.write_tokens(docs, work_dir(spark, "t"), file_ids=50)).collect()
    plain = plain_ids()
    want = sorted((r.doc_id is not None, r.doc_id or 0, *(len(x := np.array([*plain(r.text), 2], "<u4")), zlib.crc32(x.tobytes()))) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id


def test_no_rows(spark):
    assert bag(S.read_tokens(spark, S.write_tokens(documents(spark, []), work_dir(spark, "t")))) == []


def test_packing_in_groups_of_blocks(monkeypatch):
    monkeypatch.setattr(S, "TOGETHER", 64)
    rng = np.random.default_rng(1)
    for bits, block in ((17, 16), (17, 24), (16, 16), (5, 7), (19, 8)):
        for n in (0, 1, 15, 16, 17, 1000):
            ids = rng.integers(0, 1 << bits, n).astype("<u4")
            f = S.TokenFile(b"".join(S.encode_file([1], [ids.tobytes()], bits, block)))
            assert (f.document(0) == ids).all() and (f.ids(n // 3, n) == ids[n // 3 :]).all()


def test_files_that_split_otherwise_are_encoded_whole(tmp_path):
    import json

    from tokenizers import Tokenizer

    from asofia.llm import tokens

    path = tokens.default_path("byte_bpe_50k.json")
    spec = json.loads(open(path).read())
    assert tokens.cuttable(spec)
    texts = ["a,\nb c.\n\nd", "it's 12 o'clock now", "", "x  y"]
    for name, change in (("prefix", {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}), ("lower", {"normalizer": {"type": "Lowercase"}})):
        other = spec | change
        assert not tokens.cuttable(other)
        file = str(tmp_path / f"{name}.json")
        open(file, "w").write(json.dumps(other))
        want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
        assert tokens.library_encoder(file).many(texts) == [b"" if not t else w for t, w in zip(texts, want)]
