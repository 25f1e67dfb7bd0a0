import hashlib
import random

import public_tokenizers as P
import tiktoken

from textsieve.llm import bpe

from .data import EDGES, documents, table

HARD = ["a  b", "x  y", "tab\t\tnew\n\n line\r\n", "can't I'LL we've", "  lead", "trail   ", "\x1c\x1d !\x1c ?", "aaaaaaaaaaaaaaaaaaaa",
        "=" * 300, " " * 300 + "x", "日本語テキスト", "🙂🙂 family 👨‍👩‍👧", "Ⅷ ² ½ 12345678901234567890", "é combining", "<|endoftext|>", "　全角 空白",
        "word" * 20000, "mixed\x85line sep", "क्षत्रिय 한국어 ไทย"]


def encoder():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(f), special_tokens={})


def test_ids_equal_rank_merging():
    enc, codec = encoder(), bpe.Codec(bpe.load_model())
    rng = random.Random(0)
    alphabet = "ab eé\n\t   1'!日🙂\x1c"
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for t, ids in zip(texts, codec.encode_batch(texts)):
        assert ids.tolist() == enc.encode_ordinary(t), t
        assert codec.decode_bytes(ids) == t.encode() and codec.decode(ids) == t
    # ids cut within a character
    ids = codec.encode_batch(["🙂"])[0]
    assert len(ids) > 1 and "�" in codec.decode(ids[:1])


def test_offsets():
    codec = bpe.Codec(bpe.load_model())
    for t in HARD:
        ids = codec.encode_batch([t])[0]
        starts, ends = codec.offsets(ids)
        assert ends[-1] == len(t) and starts[0] == 0 and (starts[1:] <= ends[:-1]).all() and (ends > starts).all()
        for i, s, e in zip(ids, starts, ends):
            assert codec.token_bytes[i] in t[s:e].encode()
    assert len(codec.offsets([])[0]) == 0


def test_documents(spark):
    enc = encoder()
    rows = EDGES + documents(4, 10) + [(100 + i, t, None, None, None) for i, t in enumerate(HARD)]
    got = bpe.token_digests(table(spark, rows, ["ids", "e"]), with_ids=True).collect()
    want = []
    for i, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert all(len(r.ids) == r.n_tokens for r in got)
    full = bpe.decoded(bpe.with_tokens(table(spark, rows, ["e", "starts"]), offsets=True))
    for r in full.collect():
        assert bytes(r.decoded).decode() == (r.text or "") and len(r.starts) == len(r.ids) == len(r.ends) and r.e == "mine"
    assert bpe.token_digests(table(spark, [])).collect() == []
