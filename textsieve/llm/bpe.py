"""Byte-level BPE encoding and decoding over Arrow batches.

The rank file becomes a model of the ``tokenizers`` library: bytes are mapped
to printable characters, and each rank's merge is the pair that the lower ranks
leave of it. That gives the same ids as merging by rank (a token's two parts
are fixed by the ranks below it, whatever stands around), and
``ignore_merges`` looks a whole match up first, as rank merging does.

Texts are cut in front of ASCII white space that follows a character that is
no white space. The pattern never matches across such a place, so the parts
encode separately; a part that was seen before is looked up.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import own, read, text_batches, with_results

#: Parts remembered by a Python worker, in two generations, and the longest remembered: they bound its memory.
CACHE_PARTS, CACHE_CHARS = 250_000, 32
#: Parts longer than this in one Encoding would hold much memory; they are rare, so they are encoded one at a time.
PARTS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
OTHER_SPACE = re.compile(r"[^\S \t-\r]")
CAREFUL = re.compile(r"(?<=\S)(?=[ \t-\r])")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level BPE: itself where it prints, else 256 and up."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)}


def read_ranks(lines) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge_of(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that are left of ``token`` when all merges of lower rank are done."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        low = min(((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(rank, 0))
        if low[0] >= rank:
            return None
        parts[low[1]:low[1] + 2] = [parts[low[1]] + parts[low[1] + 1]]
    return parts[0], parts[1]


def model_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A ``tokenizers`` model for the ranks, as JSON (its size is that of the vocabulary file)."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    to = byte_characters()
    text = lambda token: "".join(to[b] for b in token)
    merges = [merge_of(t, r, ranks) for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    model = models.BPE(vocab={text(t): r for t, r in ranks.items()},
                       merges=[(text(a), text(b)) for a, b in filter(None, merges)], ignore_merges=True)
    tok = Tokenizer(model)
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok.to_str()


class Codec:
    """Encoder and decoder of one vocabulary, living in a Python worker."""

    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model)
        back = {c: b for b, c in byte_characters().items()}
        vocab = self.tok.get_vocab()
        self.token_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.decimals = [b"%d," % i for i in range(len(self.token_bytes))]
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        # ids of a part as packed numbers: a fifth of the size of a tuple of them
        self.kind = np.dtype(np.uint16 if len(self.token_bytes) <= 1 << 16 else np.uint32)
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        return CAREFUL.split(text) if OTHER_SPACE.search(text) else PARTS.findall(text)

    def encode_batch(self, texts) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.parts(t) for t in texts]
        if 2 * len(self.seen) > CACHE_PARTS:
            self.older, self.seen = self.seen, {}
        seen, older = self.seen, self.older
        own: dict[str, bytes] = {}  # parts too long to be remembered
        new = []
        for p in {p for parts in cut for p in parts}:
            if p not in seen:
                if p in older:
                    seen[p] = older[p]
                else:
                    new.append(p)
        for at in range(0, len(new), 1000):
            some = new[at:at + 1000]
            for p, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                (seen if len(p) <= CACHE_CHARS else own)[p] = np.array(e.ids, dtype=self.kind).tobytes()
        if own:
            return [np.frombuffer(b"".join([seen[p] if p in seen else own[p] for p in parts]), dtype=self.kind) for parts in cut]
        return [np.frombuffer(b"".join([seen[p] for p in parts]), dtype=self.kind) for parts in cut]

    def decode_bytes(self, ids) -> bytes:
        """The byte table in reverse; a token may end within a character, the whole is what counts."""
        table = self.token_bytes
        return b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])

    def digests(self, ids: np.ndarray) -> tuple[str, str]:
        """SHA-256 of the decimal ids, joined by commas, and of the bytes they decode to."""
        numbers, decimals = ids.tolist(), self.decimals
        return (hashlib.sha256(b"".join([decimals[i] for i in numbers])[:-1]).hexdigest(),
                hashlib.sha256(self.decode_bytes(numbers)).hexdigest())

    def decode(self, ids) -> str:
        """Text of the ids; bytes that form no character (ids cut within one) become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def offsets(self, ids) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points of the text; tokens that share a character all cover it."""
        ends = np.cumsum(self.lengths[np.asarray(ids, dtype=np.int64)]) if len(ids) else np.zeros(0, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ids) else ends
        raw = np.frombuffer(self.decode_bytes(ids), dtype=np.uint8)
        begun = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to and with each byte
        if not len(raw):
            return starts, ends
        return begun[starts] - 1, begun[ends - 1]


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


def load_model(path: str | None = None, pattern: str | None = None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return model_json(read_ranks(f), pattern or public_tokenizers.PATTERN)


def with_tokens(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None,
                offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked for, ``starts`` and ``ends`` (code points).

    ``path`` is the rank file, on the driver; the model built from it goes to the executors as one broadcast value
    of the file's size. Null and empty texts have no ids. No special tokens: their strings are ordinary text. Rows
    are treated one by one, so repeated rows and any other columns stay as they are.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_model(path, pattern))
    schema = "ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")

    @F.pandas_udf(schema)
    def encode(texts: pd.Series) -> pd.DataFrame:
        c = codec(model.value)
        ids = c.encode_batch([t or "" for t in texts])
        out = {"ids": [x.astype(np.int32) for x in ids]}
        if offsets:
            both = [c.offsets(x) for x in ids]
            out |= {"starts": [b[0] for b in both], "ends": [b[1] for b in both]}
        return pd.DataFrame(out)

    df = text_batches(docs).select("*", encode(F.col(text_col)).alias(own("codes")))
    names = ("ids", "starts", "ends") if offsets else ("ids",)
    return with_results(df, docs.columns, {n: F.col(own("codes")).getField(n) for n in names})


def decoded(df: DataFrame, ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with ``decoded``: the bytes of the ids (null ids: null)."""
    model = df.sparkSession.sparkContext.broadcast(load_model(path, pattern))

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        c = codec(model.value)
        return pd.Series([None if x is None else c.decode_bytes(x) for x in ids], dtype=object)

    staged = text_batches(df).select("*", decode(F.col(ids_col)).alias(own("decoded")))
    return with_results(staged, df.columns, {"decoded": F.col(own("decoded"))})


def token_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                  pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, [ids,] ids_sha256, decoded_sha256``: encoding, then decoding of the ids, in one pass over the
    texts. Null and empty texts have no ids; repeated rows stay apart; an empty table gives an empty table."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(path, pattern))
    names = ["n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]

    @F.pandas_udf("n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        c = codec(model.value)
        rows = []
        for at in range(0, len(texts), 256):  # ids of a few texts at a time
            for ids in c.encode_batch([t or "" for t in texts.iloc[at:at + 256]]):
                own = [ids.astype(np.int32)] if with_ids else []
                rows.append((len(ids), *own, *c.digests(ids)))
        return pd.DataFrame(rows, columns=names)

    return text_batches(docs).select(F.col(id_col), digest(F.col(text_col)).alias("d")).select(id_col, "d.*")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: number and digest of its ids, and the digest of what they decode to."""
    return token_digests(read(spark, sf_dir, "documents"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLES: dict[str, str] = {}
