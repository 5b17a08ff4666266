"""Byte-level BPE encoding and decoding over Arrow batches.

The ranks of a vocabulary file become a ``tokenizers`` model: each token's last
merge is found by merging its bytes with all lower ranks.  A text is cut by the
pattern; the model encodes every match alone, written in the byte-to-character
table of byte-level models.  What occurs again takes its ids from bounded
tables (of words and of matches, in two generations each), so the model runs
about once per distinct match of a stretch of text.

Token ids are returned packed, as little-endian unsigned 32-bit integers in a
binary column (:func:`unpack` gives an array).  Offsets count characters: token
lengths give byte positions, and a table from byte to character of the text
maps them; a token that holds part of a character spans that character.
Decoding reverses the byte table; :func:`decode` joins bytes before it reads
characters, so characters split over tokens, or over the pieces in which a long
text is read, come back whole.

No match of the pattern crosses a place between another character and the white
space after it.  Long texts are read in pieces of about ``PIECE_CHARS`` that end
at such places, and a piece without runs of white space is first cut at its
spaces and line feeds, so that the pattern runs on unknown words only.

Defined cases: null text is empty and has no tokens; strings of special tokens
are ordinary text; repeated rows are all returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

PIECE_CHARS = 1 << 18          # a text is encoded in pieces of about this many characters
KNOWN = 1 << 17                # words whose ids a Python worker remembers, per generation
MATCHES = 1 << 16              # and matches
LONGEST = 64                   # longer matches aren't remembered
_CUT = re.compile(r"(?<=\S)(?=\s)")
_RUN = re.compile(r"\s[ \n]")   # white space before a separator


# -- vocabulary --------------------------------------------------------------------

def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def byte_table() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level models:
    itself where it prints, else the next free character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes ``token``: what is left of its bytes after
    all merges of lower rank, lowest first."""
    parts, top = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        pairs = [(ranks.get(a + b, top), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(pairs)
        if rank >= top:
            raise ValueError(f"token {top} can't be reached by merges of lower rank")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def model_json(ranks: dict[bytes, int]) -> str:
    """The ranks as a serialised ``tokenizers`` model."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    chars = byte_table()
    show = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [last_merge(t, ranks) for t in sorted(ranks, key=ranks.__getitem__) if len(t) > 1]
    model = models.BPE(vocab={show[t]: r for t, r in ranks.items()}, merges=[(show[a], show[b]) for a, b in merges])
    out = Tokenizer(model)
    out.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return out.to_str()


# -- one worker's codec ------------------------------------------------------------

class Known(dict):
    """Match -> packed ids; what it lacks it asks the model for.  It holds at most
    ``MATCHES`` matches and as many of the generation before."""

    def __init__(self, model, table: dict[int, str]):
        self.ids, self.table, self.old = model.tokenize, table, {}

    def __missing__(self, match: str) -> bytes:
        packed = self.old.get(match)
        if packed is None:
            shown = match.encode("utf-8").decode("latin-1").translate(self.table)
            packed = struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in self.ids(shown)]) else b""
        if len(match) <= LONGEST:
            if len(self) >= MATCHES:
                self.old = dict(self)
                self.clear()
            self[match] = packed
        return packed


class KnownWords(dict):
    """Packed ids of what stands between single separators: a part stands for
    itself if it begins with a line feed, else for itself after a space."""

    def __init__(self, find, known: Known):
        self.find, self.known, self.old = find, known, {}

    def __missing__(self, part: str) -> bytes:
        packed = self.old.get(part)
        if packed is None:
            shown = part if part[:1] == "\n" else " " + part
            packed = b"".join(map(self.known.__getitem__, self.find(shown)))
        if len(part) <= LONGEST:
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            self[part] = packed
        return packed


class Codec:
    """Encodes and decodes; a Python worker makes one."""

    def __init__(self, model: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(model)
        self.find = regex.compile(pattern).findall
        self.known = Known(self.tokenizer.model, byte_table())
        self.words = KnownWords(self.find, self.known)
        back = {c: b for b, c in byte_table().items()}
        tokens = {i: bytes(back[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        self.lengths = np.zeros(max(tokens, default=0) + 1, np.int64)
        for i, t in tokens.items():
            self.lengths[i] = len(t)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        out = []
        for piece in self.pieces(text):
            if _RUN.search(piece):
                out += map(self.known.__getitem__, self.find(piece))
                continue
            first, *parts = piece.replace("\n", " \n").split(" ")
            out += map(self.known.__getitem__, self.find(first))
            out += map(self.words.__getitem__, parts)
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        ids = np.frombuffer(packed, "<u4")
        out = []
        for at in range(0, len(ids), PIECE_CHARS):
            part = ids[at:at + PIECE_CHARS]
            n = self.lengths[part]
            begin = np.cumsum(n) - n
            out.append(self.flat[np.repeat(self.first[part] - begin, n) + np.arange(n.sum())].tobytes())
        return b"".join(out)

    def offsets(self, text: str, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the character after its last."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1          # the character that a byte belongs to
        ends = np.cumsum(self.lengths[np.frombuffer(packed, "<u4")])
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        return (char[starts], char[ends - 1] + 1) if len(ends) else (starts[:0], ends)

    def text(self, parts: list[bytes]) -> str:
        """The text of packed ids that come in parts; a character may be split over
        parts.  Bytes that aren't UTF-8 become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        return "".join(reader.decode(self.decode(p)) for p in parts) + reader.decode(b"", True)


_READY: dict[int, Codec] = {}


def _codec(model: str, pattern: str) -> Codec:
    if (key := hash((model, pattern))) not in _READY:
        _READY.clear()
        _READY[key] = Codec(model, pattern)
    return _READY[key]


# -- operators ---------------------------------------------------------------------

def encode(df: DataFrame, model: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False, decoded: bool = False) -> DataFrame:
    """``(<id_col>, tokens)`` and on request ``starts, ends`` (character offsets, arrays)
    and ``decoded`` (the bytes that the ids give back)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, pattern)
        for whole in batches:
            for b in _portions(whole):
                texts = ["" if t is None else t for t in b.column(1).to_pylist()]
                ids = [codec.encode(t) for t in texts]
                cols = {id_col: b.column(0), "tokens": pa.array(ids, pa.binary())}
                if offsets:
                    spans = [codec.offsets(t, i) for t, i in zip(texts, ids)]
                    cols |= {"starts": pa.array([s for s, _ in spans], pa.list_(pa.int64())),
                             "ends": pa.array([e for _, e in spans], pa.list_(pa.int64()))}
                if decoded:
                    cols["decoded"] = pa.array(map(codec.decode, ids), pa.binary())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("__bpe_text"))
    more = ", starts array<bigint>, ends array<bigint>" * offsets + ", decoded binary" * decoded
    return rows.mapInArrow(work, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, tokens binary{more}")


def _portions(b: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, about ``most`` text bytes at a time."""
    rows = max(1, min(b.num_rows, int(b.num_rows * most / max(1, b.column(1).nbytes))))
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def decode(df: DataFrame, model: str, pattern: str, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``(<id_col>, text)`` of packed ids; null ids give empty text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, pattern)
        for b in batches:
            texts = [codec.text([t or b""]) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    rows = df.select(F.col(id_col), F.col(tokens_col).alias("__bpe_tokens"))
    return rows.mapInArrow(work, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, text string")


def unpack(tokens: Column) -> Column:
    """Packed ids as an array of longs."""
    # linear in the length: eight hex digits an id, lowest byte first
    each = F.regexp_extract_all(F.hex(tokens), F.lit("(.{8})"), 1)
    return F.transform(each, lambda x: F.conv(
        F.concat(*[F.substr(x, F.lit(at), F.lit(2)) for at in (7, 5, 3, 1)]), 16, 10).cast("long"))


# -- query -------------------------------------------------------------------------

def public_model(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Model and pattern of an installed public vocabulary."""
    import public_tokenizers
    return model_json(read_ranks(public_tokenizers.path(name))), public_tokenizers.PATTERN


def token_digests(df: DataFrame, keep_tokens: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of documents, and on
    request the packed ids, ``tokens``."""
    done = encode(df, *public_model(), decoded=True)
    return done.select("doc_id", (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
                       F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       *["tokens"] * keep_tokens)


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(table(spark, sf, "documents"))
