"""Operator 2: BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never end up inside a token, so text can be
cut between its two bytes with certainty. White space occurs in no token of this vocabulary: texts
fall apart into chunks, chunks into the pre-tokenizer's pieces, and pieces into fragments at the
pairs found in the vocabulary. Each fragment is encoded on its own and the ids are concatenated.
Chunks and pieces repeat, so each worker keeps the ids of those it has met (bounded in number).

Files with another normaliser, pre-tokenizer or decoder raise ValueError.

Null and empty texts have no ids and decode to the empty string. Rows are independent of each
other: repeated rows, null ids and extra columns need no special treatment.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries that a worker keeps of each cache before it starts afresh.
CACHE_ENTRIES = 300_000
#: Chunks longer than this are encoded anew each time.
CACHED_CHARS = 64
#: Separators that str.split() honours and the tokenizer's white-space class does not.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Chunks of these characters are composed already, and their lower case and pieces are plain to see.
_COMMON = re.compile("[!-~À-ÖØ-öø-įĲ-ňŊ-ž]+")
_PROSE = re.compile("[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž., \n]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[!-/:-@\\[-`{-~]+")
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")

#: The normaliser, pre-tokenizer, decoder and model of the files that ``Encoder`` handles.
_HANDLED = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    None,
    "BPE",
)


def _byte_chars() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character; this maps them back."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Ids of parts of texts: what is not known is made, and kept unless it is long."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, part: str) -> bytes:
        raw = self.make(part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[part] = raw
        return raw


class Encoder:
    """Encodes and decodes with one tokenizer file of the `tokenizers` library."""

    def __init__(self, path: str, cut: bool = True) -> None:
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if (spec["normalizer"], spec["pre_tokenizer"], spec["decoder"], model["type"]) != _HANDLED:
            raise ValueError(f"{path}: only byte-level BPE with NFC, one space, lower case, word pieces and no decoder is handled")
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.last = models.BPE(model["vocab"], merges, end_of_word_suffix=self.suffix or None)
        self.inner = models.BPE(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.to_byte = _byte_chars()
        self.to_char = {b: c for c, b in self.to_byte.items()}  # for str.translate of Latin-1 text
        self.size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.width = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.tokens = [""] * self.size
        for token, i in (model["vocab"] | self.special).items():
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(self.size)]
        self.code = "H" if self.width is np.uint16 else "I"
        inside = bytearray(1 << 16)
        for token in model["vocab"]:
            if token not in self.special:
                for a, b in pairwise(token.removesuffix(self.suffix) if self.suffix else token):
                    inside[self.to_byte[a] << 8 | self.to_byte[b]] = 1
        self.inside = bytes(inside) if cut else b"\1" * (1 << 16)
        letters = [*range(65, 91), *range(97, 123)]
        pairs = [bytes((a, b)) for a in letters for b in letters if not self.inside[a << 8 | b]]
        # One branch for each first letter: the class of seconds that never follow it inside a token.
        by_first = {p[:1]: b"".join(q[1:] for q in pairs if q[:1] == p[:1]) for p in pairs}
        self.plain_cut = re.compile(b"|".join(a + b"[" + rest + b"]" for a, rest in by_first.items()) or b"(?!)")
        self._chunks = Known(self._chunk)
        self._pieces = Known(lambda piece: self._piece(piece.encode()))

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece cut wherever no token can reach across."""
        if piece.isalpha() and self.plain_cut.search(piece) is None:  # isalpha() of bytes: ASCII letters alone
            return [piece]
        inside = self.inside
        at = [i for i, (a, b) in enumerate(pairwise(piece), 1) if not inside[a << 8 | b]]
        if not at:
            return [piece]
        return [piece[a:b] for a, b in pairwise([0, *at, len(piece)])]

    def _piece(self, piece: bytes) -> bytes:
        *first, final = self.fragments(piece)
        ids: list[int] = []
        for part in first:
            ids += [t.id for t in self.inner.tokenize(part.decode("latin-1").translate(self.to_char))]
        ids += [t.id for t in self.last.tokenize(final.decode("latin-1").translate(self.to_char))]
        return array(self.code, ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space."""
        if _COMMON.fullmatch(chunk):
            pieces = _PIECES.findall(chunk.lower())
        else:
            mapped = self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(chunk))
            pieces = [bytes(map(self.to_byte.__getitem__, p)).decode() for p, _ in mapped]
        return b"".join(map(self._pieces.__getitem__, pieces))

    def forget(self) -> None:
        """Give back the memory of what was met; the worker may go on to other work."""
        self._chunks.clear()
        self._pieces.clear()

    def _plain(self, text: str) -> bytes:
        if _PROSE.fullmatch(text) and not any(run in text for run in ("..", ",,", ".,", ",.")):
            # Letters, single points and single commas: the pieces are plain to see.
            pieces = text.lower().replace(".", " . ").replace(",", " , ").split()
            return b"".join(map(self._pieces.__getitem__, pieces))
        odd = any(c in text for c in _NOT_SPACE)
        chunks = [c for c in _SPACES.split(text) if c] if odd else text.split()
        return b"".join(map(self._chunks.__getitem__, chunks))

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text and self.special:
            raw = b"".join(
                np.array([self.special[part]], self.width).tobytes() if part in self.special else self._plain(part)
                for part in self.split_special.split(text)
            )
        else:
            raw = self._plain(text)
        return np.frombuffer(raw, self.width)

    def decode(self, ids: list[int]) -> str:
        """As the library's decode: this file has no decoder, so tokens are joined by a space."""
        return " ".join(map(self.tokens.__getitem__, ids))


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encode(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array of int) of every row's whole text."""
    keep = keep or []
    picked = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:-1]), "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = [enc.encode(t).astype(np.int32) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.list_(pa.int32()))], [*keep, "ids"])

    return picked.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded back."""
    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        numbers = enc.numbers.__getitem__
        for batch in batches:
            count, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = enc.encode(text.as_py()).tolist()
                count.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(numbers, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        enc.forget()

    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
