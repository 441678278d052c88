import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from framewright.llm import bpe
from framewright.llm.token_store import Bounds, lookup, pack_bounds, read_store, write_store

from .helpers import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcXYZ éÉßñΣσςİıǅ0123٣²’'\"<|>endoftext.,!?&%$ \t\n\r\x1c\x1f\x85\xa0 　漢字かな한국어éö̀😀👩‍👧\x00�"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def reference(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_encoder_agrees_with_the_library(library):
    encoder, rng = bpe.Encoder(PATH), random.Random(3)
    cases = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    for text in [*cases, "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "x" * 5000, "é" * 3000, "漢" * 999]:
        ids, decoded = reference(library, text)
        assert encoder.encode(text).tolist() == ids
        assert encoder.decode(ids) == decoded


def test_cuts_never_change_ids():
    cut, whole = bpe.Encoder(PATH), bpe.Encoder(PATH, cut=False)
    rng = random.Random(4)
    n = 0
    for _ in range(2000):
        piece = bytes(rng.choice(b"abqzxjk\xc3\xa9\xbf09") for _ in range(12))
        n += len(cut.fragments(piece)) > 1
        assert cut._piece(piece) == whole._piece(piece)
    assert n > 100


def test_digests(spark, library):
    got = Counter(tuple(r) for r in bpe.digests(frame(spark), PATH).collect())
    want = Counter()
    for row in documents():
        ids, decoded = reference(library, row[1])
        want[(row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert got == want
    assert bpe.digests(frame(spark, []), PATH).count() == 0


def test_encode_keeps_columns(spark, library):
    got = bpe.encode(frame(spark), PATH, keep=["doc_id", "size"]).where("doc_id = 1").first()
    assert (got["size"], got["ids"]) == ("z", reference(library, documents()[1][1])[0])


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for ends in ([1], [0, 0, 0], [5, 5, 9], np.cumsum(rng.integers(0, 700, 3000)), np.cumsum(rng.integers(0, 2, 500)), np.array([], np.int64)):
        ends = np.array(ends, np.int64)
        bounds = Bounds(pack_bounds(ends))
        assert [x for lot in bounds.lots() for x in lot.tolist()] == ends.tolist()
        assert [bounds.select(i) for i in range(len(ends))] == ends.tolist()
    assert len(pack_bounds(np.cumsum(rng.integers(0, 700, 3000)))) < 3000 * 2


@pytest.mark.parametrize("block_ids", [1, 500, 1 << 20])
def test_store(spark, library, block_ids):
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in read_store(write_store(frame(spark), PATH, 1, block_ids=block_ids)).collect())
    start, want = 0, []
    for key, text in sorted(((r[0], r[1] or "") for r in documents()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*reference(library, text)[0], 1]
        want.append((start, key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_empty_store(spark):
    assert read_store(write_store(frame(spark, []), PATH, 1)).count() == 0


def test_lookup(spark, library):
    store = write_store(frame(spark), PATH, 1, block_ids=500)
    start = {r["doc_id"]: r["start"] for r in read_store(store).collect()}
    got = lookup(store, [0, 7, 44, 48, 999_999]).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([0, 7, 44, 48])
    for r in got:
        assert (r["start"], r["ids"]) == (start[r["doc_id"]], [*reference(library, documents()[r["doc_id"]][1])[0], 1])


def test_reading_selects_offsets_and_makes_no_table(spark, monkeypatch):
    sizes = []
    own = Bounds.lot
    monkeypatch.setattr(Bounds, "lot", lambda self, j: sizes.append(len(found := own(self, j))) or found)
    record = Bounds(pack_bounds(np.cumsum(np.full(1000, 3))))
    assert sum(len(x) for x in record.lots()) == 1000
    assert max(sizes) == 64
    assert not hasattr(Bounds, "all")


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="only byte-level BPE"):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
