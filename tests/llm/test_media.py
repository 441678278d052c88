import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from framewright.llm import flac

from .helpers import documents, frame


def padded(text):
    b = (text or "").encode()
    return b + b"\xff" * ((-len(b)) % 576 if b else 576)


def samples():
    rng = np.random.default_rng(1)
    raw = [
        b"a" * 576, bytes(rng.integers(0, 256, 5760, dtype=np.uint8)), (np.arange(5760) % 256).astype(np.uint8).tobytes(), b"\x00" * 288 + b"\xff" * 288,
        bytes(rng.choice([0, 255], 5760).astype(np.uint8)), (128 + 100 * np.sin(np.arange(5760) / 5)).astype(np.uint8).tobytes(), b"\x80" * 575 + b"\x00", bytes([128] * 300 + [0] * 5 + [128] * 271),
        (b"plain text, quite like any other. " * 200)[: 576 * 9],
    ]
    return raw


def test_round_trip():
    raw = samples()
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    media = flac.encode_many(at, np.frombuffer(b"".join(raw), np.uint8))
    assert flac.decode_many(media) == raw
    assert media[5] == flac.encode_many(np.array([0, len(raw[5])]), np.frombuffer(raw[5], np.uint8))[0]
    assert len(media[0]) < 100
    assert len(media[5]) < len(raw[5])


def test_many_frames_have_long_numbers():
    raw = bytes(np.random.default_rng(2).integers(60, 70, 576 * 2100, dtype=np.uint8))
    assert flac.decode_many(flac.encode_many(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))) == [raw]


@pytest.mark.parametrize("place", [-1, -300, -900, 30])
def test_damage_is_found(place):
    raw = samples()[8]
    media = bytearray(flac.encode_many(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))[0])
    media[place] ^= 4
    with pytest.raises(ValueError, match="FLAC"):
        flac.decode_many([bytes(media)])


def test_linear_and_fixed_predictors_are_used():
    kinds = set()
    for raw in samples():
        s = flac.encode_many(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))[0]
        body = 46 + int.from_bytes(s[43:46], "big")
        kinds.add(s[body + 6] >> 1)
    assert {0, 1} < kinds
    assert any(8 <= k < 32 for k in kinds)
    assert any(k >= 32 for k in kinds)


def test_features(spark):
    got = Counter(tuple(r)[:5] for r in flac.features(flac.to_media(frame(spark))).collect())
    want = Counter((r[0], len((r[1] or "").encode()), len(padded(r[1])), hashlib.sha256(padded(r[1])).hexdigest(), zlib.crc32(padded(r[1])[-32:])) for r in documents())
    assert got == want
    assert flac.features(flac.to_media(frame(spark, []))).count() == 0


def test_blocks_are_seekable(spark):
    rows = [r for r in documents() if r[0] is not None][:10]
    blocks = flac.pcm_blocks(flac.to_media(frame(spark, rows))).orderBy("doc_id", "sample_offset").collect()
    for r in rows:
        own = [b for b in blocks if b["doc_id"] == r[0]]
        assert [b["sample_offset"] for b in own] == list(range(0, len(padded(r[1])), 576))
        assert b"".join(bytes(b["pcm"]) for b in own) == padded(r[1])


def test_runs_and_seeks():
    rng = np.random.default_rng(5)
    raw = [bytes(rng.integers(60, 70, 576 * n, dtype=np.uint8)) for n in (1, flac.LOT - 3, 5, 2 * flac.LOT + 7, 2)]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    media = flac.encode_many(at, np.frombuffer(b"".join(raw), np.uint8))
    assert flac.decode_many(media) == raw
    assert media[3] == flac.encode_many(np.array([0, len(raw[3])]), np.frombuffer(raw[3], np.uint8))[0]
    assert all(len(pcm) <= flac.LOT * 576 for _, _, pcm in flac.decode_runs(media))
    damaged = bytearray(media[3])
    damaged[-5] ^= 1
    for first, count in ((0, 1), (575, 2), (576 * flac.LOT - 1, 1200), (1_000_000, 3000), (len(raw[3]) - 10, 50), (len(raw[3]), 5), (7, 0)):
        assert flac.read_samples(media[3], first, count) == raw[3][first : first + count]
    # A damaged end does not hinder a read in the middle: only the frames asked for are decoded.
    assert flac.read_samples(bytes(damaged), 1_000_000, 3000) == raw[3][1_000_000:1_003_000]
    with pytest.raises(ValueError, match="FLAC"):
        flac.read_samples(bytes(damaged), len(raw[3]) - 10, 5)


def test_features_of_long_texts(spark):
    text = "plain text, quite like any other. " * 60_000
    rows = [(i, t, "en", "s", 1, "", 1, "") for i, t in enumerate([text, "short", text + "!"])]
    got = {r["doc_id"]: r for r in flac.features(flac.to_media(frame(spark, rows))).collect()}
    for r in rows:
        x = np.frombuffer(padded(r[1]), np.uint8)
        want = f"blocks={len(x) // 576} sum={int(x.sum(dtype=np.int64))} crossings={int(np.count_nonzero((x[1:] < 128) != (x[:-1] < 128)))}"
        assert got[r[0]]["feature"] == want
        assert got[r[0]]["payload_sha256"] == hashlib.sha256(padded(r[1])).hexdigest()


def test_memory_stays_in_step_with_one_copy():
    import subprocess
    import sys

    code = """
import resource, numpy as np
from framewright.llm import flac
x = np.frombuffer(b"plain text, quite like any other one. " * (576 * 4600), np.uint8)
x = x[: len(x) // 576 * 576]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
media = flac.encode_many(np.array([0, len(x)]), x)
n = sum(len(pcm) for _, _, pcm in flac.decode_runs(media))
print(n == len(x), len(x), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024)
"""
    done, size, grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert done == "True"
    assert int(size) > 100_000_000
    assert int(grown) < 600_000_000
