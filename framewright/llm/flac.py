"""Operator 7: FLAC media columns.

The encoder writes native FLAC: one channel of 8-bit samples in blocks of 576, each block coded by
the cheapest of a constant, a verbatim, a fixed-predictor or a linear-predictor subframe with
Rice-coded residuals in four partitions. The seek table names every frame, so the decoder can take
the frames of many streams side by side: it checks each header's CRC-8 and each frame's CRC-16,
decodes the Rice residuals one sample of all frames at a time, runs the predictors, and compares the
stream's MD5. ``pcm_blocks`` gives the samples as rows with their sample offsets, in order;
``read_samples`` decodes the frames around an offset and no others.

Frames do not depend on each other, so both ways go by lots of ``LOT`` frames whatever a text's length:
beside the payload and its stream, memory holds one lot. The decoder reads what the encoder writes (one
channel of 8 bits, blocks of 576, every frame in the seek table); other FLAC raises ValueError.

Null and empty texts are one padded block. Rows are independent: repeated rows, null ids and extra
columns need no special treatment. A stream that fails a checksum raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import buffers, slices

BLOCK = 576
SLICE = 2 << 20
#: Frames that are coded or decoded side by side.
LOT = 2048
_PART_ORDER = 2
_LPC_ORDER = 2
_PRECISION = 12
_SHIFT = 9
#: Fixed values of the format: predictor coefficients by order.
_FIXED = ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])


def _crc_table(width: int, poly: int, length: int) -> np.ndarray:
    """table[d, b]: what byte b with d bytes behind it adds to the checksum."""
    mask, top = (1 << width) - 1, 1 << (width - 1)
    one = []
    for b in range(256):
        c = b << (width - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        one.append(c)
    step = np.array(one, np.uint16)
    rows = [step]
    for _ in range(length - 1):
        last = rows[-1].astype(np.uint32)
        rows.append((((last << 8) & mask) ^ step[last >> (width - 8)]).astype(np.uint16))
    return np.stack(rows)


_CRC8 = _crc_table(8, 0x07, 16)
_CRC16 = _crc_table(16, 0x8005, 1024)


def _crc(table: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of data[start : start + length], none of them empty."""
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    inside = np.arange(int(length.sum())) - np.repeat(first, length)
    behind = np.repeat(length, length) - 1 - inside
    return np.bitwise_xor.reduceat(table[behind, data[np.repeat(start, length) + inside]], first)


def _put(words: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray | int) -> None:
    """Write ``width`` (32 at most) bits of each value from bit ``at``; ``at`` ascends and fields don't overlap."""
    if len(at) == 0:
        return
    wide = value.astype(np.uint64) << (64 - (at & 31) - width).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    target = word[first]
    words[target] |= np.bitwise_or.reduceat(wide >> np.uint64(32), first).astype(np.uint32)
    words[target + 1] |= np.bitwise_or.reduceat(wide & np.uint64(0xFFFFFFFF), first).astype(np.uint32)


def _number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8-like coded frame numbers: (bytes[n, 6], lengths)."""
    out = np.zeros((len(n), 6), np.uint8)
    limits = [1 << 7, 1 << 11, 1 << 16, 1 << 21, 1 << 26]
    size = 1 + np.searchsorted(np.array(limits), n, "right")
    for s in np.unique(size):
        rows = np.flatnonzero(size == s)
        v = n[rows]
        if s == 1:
            out[rows, 0] = v
            continue
        for j in range(s - 1, 0, -1):
            out[rows, j] = 0x80 | (v & 0x3F)
            v = v >> 6
        out[rows, 0] = ((0xFF << (8 - s)) & 0xFF) | v
    return out, size


def _predict(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Second-order linear predictors of each row, quantised: (coefficients, usable)."""
    f = x.astype(np.float64)
    r = [(f[:, : BLOCK - j] * f[:, j:]).sum(axis=1) for j in range(3)]
    det = r[0] * r[0] - r[1] * r[1]
    ok = det > 0
    det = np.where(ok, det, 1.0)
    c = np.stack([(r[1] * (r[0] - r[2])) / det, (r[0] * r[2] - r[1] * r[1]) / det], axis=1)
    q = np.rint(c * (1 << _SHIFT)).astype(np.int64)
    return q, ok & (np.abs(q) < 1 << (_PRECISION - 1)).all(axis=1)


def _zigzag(r: np.ndarray) -> np.ndarray:
    return (r << 1) ^ (r >> 31)


def encode_frames(samples: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """FLAC frames of the rows of ``samples`` (int32[n, 576]): (bytes, lengths)."""
    n = len(samples)
    residual = samples.copy()
    order = np.zeros(n, np.int64)
    best = np.abs(samples).sum(axis=1, dtype=np.int32)
    diff = samples
    for o in (1, 2):
        diff = diff[:, 1:] - diff[:, :-1]
        cost = np.abs(diff).sum(axis=1, dtype=np.int32) + 32 * o
        rows = np.flatnonzero(cost < best)
        best[rows], order[rows] = cost[rows], o
        residual[rows, o:] = diff[rows]
    coef, usable = _predict(samples)
    c = coef.astype(np.int32)
    guess = (c[:, :1] * samples[:, 1:-1] + c[:, 1:] * samples[:, :-2]) >> _SHIFT
    lpc = samples[:, 2:] - guess
    cost = np.abs(lpc).sum(axis=1, dtype=np.int32) + 300
    rows = np.flatnonzero(usable & (cost < best))
    order[rows] = _LPC_ORDER
    residual[rows, _LPC_ORDER:] = lpc[rows]
    is_lpc = np.zeros(n, bool)
    is_lpc[rows] = True
    constant = (samples == samples[:, :1]).all(axis=1)

    coded = _zigzag(residual)
    column = np.arange(BLOCK)
    live = column[None, :] >= order[:, None]
    coded[~live] = 0
    n_parts, width = 1 << _PART_ORDER, BLOCK >> _PART_ORDER
    cells = coded.reshape(n, n_parts, width)
    total = cells.sum(axis=2)
    k = np.clip(np.floor(np.log2(np.maximum(total, 1) / width + 1e-9)), 0, 12).astype(np.int32)
    # Rice's rule of thumb: a parameter one lower pays while the mean is under 1.4 times 2**k.
    k = np.maximum(k - (total < 1.4 * width * (1 << k)), 0).astype(np.int32)
    each_k = np.repeat(k, width, axis=1)
    quotient = coded >> each_k
    length = quotient + each_k + 1
    length[~live] = 0
    bits_head = 8 + 8 * order + np.where(is_lpc, 9 + _PRECISION * _LPC_ORDER, 0) + 6
    body = bits_head + 4 * n_parts + length.sum(axis=1)
    verbatim = ~constant & (body >= 8 + 8 * BLOCK)
    body = np.where(constant, 16, np.where(verbatim, 8 + 8 * BLOCK, body))
    rice = ~(constant | verbatim)

    coded_number, number_len = _number(number)
    head_len = 4 + number_len + 1
    frame_len = head_len + (body + 7) // 8 + 2
    start = np.concatenate([[0], np.cumsum(frame_len)])
    words = np.zeros(int(start[-1]) // 4 + 3, np.uint32)
    at = (start[:-1] + head_len) * 8
    kind = np.where(constant, 0, np.where(verbatim, 1, np.where(is_lpc, 32 | (_LPC_ORDER - 1), 8 | order)))
    rows = np.flatnonzero(rice & is_lpc)
    if len(rows):
        spot = at[rows] + 8 + 8 * _LPC_ORDER
        _put(words, spot, np.full(len(rows), (_PRECISION - 1) << 5 | _SHIFT), 9)
        for j in range(_LPC_ORDER):
            _put(words, spot + 9 + j * _PRECISION, coef[rows, j] & ((1 << _PRECISION) - 1), _PRECISION)
    rows = np.flatnonzero(rice)
    if len(rows):
        if len(rows) < n:
            live, length, coded, quotient, each_k, k = (x[rows] for x in (live, length, coded, quotient, each_k, k))
        spot = at[rows] + bits_head[rows] - 6
        _put(words, spot, np.full(len(rows), _PART_ORDER), 6)
        used = length.reshape(len(rows), n_parts, width)
        part_bits = used.sum(axis=2, dtype=np.int64)
        part_at = (spot + 6)[:, None] + np.concatenate([np.zeros((len(rows), 1), np.int64), np.cumsum(part_bits + 4, axis=1)[:, :-1]], axis=1)
        _put(words, part_at.ravel(), k.ravel(), 4)
        begin = (part_at + 4)[:, :, None] + (np.cumsum(used, axis=2, dtype=np.int32) - used)
        stop = (begin.reshape(len(rows), BLOCK) + quotient)[live]
        kk = each_k[live]
        _put(words, stop, coded[live] & ((1 << kk) - 1) | (1 << kk), kk + 1)
    data = words.astype(">u4").view(np.uint8)[: int(start[-1])]
    head_at = at >> 3
    data[head_at] = kind << 1
    rows = np.flatnonzero(constant)
    data[head_at[rows] + 1] = samples[rows, 0] & 0xFF
    rows = np.flatnonzero(verbatim)
    data[(head_at[rows] + 1)[:, None] + column[None, :]] = samples[rows] & 0xFF
    for o in (1, 2):
        rows = np.flatnonzero(rice & (order >= o))
        data[head_at[rows] + o] = samples[rows, o - 1] & 0xFF
    first = start[:-1]
    for j, b in enumerate((0xFF, 0xF8, 0x29, 0x02)):
        data[first + j] = b
    for j in range(6):
        rows = np.flatnonzero(number_len > j)
        data[first[rows] + 4 + j] = coded_number[rows, j]
    data[first + head_len - 1] = _crc(_CRC8, data, first, head_len - 1)
    check = _crc(_CRC16, data, first, frame_len - 2)
    data[start[1:] - 2], data[start[1:] - 1] = check >> 8, check & 0xFF
    return data, frame_len


def stream(md5: bytes, frames: bytes, lengths: np.ndarray) -> bytes:
    """A FLAC file: stream info, a seek table that names every frame, frames."""
    n = len(lengths)
    info = struct.pack(">HH", BLOCK, BLOCK) + int(lengths.min()).to_bytes(3, "big") + int(lengths.max()).to_bytes(3, "big")
    info += ((44100 << 44) | (0 << 41) | (7 << 36) | (n * BLOCK)).to_bytes(8, "big") + md5
    seek = np.zeros(n, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
    seek["sample"] = np.arange(n) * BLOCK
    seek["offset"] = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    seek["count"] = BLOCK
    table = seek.tobytes()
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + frames


def encode_many(offsets: np.ndarray, data: np.ndarray) -> list[bytes]:
    """Streams of padded payloads data[offsets[i] : offsets[i + 1]]; each length is a multiple of 576."""
    count = np.diff(offsets) // BLOCK
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    coded, sizes = [], []
    for i in range(0, len(number), LOT):
        lot = data[i * BLOCK : (i + LOT) * BLOCK].astype(np.int32).reshape(-1, BLOCK) - 128
        out, size = encode_frames(lot, number[i : i + LOT])
        coded.append(out.tobytes())
        sizes.append(size)
    frames = memoryview(b"".join(coded))
    coded.clear()
    lengths = np.concatenate([np.zeros(0, np.int64), *sizes])
    at = np.concatenate([[0], np.cumsum(lengths)])
    first = np.concatenate([[0], np.cumsum(count)])
    streams = []
    for a, b, i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first[:-1], first[1:], strict=True):
        md5 = hashlib.md5()
        for x in range(a, b, LOT * BLOCK):
            md5.update(data[x : min(b, x + LOT * BLOCK)] ^ 128)
        streams.append(stream(md5.digest(), frames[at[i] : at[j]], lengths[i:j]))
    return streams


class _Bits:
    """Reads bits at one position per frame."""

    def __init__(self, data: np.ndarray) -> None:
        wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.window = np.zeros(len(data) + 1, np.uint64)
        for j in range(8):
            self.window |= wide[j : j + len(data) + 1] << np.uint64(56 - 8 * j)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """64 bits from each position, of which 57 at least are valid."""
        return self.window[np.minimum(at >> 3, len(self.window) - 1)] << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, width: int) -> np.ndarray:
        return (self.peek(at) >> np.uint64(64 - width)).astype(np.int64)


def _signed(value: np.ndarray, width: int) -> np.ndarray:
    return value - ((value >> (width - 1)) << width)


def _rice(bits: _Bits, at: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals of each frame from its coding-method field on: (int64[n, 576], end)."""
    n = len(at)
    out = np.zeros((n, BLOCK), np.int64)
    field = np.where(bits.take(at, 2) == 0, 4, 5)
    part_order = bits.take(at + 2, 4)
    if (BLOCK % (1 << part_order)).any() or (bits.take(at, 2) > 1).any():
        raise ValueError("FLAC residual header is invalid")
    width = BLOCK >> part_order
    at = at + 6
    k = np.zeros(n, np.int64)
    raw = np.zeros(n, np.int64)
    escaped = np.zeros(n, bool)
    for i in range(BLOCK):
        fresh = np.flatnonzero(i % width == 0)
        if len(fresh):
            f = field[fresh]
            k[fresh] = np.where(f == 4, bits.take(at[fresh], 4), bits.take(at[fresh], 5))
            escaped[fresh] = k[fresh] == (1 << f) - 1
            at[fresh] += f
            odd = fresh[escaped[fresh]]
            raw[odd] = bits.take(at[odd], 5)
            at[odd] += 5
        on = i >= order
        window = bits.peek(at)
        lead = 64 - np.frexp((window >> np.uint64(11)).astype(np.float64))[1] - 11
        q = lead.astype(np.int64)
        end = q + 1 + k
        value = (q << k) | ((window >> (64 - np.minimum(end, 63)).astype(np.uint64)).astype(np.int64) & ((1 << k) - 1))
        far = np.flatnonzero(on & ~escaped & ((end > 57) | (q >= 53)))
        for row in far.tolist():
            p = int(at[row])
            while not int(bits.take(np.array([p]), 1)[0]):
                p += 1
            q_row, k_row = p - int(at[row]), int(k[row])
            low = int(bits.take(np.array([p + 1]), k_row)[0]) if k_row else 0
            value[row], end[row] = (q_row << k_row) | low, q_row + 1 + k_row
        signed = (value >> 1) ^ -(value & 1)
        for row in np.flatnonzero(on & escaped).tolist():
            w = int(raw[row])
            signed[row] = int(_signed(bits.take(at[row : row + 1], w), w)[0]) if w else 0
            end[row] = w
        out[:, i] = np.where(on, signed, 0)
        at = at + np.where(on, end, 0)
    return out, at


def decode_frames(data: np.ndarray, start: np.ndarray, length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Samples int16[n, 576] of the frames data[start : start + length], checked."""
    coded, size = _number(number)
    head = 4 + size
    ok = (data[start] == 0xFF) & (data[start + 1] == 0xF8) & (data[start + 2] == 0x29) & (data[start + 3] == 0x02)
    for j in range(6):
        ok &= (size <= j) | (data[start + 4 + np.minimum(j, size - 1)] == coded[:, j])
    if not ok.all() or (_crc(_CRC8, data, start, head) != data[start + head]).any():
        raise ValueError("FLAC frame header is damaged")
    stored = data[start + length - 2].astype(np.uint16) << 8 | data[start + length - 1]
    if (_crc(_CRC16, data, start, length - 2) != stored).any():
        raise ValueError("FLAC frame checksum is wrong")
    bits = _Bits(data)
    at = (start + head + 1) * 8
    kind = bits.take(at, 8) >> 1
    if (bits.take(at, 8) & 0x81).any():
        raise ValueError("FLAC subframe is not supported")
    out = np.zeros((len(start), BLOCK), np.int32)
    end = at + 8
    rows = np.flatnonzero(kind == 0)
    out[rows] = _signed(bits.take(at[rows] + 8, 8), 8)[:, None]
    end[rows] += 8
    rows = np.flatnonzero(kind == 1)
    if len(rows):
        where = (start[rows] + head[rows] + 2)[:, None] + np.arange(BLOCK)[None, :]
        out[rows] = data[where].astype(np.int8)
        end[rows] += 8 * BLOCK
    coded_rows = np.flatnonzero(kind >= 8)
    if len(coded_rows):
        k = kind[coded_rows]
        lpc = k >= 32
        order = np.where(lpc, (k & 31) + 1, k & 7)
        spot = at[coded_rows] + 8
        x = np.zeros((BLOCK, len(coded_rows)), np.int64)
        for j in range(int(order.max(initial=0))):
            rows = np.flatnonzero(order > j)
            x[j, rows] = _signed(bits.take(spot[rows] + 8 * j, 8), 8)
        spot = spot + 8 * order
        coef = np.zeros((32, len(coded_rows)), np.int64)
        shift = np.zeros(len(coded_rows), np.int64)
        precision = np.where(lpc, bits.take(spot, 4) + 1, 0)
        shift[lpc] = _signed(bits.take(spot[lpc] + 4, 5), 5)
        for i in np.unique(precision[lpc]).tolist():
            for j in range(int(order[lpc].max(initial=0))):
                rows = np.flatnonzero(lpc & (precision == i) & (order > j))
                coef[j, rows] = _signed(bits.take(spot[rows] + 9 + i * j, i), i)
        for o, values in enumerate(_FIXED):
            rows = np.flatnonzero(~lpc & (order == o))
            for j, value in enumerate(values):
                coef[j, rows] = value
        residual, stop = _rice(bits, spot + np.where(lpc, 9 + precision * order, 0), order)
        end[coded_rows] = stop
        most = int(order.max(initial=0))
        residual = residual.T.copy()
        for i in range(BLOCK):
            guess = np.zeros(len(coded_rows), np.int64)
            for j in range(min(most, i)):
                guess += coef[j] * x[i - 1 - j]
            x[i] = np.where(i < order, x[i], residual[i] + (guess >> shift))
        out[coded_rows] = x.T
    if ((end + 7) // 8 != start + length - 2).any():
        raise ValueError("FLAC frame length is wrong")
    return out.astype(np.int16)


_SEEK = np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")])


def _layout(s: bytes) -> tuple[int, np.ndarray, bytes]:
    """(place of the first frame, frame offsets from there, MD5) of a stream."""
    if len(s) < 46 or s[:4] != b"fLaC" or s[4] != 0 or s[42] != 0x83:
        raise ValueError("not a FLAC stream with stream info and seek table")
    size = int.from_bytes(s[43:46], "big")
    return 46 + size, np.frombuffer(s, _SEEK, size // 18, 46)["offset"].astype(np.int64), bytes(s[26:42])


def decode_runs(streams: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(stream, sample offset, samples as unsigned bytes) of all streams in order, in runs of ``LOT`` frames at most."""
    starts, lengths, numbers, owners, sums = [], [], [], [], []
    base = 0
    for i, s in enumerate(streams):
        body, offset, md5 = _layout(s)
        sums.append((hashlib.md5(), md5))
        starts.append(base + body + offset)
        lengths.append(np.diff(np.append(offset, len(s) - body)))
        numbers.append(np.arange(len(offset)))
        owners.append(np.full(len(offset), i))
        base += len(s)
    if not streams:
        return
    data = np.frombuffer(streams[0] if len(streams) == 1 else b"".join(streams), np.uint8)
    start, length, number, owner = (np.concatenate(x) for x in (starts, lengths, numbers, owners))
    for a in range(0, len(start), LOT):
        b = min(len(start), a + LOT)
        low = int(start[a])
        x = decode_frames(data[low : int(start[b - 1] + length[b - 1])], start[a:b] - low, length[a:b], number[a:b])
        plain = (x + 128).astype(np.uint8)
        cut = np.concatenate([np.flatnonzero(np.diff(owner[a:b], prepend=-1)), [b - a]])
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            own = int(owner[a + i])
            sums[own][0].update(plain[i:j] ^ 128)
            if (a + j == len(start) or owner[a + j] != own) and sums[own][0].digest() != sums[own][1]:
                raise ValueError("FLAC stream's MD5 is wrong")
            yield own, int(number[a + i]) * BLOCK, plain[i:j].tobytes()


def decode_many(streams: list[bytes]) -> list[bytes]:
    """The stored samples of each stream as unsigned bytes."""
    out: list[list[bytes]] = [[] for _ in streams]
    for i, _, pcm in decode_runs(streams):
        out[i].append(pcm)
    return [b"".join(x) for x in out]


def read_samples(media: bytes, first: int, count: int) -> bytes:
    """Samples [first, first + count) of a stream: only the frames that hold them are decoded."""
    body, offset, _ = _layout(media)
    a, b = first // BLOCK, min(len(offset), -(-(first + count) // BLOCK))
    if first < 0 or count <= 0 or a >= b:
        return b""
    ends = np.append(offset, len(media) - body)
    data = np.frombuffer(media, np.uint8, int(ends[b] - ends[a]), int(body + ends[a]))
    x = decode_frames(data, ends[a:b] - ends[a], np.diff(ends[a : b + 1]), np.arange(a, b))
    return (x + 128).astype(np.uint8).tobytes()[first - a * BLOCK :][:count]


def to_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text's UTF-8 bytes, padded with 255, as a FLAC stream."""
    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            for a, b in slices(offsets, SLICE):
                size = np.diff(offsets[a : b + 1])
                padded = np.maximum(1, -(-size // BLOCK)) * BLOCK
                at = np.concatenate([[0], np.cumsum(padded)])
                buffer = np.full(int(at[-1]), 255, np.uint8)
                for i in range(b - a):
                    buffer[at[i] : at[i] + size[i]] = data[offsets[a + i] : offsets[a + i + 1]]
                media = encode_many(at, buffer)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"]
                )

    return picked.mapInArrow(run, "doc_id long, n_bytes long, media binary")


_BLOCKS = "doc_id long, n_bytes long, media_bytes long, media_sha256 string, n_samples long, sample_offset long, pcm binary"


def pcm_blocks(media: DataFrame, frames: int = 1) -> DataFrame:
    """The decoded samples of each stream as rows of ``frames`` frames at most, in order, each with its sample offset.

    (doc_id, n_bytes, media_bytes, media_sha256, n_samples, sample_offset, pcm); ``frames`` goes up to ``LOT``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

        def rows_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            offsets, _ = buffers(batch.column(2))
            for a, b in slices(offsets, SLICE):
                keys, sizes = (batch.column(i).slice(a, b - a).to_pylist() for i in (0, 1))
                stored = [memoryview(x.as_buffer()).cast("B") for x in batch.column(2).slice(a, b - a)]
                heads = [(k, n, len(m), hashlib.sha256(m).hexdigest(), BLOCK * len(_layout(m)[1])) for k, n, m in zip(keys, sizes, stored, strict=True)]
                rows, held = [], 0
                for i, first, pcm in decode_runs(stored):
                    for x in range(0, len(pcm), frames * BLOCK):
                        rows.append((*heads[i], first + x, pcm[x : x + frames * BLOCK]))
                    held += len(pcm)
                    if held >= SLICE:
                        yield rows_of(rows)
                        rows, held = [], 0
                if rows:
                    yield rows_of(rows)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, _BLOCKS)


def features(media: DataFrame) -> DataFrame:
    """Digests and a feature string (blocks, sum, zero crossings) of what each stream decodes to, from its PCM blocks.

    The blocks of a stream follow each other within a partition, so they are folded as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, total, crossings, last = hashlib.sha256(), 0, 0, None
        for batch in batches:
            rows = []
            for *head, n, first, pcm in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.column(6), strict=True):
                raw = pcm.as_buffer()
                x = np.frombuffer(raw, np.uint8)
                if first == 0:
                    sha, total, crossings, last = hashlib.sha256(), 0, 0, None
                sha.update(raw)
                total += int(x.sum(dtype=np.int64))
                low = x < 128
                crossings += int(np.count_nonzero(low[1:] != low[:-1])) + (last is not None and bool(low[0]) != last)
                last = bool(low[-1])
                if first + len(x) == n:
                    feature = f"blocks={n // BLOCK} sum={total} crossings={crossings}"
                    rows.append((head[0], head[1], n, sha.hexdigest(), zlib.crc32(x[-32:]), head[2], head[3], feature))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return pcm_blocks(media, LOT).mapInArrow(
        run,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
    )
