"""FLAC: lossless storage of byte payloads as 8-bit mono samples, and decoding with every checksum verified.

Encoder and decoder work on all frames of a batch in step: the decoder keeps one bit position per frame and takes one
Rice code from each frame at a time, so NumPy handles thousands of frames per call. Each stream carries a seek table
with a point for every frame; with it all frames decode at once, without it frame after frame of all streams together.

Supported streams: mono, 8 bits, constant, verbatim, fixed and linear-prediction subframes with Rice residuals of any
partition order, escaped partitions included. Others raise an error.

Cases: null and empty texts are a payload of 64 zero bytes; equal texts give equal bytes; repeated rows each get a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import map_batches, materialize, texts

BLOCK, RATE, UNIT = 1024, 8000, 64
PRECISION, SHIFT, LPC_ORDER = 12, 8, 4
#: The format's fixed predictors by order.
FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


@cache
def crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-8 (x^8+x^2+x+1) by byte, and CRC-16 (x^16+x^15+x^2+1) by 16-bit word, made from the polynomials."""
    eight, sixteen = np.arange(256, dtype=np.uint16), np.arange(65536, dtype=np.uint32)
    for _ in range(8):
        eight = np.where(eight & 0x80, (eight << 1) ^ 0x07, eight << 1) & 0xFF
    for _ in range(16):
        sixteen = np.where(sixteen & 0x8000, (sixteen << 1) ^ 0x8005, sixteen << 1) & 0xFFFF
    return eight.astype(np.uint8), sixteen.astype(np.uint16)


def crc8(data: bytes) -> int:
    table, value = crc_tables()[0], 0
    for b in data:
        value = int(table[value ^ b])
    return value


def crc16(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges in step, two bytes at a time; a leading zero byte changes nothing."""
    table = crc_tables()[1]
    order = np.argsort(-sizes, kind="stable")
    at, steps = starts[order] - (sizes[order] & 1), (sizes[order] + 1) // 2
    odd = (sizes[order] & 1).astype(bool)
    value = np.zeros(len(sizes), np.uint16)
    alive = np.searchsorted(-steps, -np.arange(1, int(steps.max(initial=0)) + 1), side="right")
    padded = np.r_[buffer, np.zeros(2, np.uint8)]
    for step, n in enumerate(alive):
        high = padded[at[:n] + 2 * step].astype(np.uint16)
        if step == 0:
            high[odd[:n]] = 0
        value[:n] = table[value[:n] ^ (high << 8 | padded[at[:n] + 2 * step + 1])]
    out = np.empty(len(sizes), np.uint16)
    out[order] = value
    return out


def coded_number(n: int) -> bytes:
    """The header's variable-length frame number, as in UTF-8 extended to 36 bits."""
    if n < 128:
        return bytes([n])
    tail = []
    limit = 0x20
    while n >= limit * 2:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        limit >>= 1 if len(tail) > 1 else 0
        if len(tail) == 1:
            limit = 0x10
    lead = {1: 0xC0, 2: 0xE0, 3: 0xF0, 4: 0xF8, 5: 0xFC, 6: 0xFE}[len(tail)]
    return bytes([lead | n, *reversed(tail)])


@cache
def frame_header(number: int, samples: int) -> bytes:
    whole = samples == BLOCK
    head = bytes([0xFF, 0xF8, (0xA if whole else 0x7) << 4, 0x02]) + coded_number(number) + (b"" if whole else (samples - 1).to_bytes(2, "big"))
    return head + bytes([crc8(head)])


def _lpc(x: np.ndarray) -> np.ndarray:
    """Quantised predictor coefficients of each row, by autocorrelation and the Levinson-Durbin recursion."""
    n = x.shape[1]
    f = x.astype(np.float64)
    r = np.stack([(f[:, : n - k] * f[:, k:]).sum(axis=1) for k in range(LPC_ORDER + 1)], axis=1)
    error = r[:, 0] + 1e-9
    a = np.zeros((len(x), LPC_ORDER))
    for i in range(LPC_ORDER):
        k = (r[:, i + 1] - sum((a[:, j] * r[:, i - j] for j in range(i)), np.zeros(len(x)))) / error
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    limit = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << SHIFT)), -limit, limit).astype(np.int64)


def _pack(ends: list[np.ndarray], values: list[np.ndarray], size: int) -> np.ndarray:
    """Bytes that hold each value in the bits before its end; values of up to 20 bits never overlap, so sums are unions."""
    last = np.concatenate(ends) - 1
    word, full = last >> 5, np.concatenate(values).astype(np.int64) << (31 - (last & 31))
    words = np.bincount(word, full & 0xFFFFFFFF, size // 4 + 1)[: size // 4 + 1]
    high = full >> 32
    spill = np.flatnonzero(high)
    words += np.bincount(word[spill] - 1, high[spill], size // 4 + 1)
    return words.astype(np.uint32).astype(">u4").view(np.uint8)[:size]


def _predict(x: np.ndarray, choice: int, coefficients: np.ndarray) -> np.ndarray:
    """Residuals of a fixed order, or (9) of linear prediction, folded to unsigned."""
    if choice == 9:
        n = x.shape[1]
        e = x[:, LPC_ORDER:] - (sum(coefficients[:, j, None] * x[:, LPC_ORDER - 1 - j : n - 1 - j] for j in range(LPC_ORDER)) >> SHIFT)
    else:
        e = np.diff(x, n=choice, axis=1)
    return (e << 1) ^ (e >> 31)


def _encode_group(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames of equal length: each by the best of the fixed orders 0 to 2, linear prediction, verbatim, constant.

    Their last two bytes are left for the checksum.
    """
    frames, n = x.shape
    x = x.astype(np.int32)
    coefficients = _lpc(x)
    quantised = coefficients.astype(np.int32)
    extra = {0: 0.0, 1: 8 / n, 2: 16 / n, 9: (9 + (8 + PRECISION) * LPC_ORDER) / n}
    cost = np.stack([np.log2(_predict(x, c, quantised).mean(axis=1, dtype=np.float32) + 1) + e for c, e in extra.items()])
    kind = np.array(list(extra))[cost.argmin(axis=0)]
    kind[(x == x[:, :1]).all(axis=1)] = -2
    out: list[bytes] = [b""] * frames
    heads = [frame_header(i, n) for i in numbers]
    todo = [(int(c), np.flatnonzero(kind == c)) for c in np.unique(kind)]
    while todo:
        choice, where = todo.pop()
        own = x[where]
        order = {9: LPC_ORDER, -1: n, -2: 1}.get(choice, choice)
        code = {9: 32 + LPC_ORDER - 1, -1: 1, -2: 0}.get(choice, 8 + choice)
        if choice >= 0:
            u = _predict(own, choice, quantised[where])
            guess = np.clip(np.log2(u.mean(axis=1) + 1).astype(np.int32), 1, 12)
            costs = np.stack([(u >> (guess + d)[:, None]).sum(axis=1) + (1 + guess + d) * (n - order) for d in (-1, 0, 1)])
            k = guess - 1 + costs.argmin(axis=0)
            fits = costs.min(axis=0) + 8 * order < 8 * n
            if not fits.all():
                todo.append((-1, where[~fits]))
                where, own, u, k = where[fits], own[fits], u[fits], k[fits]
                if not where.size:
                    continue
            lengths = (u >> k[:, None]) + (1 + k[:, None])
            total = 18 + 8 * order + (9 + PRECISION * order if choice == 9 else 0) + lengths.sum(axis=1)
        else:
            total = np.full(len(where), 8 + 8 * order)
        m = len(where)
        head_sizes = np.array([len(heads[i]) for i in where])
        sizes = head_sizes + (total + 7) // 8 + 2
        offsets = np.cumsum(sizes) - sizes
        at = (offsets + head_sizes) * 8 + 8
        ends, values = [at], [np.full(m, code << 1)]
        for j in range(order):
            at = at + 8
            ends.append(at)
            values.append(own[:, j] & 0xFF)
        if choice == 9:
            at = at + 9
            ends.append(at)
            values.append(np.full(m, (PRECISION - 1) << 5 | SHIFT))
            for j in range(order):
                at = at + PRECISION
                ends.append(at)
                values.append(coefficients[where, j] & ((1 << PRECISION) - 1))
        if choice >= 0:
            at = at + 10  # coding method 0, partition order 0, the parameter
            ends.append(at)
            values.append(k)
            ends.append((at[:, None] + np.cumsum(lengths, axis=1)).ravel())
            one = (np.int32(1) << k)[:, None]
            values.append((one | (u & (one - 1))).ravel())
        data = _pack(ends, values, int(sizes.sum()))
        head_at = np.repeat(offsets - (np.cumsum(head_sizes) - head_sizes), head_sizes) + np.arange(head_sizes.sum())
        data[head_at] = np.frombuffer(b"".join(heads[i] for i in where), np.uint8)
        raw = data.tobytes()
        for i, a, size in zip(where.tolist(), offsets.tolist(), sizes.tolist(), strict=True):
            out[i] = raw[a : a + size]
    return out


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream per payload (unsigned bytes; the samples are the bytes less 128)."""
    groups: dict[int, list[tuple[int, int]]] = {}
    frames: list[list[bytes]] = []
    for i, p in enumerate(payloads):
        count = -(-len(p) // BLOCK)
        frames.append([b""] * count)
        for j in range(count):
            groups.setdefault(min(BLOCK, len(p) - j * BLOCK), []).append((i, j))
    for n, members in groups.items():
        for s in range(0, len(members), max(1, (2 << 20) // n)):
            part = members[s : s + max(1, (2 << 20) // n)]
            raw = b"".join(payloads[i][j * BLOCK : j * BLOCK + n] for i, j in part)
            x = (np.frombuffer(raw, np.uint8).reshape(len(part), n) ^ 0x80).view(np.int8)
            for (i, j), frame in zip(part, _encode_group(x, [j for _, j in part]), strict=True):
                frames[i][j] = frame
    sizes = np.array([len(f) for own in frames for f in own], np.int64)
    stops = np.cumsum(sizes)
    data = np.frombuffer(b"".join(f for own in frames for f in own), np.uint8).copy()
    check = crc16(data, stops - sizes, sizes - 2)
    data[stops - 2], data[stops - 1] = check >> 8, check & 0xFF
    raw, at = data.tobytes(), 0
    for own in frames:
        for j, f in enumerate(own):
            own[j] = raw[at : at + len(f)]
            at += len(f)
    out = []
    for p, own in zip(payloads, frames, strict=True):
        sizes = [len(f) for f in own]
        md5 = hashlib.md5((np.frombuffer(p, np.uint8) ^ 0x80).tobytes()).digest()
        packed = RATE << 44 | 0 << 41 | 7 << 36 | len(p)
        info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + md5
        points, at = [], 0
        for j, size in enumerate(sizes):
            points.append((j * BLOCK).to_bytes(8, "big") + at.to_bytes(8, "big") + min(BLOCK, len(p) - j * BLOCK).to_bytes(2, "big"))
            at += size
        table = b"".join(points)
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(own))
    return out


class Stream:
    """A stream's metadata: where its frames begin, and its seek points."""

    def __init__(self, data: bytes):
        if data[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, last, self.points = 4, False, []
        while not last:
            last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
            body = data[at + 4 : at + 4 + size]
            if kind == 0:
                packed = int.from_bytes(body[10:18], "big")
                self.block, self.samples, self.md5 = int.from_bytes(body[2:4], "big"), packed & (1 << 36) - 1, body[18:34]
                if packed >> 41 & 7 or (packed >> 36 & 31) != 7:
                    raise ValueError("only mono streams of 8 bits are supported")
            elif kind == 3:
                self.points = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big"), int.from_bytes(body[i + 16 : i + 18], "big")) for i in range(0, size, 18)]
            at += 4 + size
        self.first = at

    def complete(self) -> bool:
        """Whether the seek points name every frame."""
        at = 0
        for sample, _, n in self.points:
            if sample != at:
                return False
            at += n
        return at == self.samples


@cache
def _parse_header(head: bytes) -> tuple[int, int, int]:
    """Samples, frame number and size of a frame header, its CRC-8 verified."""
    if head[0] != 0xFF or head[1] & 0xFE != 0xF8 or head[3] & 0xF0:
        raise ValueError("no frame header, or not mono")
    first, extra = head[4], 0
    number = first
    if first >= 0xC0:
        extra = next(i for i in range(1, 7) if not first & (0x40 >> i))
        number = first & (0x3F >> extra)
    for b in head[5 : 5 + extra]:
        number = number << 6 | b & 0x3F
    at, code = 5 + extra, head[2] >> 4
    if code == 6:
        samples, at = head[at] + 1, at + 1
    elif code == 7:
        samples, at = int.from_bytes(head[at : at + 2], "big") + 1, at + 2
    else:
        samples = 192 if code == 1 else 576 << (code - 2) if code < 6 else 256 << (code - 8)
    at += {12: 1, 13: 2, 14: 2}.get(head[2] & 15, 0)
    if crc8(head[:at]) != head[at]:
        raise ValueError("frame header checksum")
    return samples, number, at + 1


def header_at(data: bytes, at: int) -> tuple[int, int, int]:
    return _parse_header(bytes(data[at : at + 16])) if at + 16 <= len(data) else _parse_header(bytes(data[at:]).ljust(16, b"\0"))


class Bits:
    """Big-endian bit reads at many positions at once."""

    def __init__(self, data: np.ndarray):
        b = np.r_[data, np.zeros(16, np.uint8)].astype(np.uint64)
        n = len(data) + 8
        self.words = np.zeros(n, np.uint64)
        for i in range(8):
            self.words |= b[i : n + i] << np.uint64(56 - 8 * i)
        self.zeros = np.full(65536, 16, np.int64)
        for i in range(16):
            self.zeros[1 << (15 - i) : 1 << (16 - i)] = i

    def window(self, at: np.ndarray) -> np.ndarray:
        """The 57 bits or more that follow each position, at the top of a word."""
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def read(self, at: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        """Up to 57 bits at each position."""
        return (self.window(at) >> np.asarray(64 - np.asarray(width), np.uint64)).astype(np.int64)

    def rice(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unsigned value of the code at each position, and its length."""
        w = self.window(at)
        q = self.zeros[w >> np.uint64(48)]
        if q.max() == 16:
            more = np.flatnonzero(q == 16)
            while more.size:
                step = self.zeros[self.window(at[more] + q[more]) >> np.uint64(48)]
                q[more] += step
                more = more[step == 16]
            w = self.window(at + q)  # from the stop bit on
            low = (w << np.uint64(1)) >> (64 - k).astype(np.uint64)
        else:
            low = (w << (q + 1).astype(np.uint64)) >> (64 - k).astype(np.uint64)
        return (q << k) | np.where(k > 0, low.astype(np.int64), 0), q + 1 + k


def _signed(values: np.ndarray, width: np.ndarray | int) -> np.ndarray:
    half = np.left_shift(1, np.maximum(width, 1) - 1)
    return np.where(width == 0, 0, (values ^ half) - half)


def decode_frames(data: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Samples of the frame at each offset, and where it ends; both checksums of every frame are verified."""
    raw = data.tobytes()
    heads = [header_at(raw, s) for s in starts.tolist()]
    samples = np.array([h[0] for h in heads])
    types = np.array([raw[s + h[2]] >> 1 for s, h in zip(starts.tolist(), heads, strict=True)])
    order = np.lexsort((-samples, types < 8))  # those with residuals first, longest first
    n, begin = samples[order], starts[order]
    at = (begin + np.array([heads[i][2] for i in order])) * 8
    bits = Bits(data)
    frames, longest = len(n), int(n.max())
    kind = types[order]
    if (bits.read(at, 8) & 1).any():
        raise ValueError("wasted bits are not supported")
    at = at + 8
    lpc, fixed, verbatim, constant = kind >= 32, (kind >= 8) & (kind <= 12), kind == 1, kind == 0
    if not (lpc | fixed | verbatim | constant).all():
        raise ValueError("reserved subframe type")
    warm = np.where(lpc, kind - 31, np.where(fixed, kind - 8, np.where(verbatim, n, 1)))
    depth = max(1, int(np.where(lpc | fixed, warm, 0).max()))
    out = np.zeros((depth + longest, frames), np.int32)  # sample t of frame f stands in row depth + t
    for t in range(int(warm.max())):
        f = np.flatnonzero(warm > t)
        out[depth + t, f] = _signed(bits.read(at[f], 8), 8)
        at[f] += 8
    c = np.zeros((depth, frames), np.int32)  # row j: the coefficient of the sample j + 1 steps back
    shift = np.zeros(frames, np.int32)
    f = np.flatnonzero(lpc)
    if f.size:
        precision = bits.read(at[f], 4) + 1
        shift[f] = _signed(bits.read(at[f] + 4, 5), 5)
        at[f] += 9
        for j in range(int(warm[f].max())):
            g = warm[f] > j
            c[j, f[g]] = _signed(bits.read(at[f[g]], precision[g]), precision[g])
            at[f[g]] += precision[g]
    for degree, known in FIXED.items():
        f = np.flatnonzero(fixed & (kind == 8 + degree))
        for j, value in enumerate(known if f.size else []):
            c[j, f] = value
    coded = lpc | fixed
    method = np.where(coded, bits.read(at, 2), 0)
    if (method > 1).any():
        raise ValueError("reserved residual coding")
    parts = np.where(coded, bits.read(at + 2, 4), 0)
    at = at + np.where(coded, 6, 0)
    length = np.maximum(n >> parts, 1)
    width = np.where(method == 1, 5, 4)
    k, escaped, raw_widths = np.zeros(frames, np.int64), np.zeros(frames, bool), False
    plain = bool((parts == 0).all())
    sizes = n[: int(coded.sum())]
    longest_coded = int(sizes.max(initial=0))
    backwards = np.arange(depth - 1, -1, -1)
    for t in range(longest_coded):
        m = int(np.searchsorted(-sizes, -t, side="left"))  # the first m frames are longer than t
        live = np.flatnonzero(warm[:m] <= t) if t < depth else slice(0, m)
        if t < depth and not live.size:
            continue
        if not plain or t <= depth:
            some = np.arange(m)[live]
            new = some[(t % length[some] == 0) | (t == warm[some])]
            if new.size:
                k[new] = bits.read(at[new], width[new])
                at[new] += width[new]
                escaped[new] = k[new] == (1 << width[new]) - 1
                e = new[escaped[new]]
                k[e] = bits.read(at[e], 5)
                at[e] += 5
            raw_widths = bool(escaped[:m].any())
        p, kl = at[live], k[live]
        u, used = bits.rice(p, kl)
        e = (u >> 1) ^ -(u & 1)
        if raw_widths:
            e = np.where(escaped[live], _signed(bits.read(p, kl), kl), e)
            used = np.where(escaped[live], kl, used)
        at[live] = p + used
        guess = (c[:, live] * out[t + backwards][:, live]).sum(axis=0) if depth > 1 else c[0, live] * out[t, live]
        out[depth + t, live] = (guess >> shift[live]) + e
    f = np.flatnonzero(constant)
    out[depth:, f] = out[depth, f]
    ends = (at + 7) // 8
    if (crc16(data, begin, ends - begin) != (data[ends].astype(np.uint16) << 8 | data[ends + 1])).any():
        raise ValueError("frame checksum")
    by_frame = np.ascontiguousarray(out[depth:].T)
    result: list[np.ndarray] = [by_frame[0]] * frames
    stop = np.empty(frames, np.int64)
    for place, i in enumerate(order.tolist()):
        result[i] = by_frame[place, : n[place]]
        stop[i] = ends[place] + 2
    return result, stop


def decode(streams: list[bytes]) -> list[list[tuple[int, int, bytes]]]:
    """PCM blocks ``(first sample, offset of the frame, unsigned bytes)`` of each stream; MD5s are verified too."""
    infos = [Stream(s) for s in streams]
    data = np.frombuffer(b"".join(streams) + b"\0\0\0\0", np.uint8)
    bases = np.cumsum([0, *[len(s) for s in streams[:-1]]]).tolist() if streams else []
    blocks: list[list[tuple[int, int, bytes]]] = [[] for _ in streams]
    byte = lambda x: ((x & 0xFF).astype(np.uint8) ^ 0x80).tobytes()
    known = [(i, sample, info.first + offset) for i, info in enumerate(infos) if info.complete() for sample, offset, _ in info.points]
    if known:
        found, _ = decode_frames(data, np.array([bases[i] + o for i, _, o in known]))
        for (i, sample, offset), x in zip(known, found, strict=True):
            blocks[i].append((sample, offset, byte(x)))
    todo = [(i, info.first, 0) for i, info in enumerate(infos) if not info.complete() and info.samples]
    while todo:
        found, ends = decode_frames(data, np.array([bases[i] + o for i, o, _ in todo]))
        following = []
        for (i, offset, sample), x, end in zip(todo, found, ends.tolist(), strict=True):
            blocks[i].append((sample, offset, byte(x)))
            if sample + len(x) < infos[i].samples:
                following.append((i, end - bases[i], sample + len(x)))
        todo = following
    for info, own in zip(infos, blocks, strict=True):
        pcm = np.frombuffer(b"".join(b for _, _, b in own), np.uint8) ^ 0x80
        if any(info.md5) and hashlib.md5(pcm.tobytes()).digest() != info.md5:
            raise ValueError("audio checksum")
    return blocks


def payload(text: str) -> bytes:
    """The text's UTF-8 bytes with zeros up to a positive multiple of 64."""
    raw = text.encode()
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media`` with each text's payload as a FLAC stream."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column(1).to_pylist()
        return pa.record_batch([batch.column(0), pa.array([len(t.encode()) for t in rows], pa.int64()), pa.array(encode([payload(t) for t in rows]), pa.binary())], ["doc_id", "n_bytes", "media"])

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, n_bytes long, media binary", limit=2 << 20)


def pcm_blocks(media: DataFrame) -> DataFrame:
    """``doc_id, block, first_sample, frame_offset, pcm``: the decoded blocks, to be sought by ``first_sample``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(d, j, *b) for d, own in zip(batch.column(0).to_pylist(), decode(batch.column(1).to_pylist()), strict=True) for j, b in enumerate(own)]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], ["doc_id", "block", "first_sample", "frame_offset", "pcm"])

    return map_batches(media.select("doc_id", "media"), run, "doc_id long, block int, first_sample long, frame_offset long, pcm binary", limit=2 << 20)


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks int"


def describe(ids: list, sizes: list, stored: list[bytes]) -> pa.RecordBatch:
    """Digests and signal features (mean, root mean square, zero crossings) of what each stored stream decodes to."""
    out = []
    for doc, size, m, own in zip(ids, sizes, stored, decode(stored), strict=True):
        raw = b"".join(b for _, _, b in own)
        x = np.frombuffer(raw, np.uint8).astype(np.int32) - 128
        feature = f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};crossings={int(((x[1:] < 0) != (x[:-1] < 0)).sum())}"
        out.append((doc, size, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(), feature, len(own)))
    names = [f.split()[0] for f in FEATURES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def features(media: DataFrame) -> DataFrame:
    """``describe`` for a stored table of streams."""
    return map_batches(media.select("doc_id", "media", "n_bytes"), lambda b: describe(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(1).to_pylist()), FEATURES)


def media_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text's payload as a FLAC stream in the shared folder and describes what the stored bytes decode to."""
    return features(materialize(store(df, id_col, text_col), "media"))
