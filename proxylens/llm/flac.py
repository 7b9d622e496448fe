"""Media columns: 8-bit mono FLAC in a binary column, written and read in batches of many streams.

Frames of a batch are handled side by side: one numpy step advances every frame by a sample, so that
the cost of Python is shared by about a thousand frames. The writer chooses per frame between the
fixed predictors of order 0 to 2, a linear predictor of order 4, and constant or verbatim subframes;
the reader knows all subframe kinds, checks the CRC-8 of every frame header, the CRC-16 of every frame
and the MD5 of the whole signal, and raises ValueError where one fails. Each stream holds a seek table
with a point for every frame.

Null bytes give a null stream; empty ones a stream without frames; null streams decode to null. Payloads of
any length are cut into blocks; a batch holds about BATCH_BYTES of them, or one payload. Equal inputs and
repeated rows give equal streams, so ties need no order. Empty tables give empty tables. Extra columns pass
through; added columns replace clashing ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxylens.llm.common import ship_package

BLOCK, RATE = 4096, 8000
#: Bytes of payload that are handled side by side.
BATCH_BYTES = 2 << 20
#: Frames that are worked on at a time.
GROUP = 1024
ORDER, PRECISION = 4, 12
FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def _table(poly: int, bits: int) -> np.ndarray:
    out = []
    for c in range(256):
        c <<= bits - 8
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) else 0)
            c &= (1 << bits) - 1
        out.append(c)
    return np.array(out, np.uint32)


CRC8, CRC16 = _table(0x07, 8).tolist(), _table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = CRC8[c ^ b]
    return c


def crc16(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-16 of data[start : start + size] for each start."""
    order = np.argsort(-sizes, kind="stable")
    at, most = starts[order], sizes[order]
    crc, live = np.zeros(len(at), np.uint32), len(at)
    for t in range(int(most[0]) if len(most) else 0):
        while most[live - 1] <= t:
            live -= 1
        c = crc[:live]
        crc[:live] = CRC16[(c >> 8) ^ data[at[:live] + t]] ^ ((c << 8) & 0xFFFF)
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _utf8_number(n: int) -> bytes:
    """n as FLAC codes frame numbers: like UTF-8, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    for _ in range(size - 1):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([(0xFF << (8 - size)) & 0xFF | n, *reversed(tail)])


def _predictors(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients of the linear predictor of each frame, and their shift."""
    lags = []
    for lag in range(ORDER + 1):
        y = x[lag:] * x[: len(x) - lag]
        for j in range(lag):  # products that reach into the frame before
            y[first[1:] + (j - lag)] = 0
        lags.append(np.add.reduceat(np.concatenate([np.zeros(lag, x.dtype), y]), first))
    r = np.array(lags, np.float64).T
    system = r[:, np.abs(np.subtract.outer(np.arange(ORDER), np.arange(ORDER)))] + np.eye(ORDER) * (1e-6 * r[:, :1, None] + 1e-3)
    c = np.linalg.solve(system, r[:, 1:, None])[:, :, 0]
    most = np.maximum(np.abs(c).max(1), 1e-9)
    shift = np.clip(PRECISION - 2 - np.ceil(np.log2(most)), 0, 14).astype(np.int32)
    return np.clip(np.round(c * (1 << shift)[:, None]), -(1 << (PRECISION - 1)), (1 << (PRECISION - 1)) - 1).astype(np.int32), shift


def _encode_frames(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The frames' bytes, one after the other, and the size of each."""
    s = data.astype(np.int16) - np.int16(128)
    n = len(s)
    back = np.concatenate([np.zeros(ORDER, np.int16), s])
    back = [back[ORDER - j : ORDER - j + n] for j in range(ORDER + 1)]
    coefs, shift = _predictors(s.astype(np.float32), first)
    guess = np.zeros(n, np.int32)
    for j in range(ORDER):
        guess += np.repeat(coefs[:, j], sizes) * back[j + 1]
    guess >>= np.repeat(shift, sizes)
    delta = s - back[1]
    trials = [s, delta, delta - back[1] + back[2], (s - guess).astype(np.int16)]
    orders = np.array([0, 1, 2, ORDER])
    cost = []
    for r, o in zip(trials, orders, strict=True):
        size = np.abs(r)
        for j in range(o):
            size[first + j] = 0
        cost.append(np.add.reduceat(size, first, dtype=np.int64) + 64 * o)
    kind = np.argmin(cost, 0)
    order = orders[kind]
    r = trials[3]
    for other in range(3):
        own = np.repeat(kind == other, sizes)
        r = np.where(own, trials[other], r)
    u = (r << 1) ^ (r >> 15)
    warm_at = np.concatenate([first[order > j] + j for j in range(ORDER)])
    u[warm_at] = 0
    depth = np.where((sizes % 4 == 0) & (sizes >= 256), 2, 0)
    parts, width = 1 << depth, sizes >> depth
    in_frame = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    part_size = np.repeat(width, parts)
    part_first = np.repeat(first, parts) + in_frame * part_size
    skipped = np.where(in_frame == 0, np.repeat(order, parts), 0)
    mean = np.add.reduceat(u, part_first, dtype=np.int64) / np.maximum(part_size - skipped, 1)
    k = np.maximum(np.floor(np.log2(mean * 0.7 + 1)), np.ceil(np.log2((np.maximum.reduceat(u, part_first) + 1.0) / 40))).astype(np.int16).clip(0, 14)
    ks = np.repeat(k, part_size)
    bits = (u >> ks) + ks + np.int16(1)
    low = (u & ((np.int16(1) << ks) - np.int16(1))) | (np.int16(1) << ks)
    bits[warm_at] = 0
    lead = part_first + skipped  # the first coded sample of a partition follows its parameter
    bits[lead] += 4

    heads = []
    for f in range(len(first)):
        head = bytes([0xFF, 0xF8, 0x74, 0x02]) + _utf8_number(int(numbers[f])) + int(sizes[f] - 1).to_bytes(2, "big")
        head += bytes([crc8(head)])
        o = int(order[f])
        head += bytes([(0x40 if kind[f] == 3 else 0x10) | (o - 1 if kind[f] == 3 else o) << 1])
        head += (s[first[f] : first[f] + o] & 0xFF).astype(np.uint8).tobytes()
        value, size = 0, 0
        if kind[f] == 3:
            value, size = (PRECISION - 1) << 5 | int(shift[f]), 9
            for c in coefs[f].tolist():
                value, size = value << PRECISION | c & ((1 << PRECISION) - 1), size + PRECISION
        value, size = value << 6 | int(depth[f]), size + 6
        heads.append((head, value, size))
    head_bits = np.array([8 * len(h) + size for h, _, size in heads])
    frame_bits = head_bits + np.add.reduceat(bits, first, dtype=np.int64)
    frame_bytes = (frame_bits + 7) // 8 + 2
    frame_at = np.concatenate([[0], np.cumsum(frame_bytes)])
    stream = np.zeros(int(frame_at[-1]) * 8, np.uint8)
    for f, (head, value, size) in enumerate(heads):
        at = int(frame_at[f]) * 8
        raw = head + (value << -size % 8).to_bytes((size + 7) // 8, "big")
        stream[at : at + head_bits[f]] = np.unpackbits(np.frombuffer(raw, np.uint8))[: head_bits[f]]
    ends = np.cumsum(bits, dtype=np.int64)
    ends += np.repeat(frame_at[:-1] * 8 + head_bits - (ends[first] - bits[first]), sizes)
    at = ends[lead] - bits[lead]
    for j in range(4):
        stream[at + 3 - j] = (k >> j) & 1
    stream = np.append(stream, np.zeros(1, np.uint8))
    ends[warm_at] = len(stream)  # the spare place behind the stream takes what warm-up samples would write
    for j in range(int(k.max()) + 1):
        own = slice(None) if (k >= j).all() else np.flatnonzero(ks >= j)
        ends[own] -= 1
        stream[ends[own]] = (low[own] >> j) & 1
        ends[warm_at] = len(stream)
    stream = stream[:-1]
    out = np.packbits(stream)
    check = crc16(out, frame_at[:-1], frame_bytes - 2)
    out[frame_at[1:] - 2], out[frame_at[1:] - 1] = check >> 8, check & 0xFF
    return out, frame_bytes


def _md5_of_signed(parts: Sequence[bytes | np.ndarray]) -> bytes:
    """MD5 of 8-bit samples as signed numbers, taken piece by piece."""
    digest = hashlib.md5()
    for part in parts:
        values = np.frombuffer(part, np.uint8)
        for lo in range(0, len(values), BATCH_BYTES):
            digest.update((values[lo : lo + BATCH_BYTES] ^ 0x80).tobytes())
    return digest.digest()


def encode_many(payloads: Sequence[bytes]) -> list[bytes]:
    """A FLAC stream for each payload of 8-bit samples (byte 128 is silence); tails under 16 samples are allowed only as last block."""
    if not payloads:
        return []
    data = np.frombuffer(b"".join(payloads), np.uint8)
    lengths = np.array([len(p) for p in payloads], np.int64)
    counts = -(-lengths // BLOCK)
    stream_of = np.repeat(np.arange(len(payloads)), counts)
    numbers = np.arange(len(stream_of)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = (np.cumsum(lengths) - lengths)[stream_of] + numbers * BLOCK
    sizes = np.minimum(BLOCK, lengths[stream_of] - numbers * BLOCK)
    bodies, frame_bytes = [], [np.zeros(0, np.int64)]
    for lo in range(0, len(first), GROUP):  # what is worked on at a time does not grow with a payload
        hi = min(lo + GROUP, len(first))
        a, z = int(first[lo]), int(first[hi - 1] + sizes[hi - 1])
        body, own = _encode_frames(data[a:z], first[lo:hi] - a, sizes[lo:hi], numbers[lo:hi])
        bodies.append(body.tobytes())
        frame_bytes.append(own)
    frame_bytes = np.concatenate(frame_bytes)
    raw, ends, out, f = b"".join(bodies), np.concatenate([[0], np.cumsum(frame_bytes)]), [], 0
    bodies.clear()
    for payload, count in zip(payloads, counts.tolist(), strict=True):
        at = ends[f : f + count + 1]
        points = b"".join(int(i * BLOCK).to_bytes(8, "big") + int(at[i] - at[0]).to_bytes(8, "big") + int(sizes[f + i]).to_bytes(2, "big") for i in range(count))
        own = frame_bytes[f : f + count]
        info = BLOCK.to_bytes(2, "big") * 2 + b"".join(int(x).to_bytes(3, "big") for x in ((own.min(), own.max()) if count else (0, 0)))
        info += (RATE << 44 | 7 << 36 | len(payload)).to_bytes(8, "big")
        info += _md5_of_signed([payload])
        table = bytes([0x83]) + len(points).to_bytes(3, "big") + points
        out.append(b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + table + raw[at[0] : at[count]])
        f += count
    return out


def _frame_head(buf: bytes, at: int) -> dict:
    """What stands before the residual of the frame at `at`."""
    if buf[at] != 0xFF or buf[at + 1] & 0xFE != 0xF8:
        raise ValueError("no frame where one is due")
    code, form = buf[at + 2], buf[at + 3]
    if form >> 4 or form >> 1 & 7 not in (0, 1):
        raise ValueError("only 8-bit mono streams are read")
    pos = at + 4
    more = 8 - (buf[pos] ^ 0xFF).bit_length()
    pos += max(more, 1)
    bs = code >> 4
    if bs == 6:
        size, pos = buf[pos] + 1, pos + 1
    elif bs == 7:
        size, pos = int.from_bytes(buf[pos : pos + 2], "big") + 1, pos + 2
    else:
        size = 192 if bs == 1 else 576 << (bs - 2) if bs < 6 else 256 << (bs - 8)
    pos += {12: 1, 13: 2, 14: 2}.get(code & 15, 0)
    if crc8(buf[at:pos]) != buf[pos]:
        raise ValueError("a frame header fails its CRC-8")
    kind = buf[pos + 1] >> 1
    wasted = buf[pos + 1] & 1
    if wasted:
        raise ValueError("wasted bits are not used by 8-bit text streams")
    pos += 2
    out = {"at": at, "size": size, "kind": kind, "order": 0, "coefs": [], "shift": 0, "warm": [], "bit": 8 * pos, "depth": 0}
    if kind < 2:
        return out
    order = kind - 31 if kind >= 32 else kind - 8
    signed = lambda v, bits: v - (v >> (bits - 1) << bits)
    out |= {"order": order, "warm": [signed(b, 8) for b in buf[pos : pos + order]]}
    pos += order
    head, bit = int.from_bytes(buf[pos : pos + 80].ljust(80, b"\0"), "big"), 0

    def take(bits: int) -> int:
        nonlocal bit
        bit += bits
        return head >> (640 - bit) & ((1 << bits) - 1)

    if kind >= 32:
        precision = take(4) + 1
        out["shift"] = signed(take(5), 5)
        out["coefs"] = [signed(take(precision), precision) for _ in range(order)]
    else:
        out["coefs"] = FIXED[order]
    out["method"], out["depth"] = take(2), take(4)
    out["bit"] = 8 * pos + bit
    return out


def _decode_frames(buf: bytes, starts: Sequence[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The samples (as bytes) of the frames at `starts`, and where each ends."""
    heads = [_frame_head(buf, at) for at in starts]
    data = np.frombuffer(buf + bytes(16), np.uint8)
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,)).astype(np.uint64)  # the 8 bytes from each byte on
    out: list = [None] * len(heads)
    ends = np.zeros(len(heads), np.int64)
    coded = sorted((i for i, h in enumerate(heads) if h["kind"] >= 2), key=lambda i: -heads[i]["size"])
    for i, h in enumerate(heads):
        at = h["bit"] // 8
        if h["kind"] == 0:
            out[i], ends[i] = np.full(h["size"], data[at] ^ 0x80, np.uint8), at + 1
        elif h["kind"] == 1:
            out[i], ends[i] = data[at : at + h["size"]] ^ 0x80, at + h["size"]
    if coded:
        of = lambda key, kind=np.int64: np.array([heads[i][key] for i in coded], kind)
        size, order, shift, p, depth, method = of("size"), of("order"), of("shift"), of("bit"), of("depth"), of("method")
        most = int(order.max())
        coefs, warm = np.zeros((most, len(coded)), np.int64), np.zeros((most, len(coded)), np.int64)
        for lane, i in enumerate(coded):
            coefs[: len(heads[i]["coefs"]), lane] = heads[i]["coefs"]
            warm[: order[lane], lane] = heads[i]["warm"]
        wide = 4 + (method == 1)
        width, k, raw = size >> depth, np.zeros(len(coded), np.int64), np.full(len(coded), -1, np.int64)
        s = np.zeros((int(size[0]), len(coded)), np.int64)
        live, plain = len(coded), True

        def bits(at: np.ndarray) -> np.ndarray:
            return words[at >> 3] << (at & 7).view(np.uint64)

        even = bool((width == width[0]).all())
        for t in range(len(s)):
            while size[live - 1] <= t:
                live -= 1
            a = slice(0, live)
            if t <= most or not even or t % width[0] == 0:
                fresh = np.flatnonzero(((t % width[a] == 0) & (t >= order[a])) | (t == order[a]) & (t < width[a]))
                if len(fresh):  # a partition begins: read its parameter
                    b = wide[fresh]
                    k[fresh] = (bits(p[fresh]) >> (64 - b).astype(np.uint64)).astype(np.int64)
                    p[fresh] += b
                    escape = fresh[k[fresh] == (1 << b) - 1]
                    raw[fresh] = -1
                    if len(escape):
                        raw[escape] = (bits(p[escape]) >> np.uint64(59)).astype(np.int64)
                        p[escape] += 5
                    plain = bool((raw < 0).all())
            x = bits(p[a])
            y = (x >> np.uint64(11)).view(np.int64)
            q = 1075 - (y.astype(np.float64).view(np.int64) >> 52)
            if not y.all():  # a run of zeros that is longer than the window
                for lane in np.flatnonzero(y == 0):
                    far = int(p[lane]) + 53
                    while not (w := int(bits(np.array([far]))[0]) >> 11):
                        far += 53
                        if far > 8 * len(buf):
                            raise ValueError("a frame ends early")
                    q[lane] = far - p[lane] + 53 - w.bit_length()
                x = bits(p[a] + q) << np.uint64(1)
            else:
                x = x << (q + 1).view(np.uint64)
            ka = k[a]
            u = q << ka | (x >> np.uint64(1) >> (63 - ka).view(np.uint64)).view(np.int64)
            step = q + 1 + ka
            r = (u >> 1) ^ -(u & 1)
            if not plain:
                for lane in np.flatnonzero(raw[a] >= 0):
                    n = int(raw[lane])
                    v = int(bits(p[lane : lane + 1])[0]) >> (64 - n) if n else 0
                    r[lane], step[lane] = v - (v >> (n - 1) << n) if n else 0, n
            if most:
                guess = coefs[0, a] * s[t - 1, a] if t else np.zeros(live, np.int64)
                for j in range(1, min(most, t)):
                    guess += coefs[j, a] * s[t - 1 - j, a]
                r += guess >> shift[a]
                if t < most:
                    early = t < order[a]
                    r, step = np.where(early, warm[t, a], r), np.where(early, 0, step)
            s[t, a] = r
            p[a] += step
        samples = (s + 128).astype(np.uint8).T
        for lane, i in enumerate(coded):
            out[i], ends[i] = samples[lane, : size[lane]], (p[lane] + 7) // 8
    ends += 2
    begin = np.array(starts, np.int64)
    if (ends > len(buf)).any():
        raise ValueError("a frame ends early")
    check = crc16(data, begin, ends - 2 - begin)
    if ((data[ends - 2].astype(np.uint32) << 8 | data[ends - 1]) != check).any():
        raise ValueError("a frame fails its CRC-16")
    return out, ends


def decode_many(streams: Sequence[bytes]) -> list[list[tuple[int, bytes]]]:
    """For each stream its PCM blocks: sample offset and samples."""
    buf, found, bodies = b"".join(streams), [], []
    at = 0
    for stream in streams:
        if stream[:4] != b"fLaC":
            raise ValueError("no FLAC stream")
        pos, points, info = 4, None, b""
        while True:
            last, kind, size = stream[pos] >> 7, stream[pos] & 0x7F, int.from_bytes(stream[pos + 1 : pos + 4], "big")
            block = stream[pos + 4 : pos + 4 + size]
            if kind == 0:
                info = block
            elif kind == 3:
                points = [(int.from_bytes(block[i : i + 8], "big"), int.from_bytes(block[i + 8 : i + 16], "big")) for i in range(0, size, 18)]
                points = [x for x in points if x[0] != (1 << 64) - 1]
            pos += 4 + size
            if last:
                break
        total = int.from_bytes(info[10:18], "big") & ((1 << 36) - 1)
        bodies.append((at + pos, at + len(stream), total, info[18:34], points))
        at += len(stream)
    seek = [(n, body[0] + offset) for n, body in enumerate(bodies) if body[4] is not None for _, offset in body[4]]
    frames: list[list[np.ndarray]] = [[] for _ in streams]
    for lo in range(0, len(seek), GROUP):
        part, end = seek[lo : lo + GROUP], seek[lo + GROUP][1] if lo + GROUP < len(seek) else len(buf)
        begin = part[0][1]
        for (n, _), samples in zip(part, _decode_frames(buf[begin:end], [x - begin for _, x in part])[0], strict=True):
            frames[n].append(samples.copy())  # on its own, not as a view of the group's work arrays
    ahead = {n: body[0] for n, body in enumerate(bodies) if sum(map(len, frames[n])) < body[2] and not frames[n]}
    while ahead:  # without a seek table a frame is found where the one before ends
        samples, ends = _decode_frames(buf, list(ahead.values()))
        for n, own in zip(list(ahead), samples, strict=True):
            frames[n].append(own)
        ahead = {n: int(e) for n, e in zip(list(ahead), ends, strict=True) if e < bodies[n][1]}
    for own, (_, _, total, md5, _) in zip(frames, bodies, strict=True):
        if sum(map(len, own)) != total or (any(md5) and _md5_of_signed([np.ascontiguousarray(x) for x in own]) != md5):
            raise ValueError("a stream fails its MD5")
        offsets = np.cumsum([0, *map(len, own)])
        found.append([(int(o), x.tobytes()) for o, x in zip(offsets, own, strict=False)])
    return found


def _grouped(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Ranges of values of about BATCH_BYTES each."""
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= BATCH_BYTES:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def _over(column: str, work):
    """A mapInArrow function that adds what work makes of the non-null values of a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()]
            for lo, hi in _grouped(sizes):
                part = batch.slice(lo, hi - lo)
                values = part.column(column).to_pylist()
                there = [i for i, v in enumerate(values) if v is not None]
                results = dict(zip(there, work([values[i] for i in there]), strict=True))
                yield part, [results.get(i) for i in range(len(values))]

    return run


def encode_column(df: DataFrame, payload_col: str = "payload", media_col: str = "media") -> DataFrame:
    """df with a FLAC stream of each payload in place of the payload."""
    ship_package(df.sparkSession)
    df = df.drop(media_col)
    kept = [c for c in df.columns if c != payload_col]

    def run(batches):
        for part, streams in _over(payload_col, encode_many)(batches):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(streams, pa.binary())], [*kept, media_col])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField(media_col, T.BinaryType())]))


def decode_column(df: DataFrame, media_col: str = "media", blocks_col: str = "blocks") -> DataFrame:
    """df with array<struct<sample_offset, pcm>> of each stream."""
    ship_package(df.sparkSession)
    df = df.drop(blocks_col)
    kind = pa.list_(pa.struct([("sample_offset", pa.int64()), ("pcm", pa.binary())]))

    def run(batches):
        for part, decoded in _over(media_col, decode_many)(batches):
            rows = [None if d is None else [{"sample_offset": o, "pcm": x} for o, x in d] for d in decoded]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], [*part.schema.names, blocks_col])

    blocks = T.ArrayType(T.StructType([T.StructField("sample_offset", T.LongType()), T.StructField("pcm", T.BinaryType())]))
    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(blocks_col, blocks)]))


def pcm_blocks(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each PCM block, to be written so that a reader can seek by sample offset."""
    return decoded.select(id_col, F.posexplode("blocks").alias("block", "b")).select(id_col, "block", "b.sample_offset", "b.pcm")


def signal(blocks: Sequence[tuple[int, bytes]]) -> dict:
    """The whole signal of decoded blocks and what its samples say: sum, energy, peak, sign changes, and the block with most energy."""
    loud, total, peak, crossings, last = [], 0, 0, 0, None
    for _, part in blocks:
        x = np.frombuffer(part, np.uint8).astype(np.int64) - 128
        loud.append(int((x**2).sum()))
        total, peak = total + int(x.sum()), max(peak, int(np.abs(x).max(initial=0)))
        below = x < 0
        crossings += int((below[1:] != below[:-1]).sum()) + (last is not None and len(x) > 0 and bool(below[0]) != last)
        last = bool(below[-1]) if len(x) else last
    return {
        "pcm": b"".join(x for _, x in blocks), "blocks": len(blocks), "total": total, "energy": sum(loud), "peak": peak,
        "crossings": crossings, "loudest_offset": blocks[int(np.argmax(loud))][0] if blocks else None,
    }


def signal_column(df: DataFrame, media_col: str = "media", signal_col: str = "signal") -> DataFrame:
    """df with the decoded signal of each stream and its features: struct<pcm, blocks, total, energy, peak, crossings, loudest_offset>."""
    ship_package(df.sparkSession)
    df = df.drop(signal_col)
    numbers = ("blocks", "total", "energy", "peak", "crossings", "loudest_offset")
    kind = pa.struct([("pcm", pa.binary()), *((n, pa.int64()) for n in numbers)])

    def run(batches):
        for part, decoded in _over(media_col, decode_many)(batches):
            rows = pa.array([None if d is None else signal(d) for d in decoded], kind)
            yield pa.RecordBatch.from_arrays([*part.columns, rows], [*part.schema.names, signal_col])

    fields = T.StructType([T.StructField("pcm", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in numbers)])
    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(signal_col, fields)]))


def padded(raw: Column) -> Column:
    """raw with bytes 0 up to a positive multiple of 64."""
    n = F.octet_length(raw)
    pad = F.when(n == 0, 64).otherwise(F.pmod(-n, F.lit(64)))
    return F.concat(raw, F.substring(F.lit(bytes(64)), F.lit(1), pad))


def media_manifest(docs: DataFrame) -> DataFrame:
    """Texts as media: stored, read back, and described. One row per document; null texts are empty. Other columns are ignored."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    stored = encode_column(docs.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), padded(raw).alias("payload")))
    read = signal_column(stored)
    names = ("total", "energy", "peak", "crossings", "blocks", "loudest_offset")
    feature = F.concat_ws(";", *[F.concat(F.lit(f"{n}="), F.col(f"signal.{n}")) for n in names])
    pcm = F.col("signal.pcm")
    return read.select("doc_id", "n_bytes", F.octet_length(pcm).cast("long").alias("payload_bytes"), F.sha2(pcm, 256).alias("payload_sha256"), F.crc32(F.substring(pcm, -64, 64)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))
