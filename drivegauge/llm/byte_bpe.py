"""Byte-level BPE encoding and decoding by rank files.

A segment tree over a piece's byte positions holds in each node the least ``rank * size + position`` of the pairs
below it, so the root names the leftmost pair of minimum rank. A merge changes three leaves (the merged pair, the pair
it swallowed and the pair on its left) and so updates three root paths. The trees of many pieces are rows of one
NumPy array and merge in step. Live neighbours are kept in two index arrays.

Cases: null and empty texts have no ids; any text can be encoded, since every byte has a rank; repeated rows each get
a row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import claim, map_batches, texts
from .chunks import SPLIT, Memo

NONE = np.int64(1) << 60
_STATE: dict = {}


class RankEncoder:
    """Encodes and decodes by the ranks in a tiktoken file; ids are ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f.read().splitlines()))}
        self.pattern = regex.compile(pattern)
        self.words = [b""] * (max(self.ranks.values()) + 1)
        pairs = {}
        for word, rank in self.ranks.items():
            self.words[rank] = word
            for i in range(1, len(word)):
                a, b = self.ranks.get(word[:i]), self.ranks.get(word[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        order = sorted(pairs)
        self.pair_keys = np.array([*order, 1 << 62], np.int64)
        self.pair_ranks = np.array([*map(pairs.__getitem__, order), -1], np.int64)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.first = self._lookup(np.repeat(self.single, 256), np.tile(self.single, 256)).reshape(256, 256)
        self.memo = Memo(self._chunks)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the joined pair, or NONE."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def _merge(self, data: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of pieces that are the rows of ``data``, whose width is a power of two."""
        n, size = data.shape
        bits = size.bit_length() - 1
        col = np.arange(size)
        live = col[None, :] < lengths[:, None]
        token = np.where(live, self.single[data], -1).ravel()
        after = np.minimum(np.tile(col + 1, (n, 1)), lengths[:, None]).ravel()  # the piece's length stands for its end
        before = np.tile(col - 1, (n, 1)).ravel()
        rank = np.full((n, size), NONE)
        rank[:, :-1] = np.where(live[:, 1:], self.first[data[:, :-1], data[:, 1:]], NONE)
        tree = np.full((n, 2 * size), NONE)
        tree[:, size:] = np.where(rank == NONE, NONE, (rank << bits) | col)
        k = size
        while k > 1:
            tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
            k //= 2
        flat = tree.ravel()
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while rows.size:
            base, nodes = rows * size, rows * 2 * size
            root = flat[nodes + 1]
            pos, merged = root & (size - 1), root >> bits
            gone = after[base + pos]
            right = after[base + gone]
            token[base + pos], token[base + gone], after[base + pos] = merged, -1, right
            inner = right < lengths[rows]
            before[(base + right)[inner]] = pos[inner]
            pair = np.where(inner, self._lookup(merged, token[base + np.where(inner, right, pos)]), NONE)
            flat[nodes + size + gone] = NONE
            flat[nodes + size + pos] = np.where(pair == NONE, NONE, (pair << bits) | pos)
            left = before[base + pos]
            has = left >= 0
            left = np.where(has, left, pos)
            pair = self._lookup(token[base + left], merged)
            flat[(nodes + size + left)[has]] = np.where(pair == NONE, NONE, (pair << bits) | left)[has]
            path = np.stack([pos, gone, left]) + size
            while size > 1 and path[0, 0] > 1:
                path >>= 1
                two = nodes + 2 * path
                flat[nodes + path] = np.minimum(flat[two], flat[two + 1])
            rows = rows[flat[nodes + 1] < NONE]
        kept = token.reshape(n, size) >= 0
        ends = np.cumsum(kept.sum(axis=1)) * 4
        out = token.reshape(n, size)[kept].astype("<u4").tobytes()
        return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        out: list[bytes] = [b""] * len(raw)
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            whole = self.ranks.get(r)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif r:
                by_size.setdefault(max(2, 1 << (len(r) - 1).bit_length()), []).append(i)
        for size, where in by_size.items():
            step = max(1, (1 << 18) // size)
            for s in range(0, len(where), step):
                part = where[s : s + step]
                data = np.frombuffer(b"".join(raw[i].ljust(size, b"\0") for i in part), np.uint8).reshape(len(part), size)
                for i, ids in zip(part, self._merge(data, np.array([len(raw[i]) for i in part])), strict=True):
                    out[i] = ids
        return out

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        parts = [None if c.isalpha() or c[:1] == " " and c[1:].isalpha() else self.pattern.findall(c) for c in chunks]
        plain = [c for c, p in zip(chunks, parts, strict=True) if p is None]
        others = list(set().union(*filter(None, parts)))
        ids = self._pieces(plain + others)
        get = dict(zip(others, ids[len(plain) :], strict=True)).__getitem__
        whole = iter(ids)
        return [next(whole) if p is None else b"".join(map(get, p)) for p in parts]

    def encode(self, rows: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit integers."""
        split = [SPLIT.findall(t) for t in rows]
        self.memo.prepare(set().union(*split))
        get = self.memo.__getitem__
        return [b"".join(map(get, c)) for c in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder per Python worker."""
    claim("byte_bpe", _STATE.clear)
    return _STATE.get(path) or _STATE.setdefault(path, RankEncoder(path, pattern))


def byte_bpe(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, and ``ids`` (array of long) where ``keep_ids``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(rank_path, pattern)
        ids = coder.encode(batch.column(1).to_pylist())
        columns = [
            batch.column(0),
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(coder.decode(i)).hexdigest() for i in ids], pa.string()),
        ]
        if keep_ids:
            columns.append(pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i in ids], pa.list_(pa.int64())))
        return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return map_batches(texts(df, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * keep_ids, limit=2 << 20)
