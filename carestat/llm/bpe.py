"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a piece of bytes, every prefix has exactly one valid encoding, so it is
enough to store each prefix's last token: the token t ending there whose left
neighbour (the last token of the prefix before t) may stand beside t, meaning
that merging the two tokens' bytes gives the two tokens again. The encoding
is read off backwards. Appending bytes extends the table; after an edit only
the entries near it are computed again, until LONGEST entries in a row agree
with the old ones (an entry depends on no more than that).

A text is first split by the tokenizer's pattern; pieces are encoded
separately and a piece that is a token as a whole is that token. Splitting is
done on whole batches of characters with numpy; ``split_pattern`` keeps the
pattern itself as the reference for tests and for edits.

Defined cases: null text is empty (no token, digests of nothing); texts of any
length are encoded whole; any bytes can be encoded, as every byte is a token.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

CACHE_PIECES = 100_000  # encoded pieces kept by a task, and twice as many judged pairs
SUB_CHARS = 1 << 18  # characters split together; a longer text is split alone
SUB_BYTES = 2 << 20  # bytes of text taken out of an Arrow batch together; a longer text is taken alone
_models: dict[str, "Ranks"] = {}


class Ranks:
    """A rank file: token bytes by id, and the judgement of neighbours."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {b: a for a, b in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.halves: dict[int, tuple[int, int]] = {}  # the two tokens whose merge gives a token
        # a token that merging its bytes does not give can stand for a whole piece only
        self.reached = {a: b for a, b in self.rank.items() if self.merge(a, b) == [b]}
        self.rims: dict[tuple[int, int], list] = {}
        self.found = ahocorasick.Automaton()
        for a, b in self.reached.items():
            self.found.add_word(a.decode("latin-1"), b)
        self.found.make_automaton()
        sizes = np.zeros(max(self.token) + 1, np.int64)
        for b, a in self.token.items():
            sizes[b] = len(a)
        self.lengths = sizes.tolist()
        self.sizes, self.places = sizes, np.r_[0, np.cumsum(sizes)[:-1]]
        self.blob = np.frombuffer(b"".join(self.token.get(b, b"") for b in range(len(sizes))), np.uint8)

    def merge(self, data: bytes, token: int | None = None) -> list[int]:
        """Plain merging: the lowest-ranked neighbours first, leftmost of equals.
        With ``token`` the last two parts are noted as its halves."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            if token is not None and len(parts) == 2:
                self.halves[token] = (rank[parts[0]], rank[parts[1]])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    def rim(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """Parts at one edge (1: right) of a token while it is merged: (bytes, rank
        at which the part arises, rank at which a larger one takes it up)."""
        key = (token, side)
        if key not in self.rims:
            out, taken = [], 1 << 40
            while True:
                half = self.halves.get(token)
                out.append((self.token[token], token if half else -1, taken))
                if half is None:
                    break
                token, taken = half[side], token
            self.rims[key] = out
        return self.rims[key]

    def fits(self, left: int, right: int) -> bool:
        """May the two tokens stand beside one another? Not if two parts that
        meet at the border at some time merge before either is taken up; of
        equal ranks the left one merges first."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * CACHE_PIECES:
                self.pairs.clear()
            known = True
            for x, x_from, x_to in self.rim(left, 1):
                for y, y_from, y_to in self.rim(right, 0):
                    if x_from < y_to and y_from < x_to:
                        r = self.rank.get(x + y)
                        if r is not None and r < x_to and r <= y_to:
                            known = False
                            break
                if not known:
                    break
            self.pairs[key] = known
        return known

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """Append to ``last`` the last token of each longer prefix of ``data`` up to ``stop``."""
        reached, pairs, longest = self.reached, self.pairs, self.longest
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            for start in range(max(0, end - longest), end):
                t = reached.get(data[start:end])
                if t is None:
                    continue
                if start:
                    key = (last[start - 1], t)
                    ok = pairs.get(key)
                    if not (self.fits(*key) if ok is None else ok):
                        continue
                last.append(t)
                break
        return last

    def read_back(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.token[out[-1]])
        return out[::-1]

    def forget(self) -> None:
        """Drop what was kept of texts; a Python worker outlives its task."""
        for kept in (self.pieces, self.pairs, self.rims):
            kept.clear()

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.rank.get(data)
        return [whole] if whole is not None else self.read_back(self.extend(data, []))

    def encode_pieces(self, pieces: set[str]) -> None:
        """Encode distinct pieces into the cache: the automaton lists the tokens
        ending at each byte, longest first, and the first that fits is kept."""
        pairs, lengths, cache, rank, found = self.pairs, self.lengths, self.pieces, self.rank, self.found.iter
        for piece in pieces:
            data = piece.encode()
            whole = rank.get(data)
            if whole is not None:
                cache[piece] = array("I", (whole,)).tobytes()
                continue
            last, n = [-1], 0  # last[i]: last token of the prefix of i bytes
            for end, t in found(data.decode("latin-1")):
                if end == n:  # else this prefix has its token already
                    start = end + 1 - lengths[t]
                    if start:
                        key = (last[start], t)
                        ok = pairs.get(key)
                        if not (self.fits(*key) if ok is None else ok):
                            continue
                    last.append(t)
                    n += 1
            out = []
            while n:
                t = last[n]
                out.append(t)
                n -= lengths[t]
            out.reverse()
            cache[piece] = array("I", out).tobytes()


def model(path: str) -> Ranks:
    if path not in _models:
        _models[path] = Ranks(path)
    return _models[path]


class Encoded:
    """The encoding of one piece of bytes that can grow and be edited."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, data, ranks.extend(data, [])

    def append(self, data: bytes) -> None:
        self.data += data
        self.ranks.extend(self.data, self.last)

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Replace bytes start..end; returns how many entries were computed again."""
        old, shift = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        last, same = old[:start], 0
        for stop in range(start + 1, len(self.data) + 1):
            self.ranks.extend(self.data, last, stop)
            edited = stop - self.ranks.longest < start + len(data)
            same = same + 1 if not edited and last[-1] == old[stop - shift - 1] else 0
            if same >= self.ranks.longest:
                last += old[stop - shift:]
                break
        else:
            stop = len(self.data)
        self.last = last
        return stop - start

    def ids(self) -> list[int]:
        whole = self.ranks.rank.get(self.data)
        return [whole] if whole is not None else self.ranks.read_back(self.last)


LETTER, NUMBER, SPACE, SIGN = 0, 1, 2, 3
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _char_kinds() -> np.ndarray:
    import regex
    kinds = np.full(0x110000, SIGN, np.uint8)
    everything = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, everything)]] = kind
    return kinds


_kinds: list[np.ndarray] = []


def piece_starts(text: str, cuts: np.ndarray) -> np.ndarray:
    """Start of every piece of ``text``, where a new text begins at each of ``cuts``
    (0 among them). A piece is a run of letters, numbers or signs with one blank
    before it, a contraction's tail, or white space less the last character
    before something else."""
    if not _kinds:
        _kinds.append(_char_kinds())
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    kind = _kinds[0][code]
    begins = np.zeros(n + 1, bool)
    begins[cuts] = True
    begins[n] = True
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= begins[:n]
    # the last white space before other characters stands alone; a blank joins what follows
    space_end = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[space_end] = True
    start[space_end[code[space_end] == 32] + 1] = False
    # contractions: an apostrophe that begins a piece
    quote = np.flatnonzero((code == 39) & start)
    for q in quote:
        tail = text[q:q + 3]
        for c in _CONTRACTIONS:
            if tail.startswith(c) and not begins[q + 1:q + len(c)].any():
                start[q + 1] = False
                if q + len(c) < n:
                    # the contraction ends here; letters after it are a piece of their own
                    start[q + len(c)] = True
                break
    return np.flatnonzero(start)


def encode_texts(ranks: Ranks, texts: list[str]) -> Iterator[tuple[list[int], bytes]]:
    """(ids per text, all ids as little-endian unsigned 32-bit integers) for as
    many whole texts at a time as hold SUB_CHARS characters."""
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= SUB_CHARS:
            size += len(texts[to])
            to += 1
        group = texts[at:to]
        at = to
        lengths = np.array([len(t) for t in group])
        joined = "".join(group)
        if not joined:
            yield [0] * len(group), b""
            continue
        cuts = np.r_[0, np.cumsum(lengths)]
        starts = piece_starts(joined, cuts[:-1][lengths > 0])
        bounds = starts.tolist() + [len(joined)]
        pieces = [joined[a:b] for a, b in itertools.pairwise(bounds)]
        cache = ranks.pieces
        if len(cache) > CACHE_PIECES:
            cache.clear()
        ranks.encode_pieces(set(pieces).difference(cache))
        parts = list(map(cache.__getitem__, pieces))
        ends = np.r_[0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) >> 2)]
        where = np.searchsorted(starts, cuts)
        yield np.diff(ends[where]).tolist(), b"".join(parts)


def decode(ranks: Ranks, ids: np.ndarray) -> bytes:
    """The bytes of a run of ids."""
    size = ranks.sizes[ids]
    ends = np.cumsum(size)
    if not len(ends):
        return b""
    at = np.repeat(ranks.places[ids] - (ends - size), size)
    at += np.arange(ends[-1])
    return ranks.blob[at].tobytes()


def slices(texts: pa.Array, most: int = SUB_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of as many whole texts at a time as hold ``most`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, texts.slice(at, to - at)
        at, done = to, ends[to - 1]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode each text: id, n_tokens, ids_sha256, decoded_sha256 (and ids)."""
    def coded(ranks: Ranks, ids_in: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        count, digest, plain, all_ids = [], [], [], []
        for counts, raw in encode_texts(ranks, texts.to_pylist()):
            ids = np.frombuffer(raw, "<u4").astype(np.int64)
            bytes_ = decode(ranks, ids)
            ends = np.cumsum(counts)
            at = np.r_[0, np.cumsum(ranks.sizes[ids])][np.r_[0, ends]].tolist()
            lo = 0
            for i, hi in enumerate(ends.tolist()):
                digest.append(hashlib.sha256(raw[4 * lo:4 * hi]).hexdigest())
                plain.append(hashlib.sha256(bytes_[at[i]:at[i + 1]]).hexdigest())
                lo = hi
            count += counts
            if with_ids:
                all_ids.append(pa.array(ids.astype(np.int32)))
        cols = [ids_in, pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(plain, pa.string())]
        if with_ids:
            cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.concat_arrays(all_ids)))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = model(path)
        try:
            for b in batches:
                for at, part in slices(pc.fill_null(b.column(1), "")):
                    yield coded(ranks, b.column(0).slice(at, len(part)), part)
                pa.default_memory_pool().release_unused()  # two workers share an executor with the JVM
        finally:
            ranks.forget()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kind = docs.select(F.col(id_col)).dtypes[0][1]
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)
