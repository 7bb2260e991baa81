"""Byte-level BPE as a bounded-lookahead streaming transducer, and its inverse.

Encoding reads a text left to right: pre-tokens by pattern, then merges inside a
window of bytes. How far a change at the right end of a window can reach to the left
follows from the merge list alone (``lookahead``), so a token that ends further away
than that is final and is emitted at once. Memory beside the text itself is a window,
a block of ids and a word cache of fixed size, for texts of any length. Decoding runs
ids through a byte-to-text state machine that holds back an unfinished character.

A tokenizer file is the JSON of the public ``tokenizers`` library with a BPE model and
a ByteLevel pre-tokenizer; its path is a parameter and executors open it themselves
(each machine has it installed), so nothing is broadcast.

Defined results: a null text is an empty text and has no ids; added tokens that occur
in a text are single ids; repeated rows and null ids of rows are kept as they are.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back

#: The byte-level pre-token pattern that the tokenizer files are made for; letters come
#: first, as no other alternative that could match there begins with one.
PATTERN = r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens are taken, and ids decoded, in blocks of so many.
BLOCK = 1 << 16
#: Words whose ids are remembered in each of two generations; when the younger one is
#: full it becomes the older one, whose words return to the younger one with their next use.
CACHE = 150_000
#: Longer pre-tokens aren't remembered.
CACHED_LENGTH = 64
#: Characters of a pre-token whose ids are passed on before its end is reached.
LONG = 4096
#: Bytes of ids that are gathered before rows leave a task.
KEPT = 1 << 22
#: The rank of a pair that doesn't merge.
NEVER = 1 << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others take the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def lookahead(merges: list[tuple[int, int]], made: dict[tuple[int, int], int], length: list[int]) -> int:
    """Bytes to the right of a token's end after which no further byte can change it.

    Run the merges over a window and over the window with more bytes behind it. Left of
    a frontier, at first the window's end, both agree. Only a merge of u, ending at the
    frontier, with v, starting there, moves it, and moves it by |u|. The next such merge
    is of a later rule whose right part has u at its left edge. So the frontier's way is
    at most the longest chain of rules in rising order, each with the left part of the one
    before on the left spine of its right part, measured by the left parts' lengths.
    """
    spine: dict[int, set[int]] = {}
    best: dict[int, int] = {}
    longest = 0
    for pair in merges:
        u, v = pair
        reach = length[u] + max(best.get(s, 0) for s in spine.get(v, {v}))
        spine.setdefault(made[pair], {made[pair]}).update(spine.get(u, {u}))
        best[u] = max(best.get(u, 0), reach)
        longest = max(longest, reach)
    return longest


class Transducer:
    """Encoder and decoder of one tokenizer file; keeps no state between texts but the cache."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        merges = [(vocab[a], vocab[b]) for a, b in pairs]
        self.made = {(vocab[a], vocab[b]): vocab[a + b] for a, b in pairs}
        self.rank = {m: r for r, m in reversed(list(enumerate(merges)))}
        self.of_byte = [vocab[c] for c in letters]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.lookahead = lookahead(merges, self.made, [len(b) for b in self.bytes_of])
        self.window = 2 * self.lookahead + 2 * max(map(len, self.bytes_of))  # more than lookahead and a token
        self.pieces = regex.compile(PATTERN)
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.bytes_of))]
        self.added = {t: i.to_bytes(4, "little") for t, i in added.items()}
        by_length = sorted(added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if added else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Token ids of a window of bytes: the pair of least rank first, leftmost first."""
        ids = [self.of_byte[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        rank, made = self.rank, self.made
        if n <= 24:
            get = rank.get
            ranks = [get(p, NEVER) for p in zip(ids, ids[1:])]  # noqa: B905
            while ranks and (best := min(ranks)) < NEVER:
                at = ranks.index(best)
                ids[at] = new = made[ids[at], ids[at + 1]]
                del ids[at + 1], ranks[at]
                if at:
                    ranks[at - 1] = get((ids[at - 1], new), NEVER)
                if at < len(ranks):
                    ranks[at] = get((new, ids[at + 1]), NEVER)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != pair[0] or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = made[pair], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (p := (ids[a], ids[after[a]])) in rank:
                    heapq.heappush(heap, (rank[p], a, p))
        return [i for i in ids if i >= 0]

    def piece(self, data: bytes) -> Iterator[list[int]]:
        """Ids of a pre-token of any length, emitted as soon as they are final."""
        at = 0
        while len(data) - at > self.window:
            out, end = [], at
            limit = at + self.window - self.lookahead
            for i in self.merge(data[at : at + self.window]):
                if end + len(self.bytes_of[i]) > limit:
                    break
                out.append(i)
                end += len(self.bytes_of[i])
            yield out
            at = end
        yield self.merge(data[at:])

    def _packed(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = b"".join([self.packed[i] for ids in self.piece(piece.encode()) for i in ids])
        if len(piece) <= CACHED_LENGTH:
            self.cache[piece] = out
        return out

    def _age(self) -> None:
        if len(self.cache) >= CACHE:
            self.cache, self.older = {}, self.cache

    def _encoded(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of some pre-tokens: of short ones together, of long ones as they become final."""
        self._age()
        cache, packed = self.cache, self._packed
        if max(map(len, pieces), default=0) <= LONG:
            yield b"".join([cache.get(p) or packed(p) for p in pieces])
            return
        for p in pieces:
            if len(p) <= LONG:
                yield cache.get(p) or packed(p)
            else:
                yield from (b"".join([self.packed[i] for i in ids]) for ids in self.piece(p.encode()))

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special and any(t in text for t in self.added) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.added[part]
                continue
            if len(part) <= BLOCK:
                yield from self._encoded(self.pieces.findall(part))
                continue
            found = (m[0] for m in self.pieces.finditer(part))
            while some := list(islice(found, BLOCK)):
                yield from self._encoded(some)

    def decode(self, blocks: Iterable[bytes]) -> Iterator[str]:
        """Text of blocks of ids; a character cut by a block's end waits for the next one."""
        import numpy as np

        machine, table = codecs.getincrementaldecoder("utf-8")("replace"), self.bytes_of
        for block in blocks:
            ids = np.frombuffer(block, "<u4")
            for k in range(0, len(ids), BLOCK):
                yield machine.decode(b"".join([table[i] for i in ids[k : k + BLOCK].tolist()]))
        yield machine.decode(b"", True)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per Python worker and file."""
    return Transducer(path)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encodes column ``text`` of every row and decodes the ids again.

    Returns ``key``, n_tokens, ids_sha256 and decoded_sha256, with ``keep_ids`` also
    ids, a binary of little-endian unsigned 32-bit integers. Other columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        def rows(keys, out):
            n_tokens, ids_sha, text_sha, kept_ids = zip(*out, strict=True)
            columns = [keys, pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if keep_ids:
                columns.append(pa.array(kept_ids, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=names)

        t = transducer(path)
        for batch in batches:
            out, begin, size = [], 0, 0
            for at, row in enumerate(batch.column(1)):
                ids_hash, text_hash, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []

                def ids(row=row, kept=kept, ids_hash=ids_hash):
                    nonlocal n
                    for block in t.encode(row.as_py() or ""):
                        ids_hash.update(block)
                        n += len(block) // 4
                        if keep_ids:
                            kept.append(block)
                        yield block

                for piece in t.decode(ids()):
                    text_hash.update(piece.encode())
                out.append((n, ids_hash.hexdigest(), text_hash.hexdigest(), b"".join(kept)))
                size += len(out[-1][3])
                if size > KEPT:
                    yield rows(batch.column(0).slice(begin, len(out)), out)
                    out, begin, size = [], at + 1, 0
            if out:
                yield rows(batch.column(0).slice(begin), out)
        give_back()

    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def default_path() -> str:
    """The installed public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
