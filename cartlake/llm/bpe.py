"""Byte-level BPE as a lazily determinised transducer, and streaming decode.

Encoding.  A sequence of tokens is the BPE encoding of its bytes exactly when every
two neighbours are, merged on their own, left as they are.  That makes encoding a
finite-state problem: a nondeterministic reader walks the trie of tokens and may close
a token wherever the pair with the previous one holds.  ``Transducer`` determinises it
while reading: a state is the set of (previous token, trie node), a move names the one
token that closes with its byte, and a token is emitted once every member of the state
hangs on it, a bounded lookahead later.  States and moves are kept in tables that are
emptied at a bound, so memory does not grow with the corpus.

Decoding joins token bytes; ``Utf8Stream`` runs a UTF-8 state machine so that text is
handed out as soon as its characters are complete.

Defined results: a NULL or empty text has no tokens; texts of any length are read whole,
a document at a time; repeated rows repeat in the result; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import blocks

ROOT = 0
START = -1
MAX_STATES = 200_000
#: pieces of one of the two generations that are kept
MAX_PIECES = 250_000
#: (states, pieces) where other stages have filled most of an executor's memory
SMALL_TABLES = (40_000, 60_000)
#: a move is a state and, below it, one more than the token that closes
MOVE_BITS = 32
CLOSING = (1 << MOVE_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


class Transducer:
    """Byte strings to tokens under ``ranks``; ``encode`` for one string, ``feed`` for byte after byte."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.longest = max(self.length.values(), default=1)
        self.depth = [0]                           # of trie nodes
        self.child: dict[int, int] = {}
        self.token_at = [-1]                       # by node of the trie
        for token, rank in ranks.items():
            node = ROOT
            for b in token:
                key = node << 8 | b
                if (nxt := self.child.get(key)) is None:
                    nxt = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token_at[node] = rank
        self.pairs: dict[int, bool] = {}
        self._empty_tables()

    def _empty_tables(self) -> None:
        start = array("q", [START << 32 | ROOT]).tobytes()
        self.members = [start]                     # by state, 8 bytes a member
        self.state_of = {start: 0}
        self.moves: dict[int, int] = {}

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Whether the merges (by rank, leftmost first) of ``left + right`` end in just these two."""
        data = left + right
        rank, border, never = self.ranks.get, len(left), 1 << 60
        ends = list(range(1, len(data) + 1))       # where each part ends
        starts = list(range(len(data)))
        ranks = [rank(data[i:i + 2], never) for i in range(len(data) - 1)]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            if ends[at] == border:
                return False
            del ranks[at], starts[at + 1], ends[at]
            if at < len(ranks):
                ranks[at] = rank(data[starts[at]:ends[at + 1]], never)
            if at:
                ranks[at - 1] = rank(data[starts[at - 1]:ends[at]], never)
        return len(starts) == (2 if left else 1)

    def _holds(self, left: int, right: int, key: int) -> bool:
        """Whether merging leaves these two neighbours as they are; remembered under ``key``."""
        if len(self.pairs) >= 4 * self.max_states:
            self.pairs.clear()
        known = self.pairs[key] = self._apart(b"" if left == START else self.bytes_of[left], self.bytes_of[right])
        return known

    def _move(self, state: int, b: int) -> int:
        """The next state and, in its low MOVE_BITS, one more than the token that closes with this byte."""
        after = array("q")
        closing = -1
        child, token_at, pairs = self.child.get, self.token_at, self.pairs
        for member in array("q", self.members[state]):
            node = child((member & 0xFFFFFFFF) << 8 | b)
            if node is None:
                continue
            last = member >> 32
            after.append(last << 32 | node)
            token = token_at[node]
            if token >= 0 and closing < 0:         # at most one member can close here
                key = last << 32 | token
                holds = pairs.get(key)
                if holds is None:
                    holds = self._holds(last, token, key)
                if holds:
                    closing = token
        after.append(closing << 32 | ROOT)
        members = after.tobytes()
        to = self.state_of.get(members)
        if to is None:
            to = self.state_of[members] = len(self.members)
            self.members.append(members)
        move = self.moves[state << 8 | b] = to << MOVE_BITS | closing + 1
        return move

    def tokens(self, data: bytes) -> Iterator[int]:
        """Tokens of one piece, each handed out once every live member of the state hangs
        on it: no more than a few times the longest token is held back."""
        state, known, length = 0, self.moves.get, self.length
        done, closers = 0, []                      # closers[i]: the token closing after byte done + i
        for at, b in enumerate(data, 1):
            move = known(state << 8 | b) or self._move(state, b)
            state = move >> MOVE_BITS
            closers.append((move & CLOSING) - 1)
            if len(closers) < 2 * self.longest or at % self.longest:
                continue
            chains = []
            for member in array("q", self.members[state]):
                i, chain = at - self.depth[member & 0xFFFFFFFF] - done, []
                while i > 0:
                    chain.append(i)
                    i -= length[closers[i - 1]]
                chains.append(chain[::-1])
            agreed = cut = 0
            while all(len(c) > agreed and c[agreed] == chains[0][agreed] for c in chains):
                cut = chains[0][agreed]
                yield closers[cut - 1]
                agreed += 1
            if cut:
                done, closers = done + cut, closers[cut:]
            if len(self.members) > self.max_states:
                now = self.members[state]
                self._empty_tables()
                known = self.moves.get
                if now not in self.state_of:
                    self.state_of[now] = len(self.members)
                    self.members.append(now)
                state = self.state_of[now]
        yield from self._back(closers)

    def _back(self, closers: list[int]) -> list[int]:
        out, i, length = [], len(closers), self.length
        while i:
            token = closers[i - 1]
            out.append(token)
            i -= length[token]
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one piece; a piece that is a token is its own encoding."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.members) > self.max_states:
            self._empty_tables()
        if len(data) > 4 * self.longest:
            return list(self.tokens(data))
        state, known, closers = 0, self.moves.get, []
        for b in data:
            move = known(state << 8 | b) or self._move(state, b)
            state = move >> MOVE_BITS
            closers.append((move & CLOSING) - 1)
        return self._back(closers)


class Utf8Stream:
    """Bytes in, text out as soon as characters are complete.

    The state is the number of continuation bytes still due; only the last three bytes
    of a block can leave it unfinished, so the machine runs over those."""

    def __init__(self) -> None:
        self.tail = b""

    @staticmethod
    def _due(lead: int) -> int:
        return 1 if 0xC0 <= lead < 0xE0 else 2 if 0xE0 <= lead < 0xF0 else 3 if 0xF0 <= lead < 0xF8 else 0

    def feed(self, block: bytes) -> str:
        data = self.tail + block
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:
                if self._due(b) >= back:
                    cut -= back
                break
        self.tail = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.tail = self.tail, b""
        return rest.decode("utf-8", "replace")


#: Latin-1 text: what the Unicode classes of a split pattern hold there.  Fixed values.
LATIN_1 = {r"\p{L}": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff",
           r"\p{N}": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be",
           r"\s": "\t-\r \u0085\u00a0"}


def splitter(pattern: str):
    """Text to pieces.  Latin-1 texts, the bulk of many corpora, take the same pattern
    with its classes written out, which the standard library's matcher runs faster."""
    full = regex.compile(pattern).findall
    plain = pattern.replace(r"\S", r"[^\s]")
    for name, chars in LATIN_1.items():
        plain = re.sub(r"\[[^\]]*\]", lambda m, n=name, c=chars: m[0].replace(n, c), plain)
        plain = plain.replace(name, f"[{chars}]")
    narrow = re.compile(plain).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return full(text)
        return narrow(text)
    return split


class _Pieces(dict):
    """Pieces seen, as "id id id".  At a bound they become the older generation and that one goes;
    a piece met again comes back from it, so common pieces stay."""

    def __init__(self, machine: Transducer, limit: int):
        super().__init__()
        self.machine, self.limit, self.older = machine, limit, {}

    def __missing__(self, piece: str) -> str:
        ids = self.older.pop(piece, None)
        if ids is None:
            ids = " ".join(map(str, self.machine.encode(piece.encode("utf-8"))))
        if len(piece) <= 32:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Texts to ids (as decimal text) and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES, max_states: int = MAX_STATES):
        self.machine = Transducer(ranks, max_states)
        self.split = splitter(pattern)
        self.pieces = _Pieces(self.machine, max_pieces)
        self.bytes_of = {str(i): b for b, i in ranks.items()}

    def encode(self, text: str) -> str:
        return " ".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: str, block: int = 1 << 16) -> Iterator[str]:
        """Text in the order of the ids, streamed by blocks of tokens."""
        stream, tokens = Utf8Stream(), ids.split()
        for i in range(0, len(tokens), block):
            yield stream.feed(b"".join(map(self.bytes_of.__getitem__, tokens[i:i + block])))
        yield stream.end()


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES) -> Codec:
    codec = Codec(read_ranks(path), pattern, max_pieces, max_states)
    gc.freeze()                     # the tables hold no cycles; walking them again and again only costs time
    gc.set_threshold(200_000)
    return codec


def _apply(docs: DataFrame, id_col: str, text_col: str, schema: str, work) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            rows = work(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *rows], names=[f.split()[0] for f in schema.split(", ")])
    kind = docs.schema[id_col].dataType.simpleString()
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return cols.mapInArrow(run, f"doc_id {kind}, " + ", ".join(schema.split(", ")[1:]))


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids: the token ids as decimals joined by one space, decoded: the text back from the ids)."""
    def work(texts):
        codec = _codec(ranks_path, pattern)
        ids = [codec.encode(t.as_py() or "") for t in texts]
        return [pa.array(ids, pa.string()), pa.array(["".join(codec.decode(x)) for x in ids], pa.string())]
    return _apply(docs, id_col, text_col, "doc_id, ids string, decoded string", work)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           tables: tuple[int, int] = (MAX_STATES, MAX_PIECES)) -> DataFrame:
    """(doc_id, n_tokens, ids), checked by decoding: a text that would not come back is an error.
    ``tables`` bounds the states and the pieces kept; fewer take less memory and more time."""
    def work(texts):
        codec = _codec(ranks_path, pattern, *tables)
        n, out = [], []
        for t in texts:
            text = t.as_py() or ""
            ids = codec.encode(text)
            if "".join(codec.decode(ids)) != text:
                raise ValueError("a text does not come back from its ids")
            n.append(ids.count(" ") + 1 if ids else 0)
            out.append(ids)
        return [pa.array(n, pa.int64()), pa.array(out, pa.string())]
    return _apply(docs, id_col, text_col, "doc_id, n_tokens bigint, ids string", work)


def digests(docs: DataFrame, ranks_path: str, pattern: str,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) without keeping the ids."""
    def work(texts):
        codec = _codec(ranks_path, pattern)
        n, of_ids, of_text = [], [], []
        for t in texts:
            ids = codec.encode(t.as_py() or "")
            n.append(ids.count(" ") + 1 if ids else 0)
            of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
            h = hashlib.sha256()
            for part in codec.decode(ids):
                h.update(part.encode("utf-8"))
            of_text.append(h.hexdigest())
        return [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
    return _apply(docs, id_col, text_col, "doc_id, n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)
