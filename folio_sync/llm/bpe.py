"""Byte-level BPE by prefix dynamic programming.

BPE of a byte string has this property: every prefix has one last token only that its own
encoding ends with, and cutting that token off leaves the encoding of the shorter prefix. So
the table "last token of each prefix" holds all encodings. The token that ends at a prefix is
the one which, put behind the last token before it, would come out of BPE as exactly
these two tokens. Appending bytes only adds entries; after an edit the entries before it stay,
and the old ones are taken over again once both tables agree for the length of a token.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.llm.common import in_batches, small_batches, whole_text

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HELD_PIECES = 400_000

# Letters, numbers and white space of the code points below U+0250 and the
# pattern in their terms, for the faster of the two regular expression modules.
LETTERS, NUMBERS, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r\x20\x85\xa0"
NOT_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ]")
PLAIN_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACE}{LETTERS}{NUMBERS}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str = public_tokenizers.PATTERN) -> Callable[[str], list[str]]:
    """Texts to the pieces that are encoded separately."""
    general = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return general
    plain = re.compile(PLAIN_PATTERN).findall
    return lambda text: general(text) if NOT_PLAIN.search(text) else plain(text)


class PrefixEncoder:
    """Encodes byte strings with a rank file; `table` and `ids` are the two halves of it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        # finds all tokens that end at each byte; it takes strings, so bytes stand as code points
        self.endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.endings.add_word(token.decode("latin-1"), (len(token), rank))
        self.endings.make_automaton()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merged(self, left: int, right: int) -> int | None:
        return self.ranks.get(self.tokens[left] + self.tokens[right])

    def _parts_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a token that is no merge."""
        if token not in self.parts:
            body = self.tokens[token]
            left = self._plain(body, below=token) if len(body) > 1 else [token]
            self.parts[token] = (left[0], left[1]) if len(left) == 2 else None
        return self.parts[token]

    def _plain(self, body: bytes, below: int) -> list[int]:
        """Merge by merge, with ranks under `below` only; for single tokens of the vocabulary."""
        ids = [self.ranks[body[i : i + 1]] for i in range(len(body))]
        while len(ids) > 1:
            found = [(m, i) for i in range(len(ids) - 1) if (m := self._merged(ids[i], ids[i + 1])) is not None]
            if not found or min(found)[0] >= below:
                break
            rank, i = min(found)
            ids[i : i + 2] = [rank]
        return ids

    def _stands(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' bytes gives these two tokens.

        Undo merges from the latest to the earliest: the pair falls if some merge across
        its border comes before the merges that built what stands beside the border."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self._undo(left, right)
        return known

    def _undo(self, a: int, b: int) -> bool:
        limit = 1 << 62
        while True:
            merge = self._merged(a, b)
            if merge is not None and merge < limit:
                return False
            if a > b:  # the later merge is undone first; ranks are the merges' order
                limit, parts = a, self._parts_of(a)
                if parts is None:
                    limit, parts = b + 1, self._parts_of(b)
                    if parts is None:
                        return True
                    b = parts[0]
                else:
                    a = parts[1]
            else:
                limit, parts = b + 1, self._parts_of(b)
                if parts is None:
                    limit, parts = a, self._parts_of(a)
                    if parts is None:
                        return True
                    a = parts[1]
                else:
                    b = parts[0]

    def table(self, body: bytes, start: list[int] | None = None) -> list[int]:
        """The last token of every prefix; `start` is the table of a prefix of `body`."""
        if start:
            last = list(start)
            for end in range(len(last) + 1, len(body) + 1):
                last.append(self._last(body, end, last))
            return last
        last = [-1] * len(body)
        whole, pairs = self.parts, self.pairs
        for end, (size, token) in self.endings.iter(body.decode("latin-1")):
            if last[end] >= 0 or size > 1 and not (whole.get(token) or self._whole(token)):
                continue
            if size > end:
                last[end] = token
            else:
                known = pairs.get((last[end - size], token))
                if known or known is None and self._stands(last[end - size], token):
                    last[end] = token
        if -1 in last:
            raise ValueError(f"the vocabulary has no token for byte {body[last.index(-1)]}")
        return last

    def _last(self, body: bytes, end: int, last: list[int]) -> int:
        for begin in range(max(0, end - self.longest), end):
            token = self.ranks.get(body[begin:end])
            if token is not None and self._whole(token) and (
                    begin == 0 or self._stands(last[begin - 1], token)):
                return token
        raise ValueError(f"the vocabulary has no token for byte {body[end - 1]}")

    def _whole(self, token: int) -> bool:
        """Whether BPE of the token's bytes gives the token: some entries are never reached."""
        return len(self.tokens[token]) == 1 or self._parts_of(token) is not None

    def ids(self, last: list[int]) -> list[int]:
        found, end = [], len(last)
        while end:
            found.append(last[end - 1])
            end -= len(self.tokens[found[-1]])
        return found[::-1]

    def append(self, body: bytes, last: list[int], more: bytes) -> list[int]:
        """The table after `more` was appended; earlier entries are kept as they are."""
        return self.table(body + more, last)

    def edit(self, body: bytes, last: list[int], at: int, removed: int, put: bytes) -> tuple[bytes, list[int]]:
        """Body and table after `removed` bytes at `at` gave way to `put`.

        Entries are computed until as many in a row as the longest token's length agree with
        the old ones: from there each next entry depends on equal bytes and equal entries."""
        new = body[:at] + put + body[at + removed :]
        table, shift = last[:at], len(put) - removed
        agreed = 0
        while len(table) < len(new):
            table.append(self._last(new, len(table) + 1, table))
            old = len(table) - 1 - shift
            beyond = len(table) > at + len(put)
            agreed = agreed + 1 if beyond and last[old] == table[-1] else 0
            if agreed >= self.longest:
                return new, table + last[old + 1 :]
        return new, table

    def encode(self, body: bytes) -> list[int]:
        whole = self.ranks.get(body)
        if whole is not None:  # a piece of the vocabulary stands for itself, even one no merge reaches
            return [whole]
        return self.ids(self.table(body))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Pieces(dict):
    """Piece -> ids as little-endian bytes; forgets all when it holds `HELD_PIECES`."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= HELD_PIECES:
            self.clear()
        found = array("I", self.encoder.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            self[piece] = found
        return found


CODED = pa.schema([("row", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _coder(ranks: dict[bytes, int], pattern: str, make: Callable, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PrefixEncoder(ranks)
        pieces, split = _Pieces(encoder), splitter(pattern)

        def rows():
            for batch in batches:
                for *kept, text in zip(*(c.to_pylist() for c in batch.columns)):
                    ids = b"".join(map(pieces.__getitem__, split(text)))
                    yield make(kept, ids, encoder)

        yield from in_batches(rows(), schema, 500)

    return run


def _numbers(ids: bytes) -> array:
    found = array("I")
    found.frombytes(ids)
    return found


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """`docs(doc_id, text, ...)` to (doc_id, ids array<int>); a null text has no ids."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    coder = _coder(read_ranks(vocabulary), pattern, lambda kept, ids, _: (*kept, _numbers(ids).tolist()), schema)
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        coder, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); bytes that are no UTF-8 become U+FFFD."""
    tokens = {rank: token for token, rank in read_ranks(vocabulary).items()}
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (doc_id, b"".join(map(tokens.__getitem__, ids or ())).decode(errors="replace"))
            for b in batches for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
        )
        yield from in_batches(rows, schema, 500)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_round_trip(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, with_ids: bool = False
) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: doc_id, n_tokens, ids_sha256, decoded_sha256,
    and on demand ids, an array.

    Encodes the whole text and decodes the ids again. A null text counts as empty and has no
    tokens; an empty table gives no rows; equal rows give equal rows; other columns are not
    read. The vocabulary is read once on the driver; its size is fixed."""
    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields, ddl = [*fields, ("ids", pa.list_(pa.int32()))], f"{ddl}, ids array<int>"

    def digests(kept, ids, encoder):
        numbers = _numbers(ids)
        decoded = encoder.decode(numbers)
        row = (*kept, len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
        return (*row, numbers.tolist()) if with_ids else row

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        _coder(read_ranks(vocabulary), pattern, digests, pa.schema(fields)), ddl)
