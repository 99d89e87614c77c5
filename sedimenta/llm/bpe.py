"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has exactly one BPE encoding, and a token sequence is that encoding exactly if each adjacent pair of
tokens is (their bytes, joined and merged by rank, give the pair again). So it is enough to keep, for each prefix, the last
token of its encoding: a token that ends at the prefix and follows validly on the last token of what precedes it. Appending needs the
new prefixes only, and after an edit the table is right again as soon as it agrees with the old one over the longest token.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces and words held by a worker's memo, and pairs of tokens whose validity is held, before they are emptied.
MEMO_PIECES, MEMO_WORDS, MEMO_PAIRS = 200_000, 400_000, 2_000_000
#: Pieces of a text taken up at a time, and characters of texts whose new words are encoded together.
CHUNK, TOGETHER = 200_000, 4_000_000
#: The same where ids leave the task as arrays, which need memory, too: words held, and characters taken up together.
ENCODE_WORDS, ENCODE_TOGETHER = 150_000, 1_000_000
#: Characters from which on a text's words are not held together; it is read piece by piece.
LONG = 1_000_000
#: Bytes of the longest piece that is encoded together with others.
SHORT = 64
NEVER = 1 << 60


class Vocabulary:
    """Ranks of byte strings; the rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"no token for {len(missing)} of the 256 bytes")
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.begin: dict = {}  # nested by byte; at -1 the token that ends there
        for token, rank in ranks.items():
            at = self.begin
            for byte in token:
                at = at.setdefault(byte, {})
            at[-1] = rank
        self.spines: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}
        self.trie: tuple[np.ndarray, np.ndarray] | None = None
        self._usable: np.ndarray | None = None
        self._lengths: list[int] = []

    def usable(self) -> np.ndarray:
        """By token, whether merging its bytes gives it."""
        if self._usable is None:
            self._usable = np.zeros(max(self.token_bytes) + 1, bool)
            for token in self.token_bytes:
                self._usable[token] = self.edges(token) is not None
        return self._usable

    def lengths(self) -> list[int]:
        """Bytes of each token, by id."""
        if not self._lengths:
            self._lengths = [len(self.token_bytes.get(i, b"")) for i in range(max(self.token_bytes) + 1)]
        return self._lengths

    @classmethod
    def from_bytes(cls, content: bytes) -> Vocabulary:
        """From lines of base64 token and rank."""
        return cls({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)})

    def merged(self, parts: list[bytes], until: int = 1) -> list[bytes]:
        """``parts`` after joining neighbours, lowest rank and leftmost first, until none can be joined or ``until`` are left."""
        ranks = self.ranks
        while len(parts) > until:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and at the right edge of a token while its bytes are merged: (bytes, rank that replaces it).

        None for a token that merging its bytes does not give.
        """
        if token not in self.spines:
            data = self.token_bytes[token]
            left = right = [(data, NEVER)]
            if len(data) > 1:
                parts = self.merged([data[i: i + 1] for i in range(len(data))], until=2)
                if len(parts) == 2 and all(p in self.ranks for p in parts):
                    first, last = self.edges(self.ranks[parts[0]]), self.edges(self.ranks[parts[1]])
                else:
                    first = last = None
                if first and last:
                    left = [*first[0][:-1], (parts[0], token), *left]
                    right = [*last[1][:-1], (parts[1], token), *right]
                else:
                    left = None
            self.spines[token] = left and (left, right)
        return self.spines[token]

    def follows(self, first: int, second: int) -> bool:
        """Whether the encoding of the joined bytes of two tokens is those two tokens.

        Inside either token merges go as they would alone, unless the pieces that meet at the border are merged earlier: by a
        lower rank than what comes next on the left, and no higher one than what comes next on the right.
        """
        key = first << 32 | second
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known = self._follows(first, second)
        return known

    def _follows(self, first: int, second: int) -> bool:
        if not (a := self.edges(first)) or not (b := self.edges(second)):
            return False
        left, right, i, j = a[1], b[0], 0, 0
        while True:
            (x, x_next), (y, y_next) = left[i], right[j]
            rank = self.ranks.get(x + y, NEVER)
            if rank < x_next and rank <= y_next and rank != NEVER:
                return False
            if x_next <= y_next:
                if x_next == NEVER:
                    return True
                i += 1
            else:
                j += 1


class PrefixTable:
    """The last token of the encoding of every prefix of ``data``; ``data`` can grow and change."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, begin: int, end: int) -> None:
        """Sets ``last`` after ``begin`` and up to ``end``, where it is -1; prefixes up to ``begin`` are right."""
        data, last, vocabulary = self.data, self.last, self.vocabulary
        known = vocabulary.pairs.get
        for start in range(max(0, begin - vocabulary.longest + 1), end):
            before = last[start] << 32
            at = vocabulary.begin
            for stop in range(start + 1, end + 1):
                at = at.get(data[stop - 1])
                if at is None:
                    break
                if last[stop] < 0 and (token := at.get(-1)) is not None:
                    if start == 0:
                        if vocabulary.edges(token):
                            last[stop] = token
                    else:
                        valid = known(before | token)
                        if valid or valid is None and vocabulary.follows(before >> 32, token):
                            last[stop] = token

    def append(self, more: bytes) -> None:
        begin = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self._fill(begin, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """``data[start:stop] = new``; returns the number of prefixes that had to be computed."""
        old, longest = self.last, self.vocabulary.longest
        self.data = self.data[:start] + new + self.data[stop:]
        shift, size = len(new) - (stop - start), len(self.data)
        self.last = old[: start + 1] + [-1] * (size - start)
        at, edited = start, start + len(new)
        while at < size:
            upto = min(size, at + longest)
            self._fill(at, upto)
            at = upto
            # From where the last tokens of `longest` prefixes after the edit agree, all later ones do.
            if at - longest >= edited and self.last[at - longest + 1: at + 1] == old[at - longest + 1 - shift: at + 1 - shift]:
                self.last[at + 1:] = old[at + 1 - shift:]
                break
        return at - start

    def tokens(self) -> list[int]:
        out, at, size = [], len(self.data), self.vocabulary.token_bytes
        while at > 0:
            token = self.last[at]
            out.append(token)
            at -= len(size[token])
        return out[::-1]


def _trie(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(next node by inner node and byte, token at each node or -1). Node 0 is the start; -1 is no node.

    Inner nodes are numbered first, so that only they have a row.
    """
    inner, leaves, order = [vocabulary.begin], [], {id(vocabulary.begin): 0}
    for at in inner:
        for byte, below in at.items():
            if byte != -1:
                (inner if any(k != -1 for k in below) else leaves).append(below)
    for i, at in enumerate(inner + leaves):
        order[id(at)] = i
    step = np.full((len(inner), 256), -1, np.int32)
    token = np.full(len(order), -1, np.int64)
    for i, at in enumerate(inner + leaves):
        token[i] = at.get(-1, -1)
        for byte, below in at.items():
            if byte != -1:
                step[i, byte] = order[id(below)]
    return step, token


def encode_together(vocabulary: Vocabulary, pieces: list[bytes]) -> list[tuple[int, ...]]:
    """The encodings of many short pieces: their prefix tables are filled side by side, one prefix length after another."""
    if vocabulary.trie is None:
        vocabulary.trie = _trie(vocabulary)
    step, token_at = vocabulary.trie
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]  # a place for each prefix, the empty one too
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    last = np.full(int((size + 1).sum()), -1, np.int64)
    usable = vocabulary.usable()
    which, node = np.empty(0, np.int64), np.empty(0, np.int32)  # what is still a beginning of a token: its piece's place, its start
    start = np.empty(0, np.int64)
    for upto in range(int(size.max(initial=0))):
        there = np.flatnonzero(size > upto)
        keep = size[which] > upto
        which = np.concatenate([which[keep], there])
        start = np.concatenate([start[keep], np.full(len(there), upto)])
        node = np.concatenate([node[keep], np.zeros(len(there), np.int32)])
        node = step[node, data[begin[which] + upto]]
        keep = node >= 0
        which, start, node = which[keep], start[keep], node[keep]
        token = token_at[node]
        at = np.flatnonzero(token >= 0)
        piece, token, before = which[at], token[at], last[begin[which[at]] + start[at]]
        first = start[at] == 0
        valid = np.zeros(len(at), bool)
        valid[first] = usable[token[first]]
        rest = np.flatnonzero(~first)
        if len(rest):
            keys, back = np.unique(before[rest] << 32 | token[rest], return_inverse=True)
            keys = keys.tolist()
            known = list(map(vocabulary.pairs.get, keys))
            for i in (i for i, v in enumerate(known) if v is None):
                known[i] = vocabulary.follows(keys[i] >> 32, keys[i] & 0xFFFFFFFF)
            valid[rest] = np.array(known, bool)[back]
        last[begin[piece[valid]] + upto + 1] = token[valid]
        keep = node < len(step)
        which, start, node = which[keep], start[keep], node[keep]
    out, ends, lengths = [], last.tolist(), vocabulary.lengths()
    for at, n in zip(begin.tolist(), size.tolist()):
        ids = []
        while n > 0:
            ids.append(ends[at + n])
            n -= lengths[ids[-1]]
        out.append(tuple(ids[::-1]))
    return out


class TextEncoding:
    """The encoding of a text whose matches of a pattern are encoded separately, kept up to date under appends and edits.

    The pattern must look at what follows a match, not at what precedes it, and at no more than ``reach`` matches ahead.
    """

    reach = 3

    def __init__(self, vocabulary: Vocabulary, pattern, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, pattern, text
        self.tables = [PrefixTable(vocabulary, m.encode()) for m in pattern.findall(text)]
        self.starts = self._starts(0, [len(t.data.decode()) for t in self.tables])

    @staticmethod
    def _starts(begin: int, sizes: list[int]) -> list[int]:
        return list(itertools.accumulate(sizes, initial=begin))[:-1]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """``text[start:stop] = new``. Matches well before the edit and those from the first common start after it are kept."""
        first = max(0, sum(s < start for s in self.starts) - self.reach)
        begin = self.starts[first] if self.starts else 0
        self.text = self.text[:start] + new + self.text[stop:]
        shift, edited = len(new) - (stop - start), start + len(new)
        kept = {s + shift: i for i, s in enumerate(self.starts) if s >= stop}
        tables, starts, rest = [], [], len(self.tables)
        for match in self.pattern.finditer(self.text, begin):
            if match.start() >= edited and match.start() in kept:
                rest = kept[match.start()]
                break
            tables.append(PrefixTable(self.vocabulary, match.group().encode()))
            starts.append(match.start())
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[rest:]]
        self.tables = self.tables[:first] + tables + self.tables[rest:]

    def tokens(self) -> list[int]:
        return [t for table in self.tables for t in table.tokens()]


class Encoder:
    """Encodes and decodes texts; distinct pieces are worked out once while the memo holds them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.piece_ids: dict[str, tuple[int, ...]] = {}

    def ids_of(self, piece: str) -> tuple[int, ...]:
        if piece not in self.piece_ids:
            self.learn([piece])
        return self.piece_ids[piece]

    def learn(self, pieces: Iterable[str]) -> None:
        """Works out the pieces that are not held yet."""
        held = self.piece_ids
        short = []
        for piece in {p for p in pieces if p not in held}:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)  # taken as it is, whether merges reach it or not
            if whole is not None:
                held[piece] = (whole,)
            elif len(data) <= SHORT:
                short.append((piece, data))
            else:
                held[piece] = tuple(PrefixTable(self.vocabulary, data).tokens())
        if short:
            held.update(zip([p for p, _ in short], encode_together(self.vocabulary, [d for _, d in short])))

    def forms(self, ids: tuple[int, ...]) -> tuple[bytes, bytes, bytes]:
        """Ids in decimal, the bytes they decode to, ids as 32-bit numbers."""
        return " ".join(map(str, ids)).encode(), self.decode(ids), struct.pack(f"={len(ids)}i", *ids)

    def tidy(self) -> None:
        if len(self.piece_ids) >= MEMO_PIECES:
            self.piece_ids.clear()

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, some at a time."""
        if len(text) <= CHUNK:
            yield self.pattern.findall(text)
            return
        matches = (m.group() for m in self.pattern.finditer(text))
        while some := list(itertools.islice(matches, CHUNK)):
            yield some

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for some in self.pieces(text):
            self.tidy()
            self.learn(some)
            out.extend(itertools.chain.from_iterable(map(self.piece_ids.__getitem__, some)))
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.token_bytes.__getitem__, ids))


class _Words(dict):
    """What stands between two spaces, with the space before it -> its ids in decimal, joined by a space; the bytes they decode to; the
    ids as 32-bit numbers.

    A space between two other characters always begins a match, so a text can be cut there. A word that is empty or has white
    space at an end was not cut so and is never held.
    """

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def learn(self, words: Iterable[str]) -> None:
        """Works out the words that are not held yet."""
        new = [w for w in set(words) - self.keys() if w and not (w[0].isspace() or w[-1].isspace())]
        if not new:
            return
        encoder = self.encoder
        encoder.tidy()
        pieces = encoder.pattern.findall(" " + " ".join(new))
        encoder.learn(pieces)
        held, i = encoder.piece_ids, 0
        for word in new:
            ids, left = held[pieces[i]], len(word) + 1 - len(pieces[i])
            i += 1
            while left > 0:
                ids += held[pieces[i]]
                left -= len(pieces[i])
                i += 1
            self[word] = encoder.forms(ids)


_ENCODERS: dict[tuple[str, str], tuple] = {}


def _encoder(content: bytes, pattern: str) -> tuple[Encoder, _Words]:
    """One of each per worker process."""
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _ENCODERS:
        encoder = Encoder(Vocabulary.from_bytes(content), pattern)
        _ENCODERS[key] = encoder, _Words(encoder)
    return _ENCODERS[key]


def _written(encoder: Encoder, pieces: list[str]) -> list[tuple[bytes, bytes, bytes]]:
    """The forms of the ids of matches of the pattern."""
    encoder.tidy()
    encoder.learn(pieces)
    return [encoder.forms(encoder.piece_ids[p]) for p in pieces]


def _forget(encoder: Encoder, known: _Words) -> None:
    """Give back what a task has held: its worker goes on to live beside other operators' tasks."""
    known.clear()
    encoder.piece_ids.clear()
    encoder.vocabulary.pairs.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def _runs(texts: list[str], encoder: Encoder, known: _Words, most: int = 0) -> Iterator[Iterable[list[tuple[bytes, bytes, bytes]]]]:
    """For each text its pieces' forms, in runs."""
    cut = [text.split(" ") if len(text) <= LONG else [""] for text in texts]
    if len(known) >= (most or MEMO_WORDS):
        known.clear()
    known.learn(itertools.chain.from_iterable(words[1:] for words in cut))
    for text, words in zip(texts, cut):
        try:
            if words[0] != words[0].strip() or not words[0]:
                raise KeyError
            rest = list(map(known.__getitem__, words[1:]))
            yield [_written(encoder, encoder.pattern.findall(words[0])) + rest]
        except KeyError:
            yield (_written(encoder, pieces) for pieces in encoder.pieces(text)) if text else ()


def _digests(texts: list[str], encoder: Encoder, known: _Words) -> Iterator[tuple[int, str, str]]:
    """Number of ids, SHA-256 of the ids in decimal and of the bytes they decode to, for each text."""
    for runs in _runs(texts, encoder, known):
        ids_hash, bytes_hash, n = hashlib.sha256(), hashlib.sha256(), 0
        for forms in runs:
            line = b" ".join([x for x, _, _ in forms])
            ids_hash.update(b" " + line if n else line)
            n += line.count(b" ") + 1
            bytes_hash.update(b"".join([x for _, x, _ in forms]))
        yield n, ids_hash.hexdigest(), bytes_hash.hexdigest()


def _some(texts: Iterable[str], together: int = 0) -> Iterator[list[str]]:
    """Texts in lists of about ``together`` characters."""
    together = together or TOGETHER
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= together:
            yield held
            held, n = [], 0
    yield held


def _vocabulary_file(docs: DataFrame, path: str):
    """The file's bytes on every executor. A vocabulary is of fixed size, whatever the number of documents."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text (NULL: empty) in ``ids_col``; a column of that name is replaced.

    Rows leave a task some megabytes of text at a time, whatever the number or the length of the texts.
    """
    content = _vocabulary_file(docs, vocabulary_path)
    others = docs.drop(ids_col)
    name = f"_text_{uuid.uuid4().hex}"
    rows = others.withColumn(name, F.coalesce(F.col(text_col), F.lit("")))
    schema = T.StructType([*others.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    names = schema.names

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _encoder(content.value, pattern)
        for batch in batches:
            begin = 0
            for texts in _some(batch.column(batch.num_columns - 1).to_pylist(), ENCODE_TOGETHER):
                ids = [b"".join([x for forms in runs for _, _, x in forms]) for runs in _runs(texts, *tools, ENCODE_WORDS)]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                part = batch.slice(begin, len(texts))
                begin += len(texts)
                yield pa.record_batch([*part.columns[:-1], lists], names=names)
        _forget(*tools)

    return rows.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of the ids in ``bytes_col`` (NULL ids: empty)."""
    content = _vocabulary_file(encoded, vocabulary_path)

    @F.pandas_udf(T.BinaryType())
    def raw(ids):
        encoder = _encoder(content.value, "")[0]
        return ids.map(lambda x: b"" if x is None else encoder.decode(x))

    return encoded.withColumn(bytes_col, raw(ids_col))


def encode_digests(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_tokens, ids_sha256 (of the ids in decimal, joined by a space), decoded_sha256.

    Encodes and decodes as ``encode`` and ``decode`` do, without moving the ids out of the task. NULL counts as empty: no
    tokens, digests of nothing. Only id and text are read.
    """
    content = _vocabulary_file(docs, vocabulary_path)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _encoder(content.value, pattern)
        for batch in batches:
            found = [x for texts in _some(batch.column(1).to_pylist()) for x in _digests(texts, *tools)]
            n, ids, raw = zip(*found) if found else ((), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                                  names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([rows.schema["_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return rows.mapInArrow(digests, schema).withColumnRenamed("_id", id_col)
