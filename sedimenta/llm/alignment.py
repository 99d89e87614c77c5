"""Alignment of the tokens of two tokenizers over the same bytes.

Each side's cumulative token ends go into a dictionary from end to index. The ends that both dictionaries have, in order, cut both
lists of ids into groups that cover the same bytes, and the links of each group are expanded from its two slices. Neither
tokenizer merges anything across a single space between two other characters (which is checked against the vocabulary), so a text is
put together from its words, and words seen before need not be encoded again.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.textscan import pack, unpack
from sedimenta.llm.work import stage

#: Bytes of text whose links share a dictionary, characters taken up at a time and characters of new words encoded at a time.
BLOCK, SEGMENT, POOL = 4_000_000, 200_000, 20_000
#: Words that a worker holds, and their characters, before it forgets those that it has not met since it last held as many.
MEMO_WORDS, MEMO_CHARACTERS = 100_000, 4_000_000
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"
PAIR_BITS = 32


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    """A piece's bytes: ``<0xHH>`` is one byte, the mark of a space is a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE_MARK, " ").encode()


def same_bytes(ids_a: Sequence[int], ids_b: Sequence[int], size_a: Callable[[int], int], size_b: Callable[[int], int]) -> tuple[list[int], list[int], list[int]]:
    """Where the smallest groups of consecutive tokens that cover the same bytes end in each list, and at which byte. Tokens have at least one byte."""
    index_a = dict(zip(accumulate(map(size_a, ids_a)), count(1)))
    index_b = dict(zip(accumulate(map(size_b, ids_b)), count(1)))
    ends = sorted(index_a.keys() & index_b.keys())
    return list(map(index_a.__getitem__, ends)), list(map(index_b.__getitem__, ends)), ends


def ending_together(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of groups, and how many each has: the tokens whose byte ranges end together, which are the last ones of each group."""
    return a[cut_a - 1], b[cut_b - 1], np.ones(len(cut_a), np.int64)


def whole_group(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of groups, and how many each has: every token of one side with every token of the other."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    size = size_a * size_b
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    across = np.repeat(size_b, size)
    return a[np.repeat(cut_a - size_a, size) + place // across], b[np.repeat(cut_b - size_b, size) + place % across], size


@dataclass
class Part:
    """Tokens of a stretch of text on both sides, where its groups end in each, and at which byte."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    ends: np.ndarray

    def groups(self) -> list[dict[str, list[int]]]:
        return [{"a": x.tolist(), "b": y.tolist()} for x, y in zip(np.split(self.a, self.cut_a[:-1]), np.split(self.b, self.cut_b[:-1]))]


@dataclass
class Segment:
    """What a segment's words add up to: tokens of each side, groups, the groups as text and all links."""

    a: int
    b: int
    groups: int
    written: bytes
    links: np.ndarray


class Words:
    """Aligned words by number: their tokens of each side and groups, their groups as text, and their links one after another."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.written: list[bytes] = []
        self.bad: set[int] = set()
        self.characters = 0
        self.sizes = np.empty((4, 0), np.int64)  # tokens a, tokens b, groups, links
        self.links = np.empty(0, np.int64)
        self.begin = np.empty(0, np.int64)

    def add(self, words: list[str], written: list[bytes], sizes: np.ndarray, links: np.ndarray, bad: bool = False) -> None:
        first = len(self.written)
        self.number.update(zip(words, count(first)))
        self.bad.update(range(first, first + len(words)) if bad else ())
        self.written += written
        self.characters += sum(map(len, words))
        self.sizes = np.concatenate([self.sizes, sizes], axis=1)
        self.links = np.concatenate([self.links, links])
        self.begin = np.cumsum(self.sizes[3]) - self.sizes[3]

    def take(self, other: "Words", words: list[str]) -> None:
        """Words that another memo holds."""
        at = np.fromiter(map(other.number.__getitem__, words), np.int64, len(words))
        first = len(self.written)
        self.add(words, [other.written[i] for i in at.tolist()], other.sizes[:, at], other.links_of(at))
        self.bad.update(first + i for i, n in enumerate(at.tolist()) if n in other.bad)

    def links_of(self, at: np.ndarray) -> np.ndarray:
        """The links of words one after another."""
        size = self.sizes[3, at]
        return self.links[np.arange(size.sum()) + np.repeat(self.begin[at] - (np.cumsum(size) - size), size)]

    def together(self, words: list[str]) -> Segment | None:
        """The sum of words; None where one of them has no tokens."""
        numbers = list(map(self.number.__getitem__, words))
        if self.bad and not self.bad.isdisjoint(numbers):
            return None
        at = np.array(numbers)
        a, b, groups, _ = self.sizes[:, at].sum(axis=1).tolist()
        return Segment(a, b, groups, b"".join(map(self.written.__getitem__, numbers)), self.links_of(at))


class Aligner:
    """A byte-level BPE file (JSON) and a piece model, with the words it has aligned."""

    def __init__(self, byte_level: bytes, pieces: bytes, links: Callable = ending_together):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task uses its own core only
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names):
            raise ValueError("a piece has a space after another character: a text can't be encoded in segments")
        self.bytes_b = [piece_bytes(name) for name in names]
        self.size_a, self.size_b = [len(x) for x in self.bytes_a], [len(x) for x in self.bytes_b]
        # An id in decimal with what follows it: a comma, or the end of its side of a group.
        self.written = [f"{i}{x}".encode() for n, end in ((len(names), ";"), (len(self.bytes_a), "|")) for x in (",", end) for i in range(n)]

        self.width = np.array([len(x) for x in self.written])
        self.links = links
        self.words, self.before = Words(), Words()

    def parts(self, texts: list[str]) -> Iterator[Part | None]:
        """Each text with a space before it, in both encodings; None where the tokens are not its bytes."""
        for text, a, b in zip(texts, self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1)):
            a, whole = a.ids, (" " + text).encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                yield None
            else:
                yield Part(*(np.fromiter(x, np.int64, len(x)) for x in (a, b, *same_bytes(a, b, self.size_a.__getitem__, self.size_b.__getitem__))))

    def codes(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """Numbers in ``written`` that spell the groups as ``a1,a2|b1;a3|b2,b3;``, and where each group ends among them."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        code_a, code_b = part.a + 2 * n_b, part.b.copy()
        code_a[part.cut_a - 1] += n_a
        code_b[part.cut_b - 1] += n_b
        code = np.empty(len(code_a) + len(code_b), np.int64)
        size_a, size_b = np.diff(part.cut_a, prepend=0), np.diff(part.cut_b, prepend=0)
        code[np.arange(len(code_a)) + np.repeat(part.cut_b - size_b, size_a)] = code_a
        code[np.arange(len(code_b)) + np.repeat(part.cut_a, size_b)] = code_b
        return code, part.cut_a + part.cut_b

    def learn(self, words: Iterable[str]) -> None:
        """Aligns words, those that begin and end with no white space many at a time: a single space between them is a border on both sides."""
        pools: list[list[str]] = []
        size = POOL
        for word in words:
            alone = word[0].isspace() or word[-1].isspace()
            if alone or size >= POOL:
                pools.append([])
                size = POOL if alone else 0
            pools[-1].append(word)
            size += len(word)
        while pools:
            again: list[list[str]] = []
            for pool, part in zip(pools, self.parts([" ".join(pool) for pool in pools])):
                if part is not None:
                    self._add(pool, part)
                elif len(pool) > 1:  # one of them has no tokens
                    again += [pool[: len(pool) // 2], pool[len(pool) // 2:]]
                else:
                    self.words.add(pool, [b""], np.zeros((4, 1), np.int64), np.empty(0, np.int64), bad=True)
            pools = again

    def _add(self, pool: list[str], part: Part) -> None:
        ends = np.cumsum([len(w.encode()) + 1 for w in pool])
        last = np.searchsorted(part.ends, ends) + 1  # groups up to the end of each word
        code, group_end = self.codes(part)
        text = b"".join(map(self.written.__getitem__, code.tolist()))
        byte = np.cumsum(self.width[code])[group_end[last - 1] - 1].tolist()
        written = [text[x:y] for x, y in zip([0, *byte], byte)]
        first, second, each = self.links(part.a, part.b, part.cut_a, part.cut_b)
        totals = np.stack([part.cut_a[last - 1], part.cut_b[last - 1], last, np.cumsum(each)[last - 1]])
        self.words.add(pool, written, np.diff(totals, axis=1, prepend=0), first << PAIR_BITS | second)

    def segments(self, texts: list[str]) -> list[Segment | None]:
        """What each text's words add up to; None for a text without tokens."""
        cut = [CUT.split(text) for text in texts]
        if len(self.words.written) > MEMO_WORDS or self.words.characters > MEMO_CHARACTERS:
            self.before, self.words = self.words, Words()
        unknown = dict.fromkeys(w for words in cut for w in words if w not in self.words.number)
        if known := [w for w in unknown if w in self.before.number]:
            self.words.take(self.before, known)
        self.learn(w for w in unknown if w not in self.before.number)
        return [self.words.together(words) for words in cut]


def segments(text: str) -> Iterator[str]:
    """A text in parts that are encoded apart, without the single space between two of them."""
    begin = 0
    while len(text) - begin > SEGMENT:
        cut = CUT.search(text, begin + SEGMENT)
        if not cut:
            break
        yield text[begin: cut.start()]
        begin = cut.end()
    yield text[begin:]


def aligned(aligner: Aligner, texts: Iterable[str]) -> Iterator[Text]:
    """What is known of each text; short texts are taken up together."""
    held: list[str] = []
    size = 0

    def released() -> Iterator[Text]:
        short = iter(aligner.segments([t for t in held if t and len(t) <= SEGMENT]))
        for text in held:
            if not text:
                yield Text(())
            elif len(text) <= SEGMENT:
                yield Text([next(short)])
            else:
                yield Text(aligner.segments([x])[0] for x in segments(text))

    for text in texts:
        held.append(text)
        size += min(len(text), SEGMENT)
        if size >= SEGMENT:
            yield from released()
            held, size = [], 0
    yield from released()


class Text:
    """What is known of one text: its numbers of tokens and groups, the digest of its groups, how often it has each link."""

    def __init__(self, segments: Iterable[Segment | None]):
        self.a = self.b = self.groups = 0
        digest, ahead = hashlib.sha256(), b""
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        for segment in segments:
            if segment is None:
                self.a = self.b = self.groups = 0
                counted = []
                break
            digest.update(ahead + segment.written[:-1])
            ahead = segment.written[-1:]
            self.a += segment.a
            self.b += segment.b
            self.groups += segment.groups
            counted.append(np.unique(segment.links, return_counts=True))
        self.links, self.times = counted[0] if len(counted) == 1 else _summed(counted)
        self.sha256 = digest.hexdigest() if self.groups else ""


def _summed(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([np.empty(0, np.int64), *(k for k, _ in counted)]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([np.empty(0, np.int64), *(n for _, n in counted)]), len(keys)).astype(np.int64)


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(byte_level: bytes, pieces: bytes, links: Callable = ending_together) -> Aligner:
    """One per worker process."""
    key = hashlib.sha256(byte_level).hexdigest(), hashlib.sha256(pieces).hexdigest(), links.__name__
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(byte_level, pieces, links)
    return _ALIGNERS[key]


def _files(docs: DataFrame, *paths: str) -> list:
    """The vocabularies on every executor; they are of fixed size, whatever the number of documents."""
    found = []
    for path in paths:
        with open(path, "rb") as file:
            found.append(docs.sparkSession.sparkContext.broadcast(file.read()))
    return found


GROUPS = T.ArrayType(T.StructType([T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType()))]))


def align(docs: DataFrame, byte_level_path: str, pieces_path: str, text_col: str = "text", out: str = "groups") -> DataFrame:
    """``docs`` with the groups of token ids that cover the same bytes in ``out``; a column of that name is replaced.

    The byte-level tokenizer reads a space and the text, as the piece model puts a space before the text itself. Special tokens'
    strings inside texts are plain text. Texts that are NULL or empty, or whose tokens are not the text's bytes on either side
    (characters that a model normalises), have no groups.
    """
    files = _files(docs, byte_level_path, pieces_path)
    name = f"_text_{uuid.uuid4().hex}"
    others = docs.drop(out)
    schema = T.StructType([*others.schema.fields, T.StructField(out, GROUPS)])
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*(f.value for f in files))
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                some = batch.slice(begin, 64)
                rows = []
                for text in some.column(some.num_columns - 1).to_pylist():
                    parts = [next(aligner.parts([x])) for x in segments(text)] if text else []
                    rows.append([] if any(x is None for x in parts) else [g for x in parts for g in x.groups()])
                yield pa.record_batch([*some.columns[:-1], pa.array(rows, kind)], names=schema.names)

    return others.withColumn(name, F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(grouped, schema)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def link_counts(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text",
                links: Callable = ending_together) -> DataFrame:
    """Per row of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    An id pair's count is how many links of all texts hold it. ``n_best`` links have the highest count of their second id,
    ``count_sum`` adds up the counts of the row's links. Texts without tokens (see ``align``) have zeros and an empty digest. Only id and
    text are read, so other columns and their names do not matter; ids may repeat or be NULL; an empty table gives an empty result.

    Texts are read and encoded once. A block of about ``BLOCK`` bytes has one dictionary of its distinct pairs: the pairs go to
    their totals, counted with map-side combination, and come back to the block's rows, so what moves follows the distinct pairs per
    block. A pair that every block has is split by the adaptive skew join. Only tokens of both vocabularies limit the number of pairs.
    """
    files = _files(docs, byte_level_path, pieces_path)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType([T.StructField("_block", long), T.StructField("_pairs", T.ArrayType(long)), T.StructField("_times", T.ArrayType(long)),
                           rows.schema["_id"], *(T.StructField(x, long) for x in NUMBERS), T.StructField("groups_sha256", T.StringType()),
                           T.StructField("_links", binary), T.StructField("_often", binary)])
    names = schema.names

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*(f.value for f in files), links)
        numbers = (TaskContext.get().partitionId() << 33 | i for i in count())
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = iter(np.diff(np.frombuffer(texts.buffers()[1], np.int32, batch.num_rows + 1, 4 * texts.offset)))
            held: list[Text] = []
            begin = size = 0
            for i, text in enumerate(aligned(aligner, (x.as_py() for x in texts))):
                held.append(text)
                size += next(sizes)
                if size >= BLOCK or i == batch.num_rows - 1:
                    yield block(next(numbers), ids.slice(begin, len(held)), held)
                    begin, held, size = i + 1, [], 0

    def block(number: int, ids: pa.Array, texts: list[Text]) -> pa.RecordBatch:
        """The rows of the texts, after the row of their dictionary."""
        pairs, times = _summed([(t.links, t.times) for t in texts])
        n = len(texts)
        columns = [
            pa.array([number] * (n + 1), pa.int64()), pa.array([pairs, *[None] * n], pa.list_(pa.int64())), pa.array([times, *[None] * n], pa.list_(pa.int64())),
            pa.concat_arrays([pa.nulls(1, ids.type), ids]),
            *(pa.array([0, *x], pa.int64()) for x in ([t.a for t in texts], [t.b for t in texts], [t.groups for t in texts], [int(t.times.sum()) for t in texts])),
            pa.array([None, *(t.sha256 for t in texts)], pa.string()),
            pa.array([None, *(pack(np.searchsorted(pairs, t.links).astype(np.uint32), rising=True) for t in texts)], pa.binary()),
            pa.array([None, *(pack(t.times.astype(np.uint32)) for t in texts)], pa.binary()),
        ]
        return pa.record_batch(columns, names=names)

    done = stage(rows.mapInArrow(encoded, schema))
    pairs = done.filter(F.col("_pairs").isNotNull()).select("_block", F.posexplode(F.arrays_zip("_pairs", "_times")).alias("_place", "_entry")).select(
        "_block", "_place", F.col("_entry._pairs").alias("_pair"), F.col("_entry._times").alias("_n"))
    totals = stage(pairs.groupBy("_pair").agg(F.sum("_n").alias("_total")).withColumn("_second", F.col("_pair").bitwiseAND(2**PAIR_BITS - 1)))
    highest = totals.groupBy("_second").agg(F.max("_total").alias("_highest"))
    judged = totals.join(highest, "_second").select("_pair", "_total", (F.col("_total") == F.col("_highest")).alias("_best"))
    values = pairs.select("_block", "_place", "_pair").join(judged, "_pair").select(F.col("_block").alias("_of"), "_place", "_total", "_best")
    texts = done.filter(F.col("_pairs").isNull()).drop("_pairs", "_times")
    out = T.StructType([rows.schema["_id"], *(T.StructField(x, long) for x in [*NUMBERS, "n_best", "count_sum"]), T.StructField("groups_sha256", T.StringType())])

    def summed(texts: pa.Table, values: pa.Table) -> pa.Table:
        order = np.argsort(values["_place"].to_numpy())
        total, best = values["_total"].to_numpy()[order], values["_best"].to_numpy(zero_copy_only=False)[order]
        n_best, count_sum = [], []
        for links, often in zip(texts["_links"].to_pylist(), texts["_often"].to_pylist()):
            link, times = unpack(links, np.uint32, rising=True), unpack(often, np.uint32).astype(np.int64)
            n_best.append(int(times[best[link]].sum()))
            count_sum.append(int((times * total[link]).sum()))
        return pa.table([texts["_id"], *(texts[x] for x in NUMBERS), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), texts["groups_sha256"]], names=out.names)

    found = texts.groupBy("_block").cogroup(values.groupBy("_of")).applyInArrow(summed, out)
    return found.withColumnRenamed("_id", id_col)
