import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sedimenta.llm import alignment
from tests.llm.conftest import LONG, ODD

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(libraries, text):
    """(id, bytes) of each token on both sides, from whole texts; nothing where they are not the text's bytes."""
    a, b = libraries
    letters = alignment.byte_of_character()
    if not text:
        return [], []
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, alignment.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def ends(side):
    out, at = [], 0
    for i, x in side:
        at += len(x)
        out.append((at, i))
    return out


def brute(libraries, rows):
    texts, counts = [], Counter()
    for key, text in rows:
        left, right = map(ends, tokens(libraries, text))
        at = dict(right)
        links = [(i, at[e]) for e, i in left if e in at]
        counts.update(links)
        cuts = sorted({e for e, _ in left} & {e for e, _ in right})
        groups = [",".join(str(i) for e, i in left if a < e <= b) + "|" + ",".join(str(i) for e, i in right if a < e <= b) for a, b in zip([0, *cuts], cuts)]
        texts.append((key, len(left), len(right), links, groups))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(key, a, b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for key, a, b, links, groups in texts]


def words(n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(["alpha", "Beta's", "gamma,", "naïve", "漢字", "🙂", "of", "the", "12345", "x\ny", "", "\t"]) + str(draw.randrange(50)) for _ in range(n))


SPECIAL = ["x<|endoftext|> y", "<s> hi </s><unk>", "▁mark", "a  b   c ", " \n a\tb ", "e\x00f g", "don't 's it's  's", "ﬁ ２", "<0x41>", "a　b c d", "é é"]


def test_query_equals_brute_force(spark, stored, libraries, monkeypatch):
    rows = [(i, words(i, i % 9)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(SPECIAL)] + [(None, "alpha"), (7, None), (7, ""), (7, "alpha")]
    docs = stored(rows, "doc_id long, text string")
    got = alignment.link_counts(docs, *PATHS)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(libraries, rows), key=repr)
    monkeypatch.setattr(alignment, "BLOCK", 500)
    assert alignment.link_counts(docs, *PATHS).count() == len(rows)


def test_many_blocks_equal_brute_force(libraries, monkeypatch):
    texts = [words(400, 3), LONG[:60_000], "a" * 3_000, SPECIAL[0] + " " + words(300, 4), words(100, 5) + " ▁ " + words(100, 6)]
    monkeypatch.setattr(alignment, "SEGMENT", 300)
    monkeypatch.setattr(alignment, "POOL", 40)
    monkeypatch.setattr(alignment, "MEMO_WORDS", 20)
    aligner = alignment.Aligner(*(open(p, "rb").read() for p in PATHS))
    want = brute(libraries, list(enumerate(texts)))
    for got, row in zip(alignment.aligned(aligner, texts), want):
        assert (got.a, got.b, got.groups, int(got.times.sum()), got.sha256) == (*row[1:5], row[7])


def test_groups_and_their_links(stored, libraries):
    rows = [(1, "naïve 漢字 antidisestablishmentarianism"), (2, None), (3, "▁"), (4, words(50, 1))]
    docs = stored([(*r, "mine") for r in rows], "doc_id long, text string, groups string")
    got = {r["doc_id"]: r["groups"] for r in alignment.align(docs, *PATHS).collect()}
    for key, text in rows:
        left, right = tokens(libraries, text)
        assert [i for g in got[key] for i in g["a"]] == [i for i, _ in left] and [i for g in got[key] for i in g["b"]] == [i for i, _ in right]
        names = dict(left), dict(right)
        assert all(b"".join(names[0][i] for i in g["a"]) == b"".join(names[1][i] for i in g["b"]) for g in got[key])
    whole = {r["doc_id"]: r["n_links"] for r in alignment.link_counts(docs, *PATHS, links=alignment.whole_group).collect()}
    assert whole == {key: sum(len(g["a"]) * len(g["b"]) for g in got[key]) for key, _ in rows}


def test_odd_rows(odd, clashing, empty, libraries):
    got = sorted(map(tuple, alignment.link_counts(odd, *PATHS).collect()), key=repr)
    short = [r for r in ODD if r[0] != 7]
    assert Counter(r[:4] for r in got if r[0] != 7) == Counter(r[:4] for r in brute(libraries, [r[:2] for r in short]))
    assert Counter(r[0] for r in got) == Counter(r[0] for r in ODD)
    assert sorted(map(tuple, alignment.link_counts(clashing, *PATHS).collect()), key=repr) == got
    assert alignment.link_counts(empty, *PATHS).count() == 0 and alignment.align(empty, *PATHS).count() == 0
