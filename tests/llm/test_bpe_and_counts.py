import base64
import hashlib
import random
import time
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from sievework.llm import bpe, transducer
from sievework.llm.blocks import blocks

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
EDGES = [None, "", " ", "\n\n", "a" * 30000, " " * 5000 + "x", "ab" * 9000, "it's they'RE we'll 'tis !'s", "é😀中 mixed 　", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "\0\x85\x1c", "x" * 70 + "1" * 70]


def texts():
    rng = random.Random(2)
    alphabet = [*"aabb eethions  \n\té中😀'sdrvlmt019.,;--==__ ", "'re", "'ve", "'ll", "<|endoftext|>", " ", "ß", "Ⅷ", "²"]
    return EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(3000)]


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(None, "again", "x", 1), (3, "\n\n", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def test_encoding_like_the_library(spark, df):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode(df, RANKS, public_tokenizers.PATTERN, ("doc_id", "n_tokens")).collect()
    assert len(got) == df.count()
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id)), strict=True):
        assert list(array("I", bytes(r.ids))) == own.encode_ordinary(t.text or "") and bytes(r.decoded) == (t.text or "").encode()
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_counts_like_the_library(spark, df):
    library = Tokenizer.from_file(JSON)
    got = transducer.count_tokens(df, JSON).collect()
    want = {t.doc_id: len(library.encode(t.text or "", add_special_tokens=False).ids) for t in df.collect()}
    assert len(got) == df.count() and all(r.n_tokens == want[r.doc_id] for r in got)
    assert {r.doc_id: r.n_bytes for r in got}[8] == len(EDGES[8].encode())
    assert transducer.count_tokens(df.limit(0), JSON).collect() == []


def test_chunks_compose(spark):
    """Piece starts don't depend on how the text is cut into chunks."""
    counter = transducer.Counter(open(JSON, encoding="utf-8").read())
    for text in ("it's   they'll\n\n go! 12 ", "  '  ''re x", "a" * 50):
        symbols = np.append(counter.symbols.of(np.array([ord(c) for c in text], np.uint32)), transducer.BREAK).astype(np.uint8)
        whole = transducer.piece_starts(symbols, counter.step, counter.mark, 10**6).tolist()
        assert all(transducer.piece_starts(symbols, counter.step, counter.mark, n).tolist() == whole for n in range(1, 9))


def test_every_code_point_is_split_like_the_library():
    counter, library = transducer.Counter(open(JSON, encoding="utf-8").read()), Tokenizer.from_file(JSON)
    some = [c for c in [*range(0x3100), *range(0xA700, 0xAC00), *range(0x10900, 0x10A00), *range(0x3FC30, 0x3FC80)] if not 0xD800 <= c < 0xE000]
    lines = ["a" + chr(c) * 2 + " a1" + chr(c) + "'s" for c in some]
    assert counter.count(lines).tolist() == [len(e.ids) for e in library.encode_batch(lines, add_special_tokens=False)]


def test_blocks_cover_everything():
    sizes = ["", "ab", "c" * 50, "", "d"]
    assert [x for a, b in blocks(sizes, 10) for x in sizes[a:b]] == sizes and list(blocks([])) == []


def test_digest_form(spark):
    from pyspark.sql import functions as F

    row = bpe.encode(spark.createDataFrame([(1, "hello")], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN).select(F.sha2("ids", 256).alias("h"), "ids").first()
    assert row.h == hashlib.sha256(bytes(row.ids)).hexdigest()


def test_counts_of_chunks_compose():
    """The changes are the same however the bytes are cut, also where a piece is longer than many chunks."""
    counter = transducer.Counter(open(JSON, encoding="utf-8").read())
    text = "the end isn't " + "ab" * 300 + " é中 x" + "q" * 90 + " 12"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, skip = np.zeros(len(data), bool), np.zeros(len(data), bool)
    starts[[0, 3, 7, 11, 14]] = True
    skip[20:25] = True
    starts[25] = True
    whole = counter.changes(data, starts, skip, 10**6)
    for chunk in (1, 2, 3, 7, 19, 25):
        assert (counter.changes(data, starts, skip, chunk) == whole).all()
    counter._forget()
    assert (counter.changes(data, starts, skip, 5) == whole).all() and whole[20:25].sum() == 0


def test_a_small_table_and_little_memory_count_alike(monkeypatch):
    monkeypatch.setattr(transducer, "SLOTS", 16)
    monkeypatch.setattr(transducer, "MEMO_STEPS", 50)
    counter, library = transducer.Counter(open(JSON, encoding="utf-8").read()), Tokenizer.from_file(JSON)
    for text in [t or "" for t in texts()[:200]] + ["plain words of a text"]:
        if len(text) < 500:
            assert counter.count([text, text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)] * 2


@pytest.mark.parametrize("unit", ["a", "-", "=+=", "ab", "the", "é", "中文"])
def test_a_long_piece_is_counted_in_lanes(unit):
    """A megabyte without a piece start takes seconds, not minutes, and is counted as by the library."""
    counter, library = transducer.Counter(open(JSON, encoding="utf-8").read()), Tokenizer.from_file(JSON)
    text = unit * (1_000_000 // len(unit.encode()))
    began = time.process_time()
    got = counter.count([text])
    assert time.process_time() - began < 2
    assert got.tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_long_pieces_of_many_shapes():
    """Entries of chunks come out right where maps differ from state to state and where pieces begin and end anywhere."""
    rng = random.Random(6)
    counter, library = transducer.Counter(open(JSON, encoding="utf-8").read()), Tokenizer.from_file(JSON)
    for _ in range(150):
        parts = ["".join(rng.choices(rng.choice(["a", "ab", "ACGT", "-=", "0", "abcdefghijklmnopqrstuvwxyz", "é中a"]), k=rng.randint(1, 3000))) for _ in range(rng.randint(1, 4))]
        text = rng.choice(["", " ", "<|endoftext|>"]).join(parts)
        assert counter.count([text]).tolist() == [len(library.encode(text, add_special_tokens=False).ids)]


def test_entries_are_those_of_chunks_one_after_the_other():
    rng = random.Random(7)
    for _ in range(200):
        many, states = rng.randint(1, 12), rng.randint(1, 5)
        maps = [[rng.randrange(states) for _ in range(states)] for _ in range(many)]
        first = np.array([True] + [rng.random() < 0.2 for _ in range(many - 1)])
        given = np.array([rng.randrange(states) if f else 0 for f in first])
        last: dict[int, int] = {}

        def through(chosen, entries, maps=maps, last=last):
            last.update(zip(chosen.tolist(), entries.tolist()))
            return np.array([maps[i][e] for i, e in zip(chosen.tolist(), entries.tolist())])

        want: list[int] = []
        for i in range(many):
            want.append(int(given[i]) if first[i] else maps[i - 1][want[-1]])
        assert transducer._entries(first, given, through).tolist() == want == [last[i] for i in range(many)]
