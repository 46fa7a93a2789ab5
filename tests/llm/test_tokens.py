"""Round trips of the format, and ids against the tokenizer itself."""

import functools
import weakref
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm.simple8b import BLOCK, COUNTS, ESCAPE, pack, unpack, unpack_block
from gleaner.llm.tokens import Encoder, encoder, read_tokens, token_digests, write_tokens

VALUES = st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 3), st.sampled_from([0, 1, 2**60 - 1, 2**60, 49407]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(VALUES, st.integers(1, 400)), max_size=30))
def test_round_trip(runs):
    values = np.array([v for v, n in runs for _ in range(n)], dtype=np.uint64)
    words, escapes, offsets = pack(values)
    assert (unpack(words, escapes, offsets, len(values)) == values).all()
    assert len(offsets) == -(-len(values) // BLOCK)
    for block in range(len(offsets)):
        assert (unpack_block(words, escapes, offsets, len(values), block) == values[block * BLOCK : (block + 1) * BLOCK]).all()


def test_words_are_full():
    for bits, count in ((1, 60), (10, 6), (15, 4), (20, 3)):
        words, _, _ = pack(np.full(960, (1 << bits) - 1, dtype=np.uint64))
        assert len(words) == -(-960 // count)
    assert len(pack(np.zeros(960, dtype=np.uint64))[0]) == 4
    words, escapes, _ = pack(np.full(3, 2**63, dtype=np.uint64))
    assert len(words) == len(escapes) == 3 and ((words >> np.uint64(60)) == ESCAPE).all() and COUNTS[ESCAPE] == 1


TEXTS = [
    (5, "Hello, WORLD! it's 12,5 o'clock; don't"), (1, None), (3, ""), (2, "á été ÉTÉ, ßx Σας ΟΔΟΣ."), (9, "one two three. " * 30_000), (5, "Hello, WORLD! it's 12,5 o'clock; don't"),
    (7, "x y z \x1cq\x85 \U0001f600!!​%%% a-b_c <|endoftext|> <|startoftext|>"), (8, "\t\n \r\x0b\x0c"), (4, "word%%% word*** 'sup I'll 3rd 中文, स्ते a€,"),
]


@functools.cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


ODD = ["İ", "TÜRKİYE'NİN BİRLİĞİ.", "DEVLETİ!", "<|endoftext|>", "a<|startoftext|>b", "e\u0301", "!!", "ǅ", "ß", "ﬁ", "Ⅷ", "\u0307", "中", "\x1c", "\u2028", "'s", "don't"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(st.characters(exclude_categories=("Cs",)), max_size=12), st.sampled_from(ODD), st.sampled_from(" \n\t!.,'-")), max_size=12))
def test_ids_of_any_text(parts):
    text = "".join(parts)
    texts = [text, "", text + " end", text]
    data = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(data), dtype=np.uint8)
    ids, sizes = encoder("word_bpe_49k.json").encode(raw, np.cumsum([0, *map(len, data)]), 1)
    cuts = np.split(ids, np.cumsum(sizes)[:-1])
    tool = tokenizer()
    assert [c.tolist() for c in cuts] == [[*tool.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_keys_are_integers(spark, tmp_path):
    with pytest.raises(ValueError, match="integer"):
        write_tokens(spark.createDataFrame([("a", "b")], "doc_id string, text string"), f"file://{tmp_path}/x")


@pytest.mark.parametrize("parts", [1, 4])
def test_ids_and_starts(spark, tmp_path, parts):
    frame = spark.createDataFrame([(d, t, "x") for d, t in TEXTS], "doc_id long, text string, part string").repartition(3)
    folder = f"file://{tmp_path}/tokens"
    write_tokens(frame, folder, parts=parts)
    tool, start, want = tokenizer(), 0, []
    for d, t in sorted(TEXTS, key=lambda r: r[0]):
        ids = [*tool.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, start, ids))
        start += len(ids)
    got = sorted((r.key, r.start, list(r.ids)) for r in read_tokens(spark, folder).collect())
    assert got == want
    digests = sorted(map(tuple, token_digests(spark, folder).collect()))
    assert digests == [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in want]


def test_empty_table(spark, tmp_path):
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/none")
    assert token_digests(spark, f"file://{tmp_path}/none").count() == 0


def test_a_task_of_another_operator_forgets_the_encoder():
    """Spark keeps workers from stage to stage: words remembered for tokens aren't held while other operators run."""
    from gleaner.llm._text import lean

    known = weakref.ref(encoder("word_bpe_49k.json"))
    assert list(lean(iter, "tokens")(iter("ab"))) == ["a", "b"] and known() is encoder("word_bpe_49k.json")
    assert list(lean(iter)(iter("ab"))) == ["a", "b"] and known() is None


def test_a_task_gives_freed_memory_back():
    from gleaner.llm._text import lean

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    def run(batches):
        for batch in batches:
            rows = [bytes(2000) for _ in range(100_000)]
            survivors.append([rows[-1], rows[-2], bytes(2000)])  # above what is freed, so that it can't shrink by itself
            yield batch

    survivors, start = [], resident()
    assert list(lean(run)(iter("a"))) == ["a"]
    assert resident() - start < 60 << 20


def test_words_are_remembered_once():
    tool = Encoder("word_bpe_49k.json")
    text = b"plain words, \xc3\xa9t\xc3\xa9 \xc3\xa9t\xc3\xa9, end."
    ids, sizes = tool.encode(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), 1)
    assert ids.tolist() == [*tokenizer().encode(text.decode(), add_special_tokens=False).ids, 1] and sizes.tolist() == [len(ids)]
    assert {b"plain", b"words", b"end"} <= set(tool.chunks) and not {"plain", "words", "end"} & set(tool.pieces)
