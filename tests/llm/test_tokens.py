from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quire.llm import tokencount, tokenfiles
from quire.llm.queries import vocabulary

from .conftest import collected, ordered

WORDS = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(WORDS))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def pieces():
    with open(vocabulary("byte_bpe_50k.tiktoken")) as f:
        return tokencount.counter(public_tokenizers.PATTERN, f.read())


ODD = ["Σίσυφος ΟΔΟΣ", "été É", "it's IT'S don't''s", "<|endoftext|> x<|startoftext|>", "a b c d", "ªº µ ß ẞ İI", "!!! ... a!b? c--", "日本語 テキスト", "x\x00y\x1cz", "tab\tcr\rff\x0c", "​zero‍", "ﬁx ½ ²3", "word,word. (word)", "___ a_b", "😀a 😀"]


def test_words_encode_like_texts(whole, texts):
    with open(vocabulary(WORDS), encoding="utf-8") as f:
        encoder = tokenfiles.WordEncoder(f.read())
    assert encoder.plain
    assert encoder.by_word
    for t in [*ODD, *(t or "" for _, t in texts)]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == whole(t), t


def test_files_equal_whole_encoding(docs, texts, whole):
    got = collected(tokenfiles.token_output(docs, vocabulary(WORDS), 2))
    want = {}
    for i, t in texts:
        ids = np.array([*whole(t or ""), 2], dtype="<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for i, group in sorted(want.items(), key=lambda r: (r[0] is not None, r[0])):
        rows = sorted((r for r in got if r[0] == i), key=lambda r: r[1])
        assert sorted(r[2:] for r in rows) == sorted(group)  # rows of one id are in any order
        for r in rows:
            assert r[1] == start
            start += r[2]
    assert len(got) == len(texts)


def test_tokenizers_that_keep_spaces(texts):
    """With a tokenizer whose tokens hold spaces, whole texts are encoded."""
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        encoder = tokenfiles.WordEncoder(f.read())
    assert not encoder.by_word
    tokenizer = Tokenizer.from_file(path)
    for t in [*ODD, *(t or "" for _, t in texts)]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_many_rows_without_an_id(spark, tmp_path):
    """Rows of one id are dealt to several tasks."""
    df = spark.createDataFrame([(None, f"text number {k} " * 5) for k in range(400)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = tokenfiles.write_token_files(df.repartition(8), f"file://{tmp_path}", vocabulary(WORDS), 2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(f.docs for f in files) < 300
    assert sum(f.docs for f in files) == 400
    got = tokenfiles.read_token_files(spark.createDataFrame(files)).orderBy("start").collect()
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(400)]


def test_reader_takes_single_documents(docs, spark, tmp_path, whole):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    files = tokenfiles.write_token_files(plain, f"file://{tmp_path}", vocabulary(WORDS), 2)
    texts = {r.doc_id: r.text or "" for r in plain.select("doc_id", "text").collect()}
    seen = set()
    for r in files.collect():
        reader = tokenfiles.FrameReader(r.uri)
        for i in reader.ids[::5]:
            assert reader.find(i).tolist() == [*whole(texts[i]), 2]
        seen |= set(reader.ids)
    assert seen == set(texts)


def test_damage_is_seen(docs, tmp_path):
    uri = tokenfiles.write_token_files(docs, f"file://{tmp_path}", vocabulary(WORDS), 2).orderBy(F.desc("tokens")).first().uri
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    reader = tokenfiles.FrameReader(uri)
    place = int(np.argmax(reader.packed))
    data[int(reader.at[place]) + int(reader.packed[place]) // 2] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="."):
        tokenfiles.FrameReader(uri).document(place)


def test_no_files(none):
    assert tokenfiles.token_output(none, vocabulary(WORDS), 2).count() == 0


def test_edits_equal_counting_anew(pieces):
    rng = random.Random(0)
    bits = ["word", " ", "  ", "\n", "it's", "'", "re", "123", "4", "é", "!?", "日本", "\t", "a", "<|endoftext|>"]
    for _ in range(60):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 400)))
        tree = tokencount.TokenTree(text, pieces)
        for _ in range(12):
            start = rng.randrange(-3, len(text) + 4)
            stop = start + rng.choice([0, 1, 3, 30, 200])
            new = "".join(rng.choice(bits) for _ in range(rng.choice([0, 0, 1, 4, 40])))
            tree.edit(start, stop, new)
            a = min(max(0, start), len(text))
            b = min(max(a, stop), len(text))
            text = text[:a] + new + text[b:]
            assert tree.text == text
            assert tree.total == len(pieces.coder.encode_ordinary(text))
            assert sum(s for sizes, _ in tree.leaves for s in sizes) == len(text)


def test_few_pieces_are_encoded_again(pieces):
    tree = tokencount.TokenTree("some words here " * 20_000, pieces)
    assert tree.edit(100_000, 100_005, "other") < 12


def edited(text, edits):
    for e in edits:
        a = min(max(0, e.start), len(text))
        b = min(max(a, e.stop), len(text))
        text = text[:a] + e.new + text[b:]
    return text


def test_count_table(docs, none, pieces):
    """Counts before and after the edits of the whole table against encoding both texts anew."""
    given = tokencount.with_sample_edits(docs)
    got = collected(tokencount.edited_counts(given, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).select("doc_id", "n_tokens", "n_pieces", "n_edits", "n_tokens_after"))
    size = lambda t: len(pieces.coder.encode_ordinary(t))
    want = [(r.doc_id, size(r.text or ""), len(pieces.pattern.findall(r.text or "")), 3, size(edited(r.text or "", r.edits))) for r in given.select("doc_id", "text", "edits").collect()]
    assert got == ordered(want)
    assert tokencount.edited_counts(tokencount.with_sample_edits(none), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_trees_are_edited_again(docs, pieces):
    """A stored tree after its edits is that of the edited text, and takes further edits."""
    place = vocabulary("byte_bpe_50k.tiktoken")
    once = tokencount.apply_edits(tokencount.token_trees(tokencount.with_sample_edits(docs), place, public_tokenizers.PATTERN, keep=["edits"]), place, public_tokenizers.PATTERN)
    for r in once.collect():
        tree = tokencount.TokenTree.kept(r.text, pieces, [bytes(r[n]) for n in tokencount.ARRAYS])
        assert tree.total == len(pieces.coder.encode_ordinary(r.text)) == r.n_tokens_after
        assert [s for sizes, _ in tree.leaves for s in sizes] == list(map(len, pieces.pattern.findall(r.text)))
    twice = tokencount.apply_edits(tokencount.with_sample_edits(once, "n_encoded_again"), place, public_tokenizers.PATTERN)
    assert all(r.n_tokens_after == len(pieces.coder.encode_ordinary(r.text)) for r in twice.collect())


def test_missing_edits(spark):
    df = spark.createDataFrame([(1, "a b c", None), (2, "a b c", [None, (0, 1, None)]), (3, None, [(0, 0, "new text")])], "doc_id long, text string, edits array<struct<start:int,stop:int,new:string>>")
    got = collected(tokencount.edited_counts(df, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).select("doc_id", "n_edits", "n_tokens", "n_tokens_after"))
    assert [r[:2] for r in got] == [(1, 0), (2, 1), (3, 1)]
    assert got[2][2:] == (0, 2)


def test_words_of_odd_letters():
    """Letters whose lower case has a mark, digits of all kinds and closing signs: words alone give what whole texts give."""
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        words = tokenfiles.WordEncoder(f.read())
    assert words.by_word and words.plain
    rng = random.Random(6)
    pool = [*"aZ09.,$!?-'é", *"İıßŉǰΐﬁKÅ٣²ⅧᾳΣς字ǄẞᾼΪ", "́", "̇", "‍", "ก็", "_", " ", "\n"]
    for text in ["İ$", "xİ,", "İİ!", *("".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(20_000))]:
        assert np.frombuffer(words.encode(text), dtype="<u4").tolist() == words._whole(text), text
