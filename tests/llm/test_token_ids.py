import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hearthlake.llm import repair, token_ids
from hearthlake.session import work_dir

WHOLE = Tokenizer.from_file(public_tokenizers.path(token_ids.TOKENIZER))

TEXTS = [
    "Hello, World! it's 42nd", "", None, " \n\t ", "naïve café ÉCOLE straße", "école å", "ΣΑΣ İstanbul ſ", "日本語 テキスト 😀👍🏽",
    "<|endoftext|> a<|startoftext|>b <| x", "a b c\u0085d\x1ce", "don't we'll I'M '", "x" * 5000, "1234567890 ½²", "ß­ ŉ Ǆ", "﻿bom \x00nul",
    "한국어 ลี้ ا‌ب", "a.b,c;d--e…", "̈́ẛ̣",
]


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_text():
    encode = token_ids.encoder()
    for text in TEXTS + [" ".join(t or "" for t in TEXTS)]:
        assert np.frombuffer(encode(text), "<u2").tolist() == ids(text), text


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text_gives_its_ids(text):
    assert np.frombuffer(token_ids.encoder()(text), "<u2").tolist() == ids(text)


def by_hand(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = ids(text) + [token_ids.END_ID]
        out.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return out


def test_output_against_brute_force(docs, staging, monkeypatch):
    rows = [(7 * i % 1001 - 20, t) for i, t in enumerate(TEXTS * 3)] + [(None, "null id")]
    for size in (1 << 21, 50):
        monkeypatch.setattr(token_ids, "BLOCK_IDS", size)
        got = token_ids.token_output(staging, docs(rows, ids="x", start="y").repartition(5))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(by_hand(rows), key=repr)
    assert token_ids.token_output(staging, docs([])).count() == 0


def test_repeated_rows_keep_their_ids(docs, staging):
    got = token_ids.token_output(staging, docs([(1, "same text"), (1, "same text"), (2, "b")]))
    assert sorted((r.doc_id, r.start) for r in got.collect()) == [(1, 0), (1, 3), (2, 6)]


def test_random_access(spark, docs, staging):
    rows = [(i, f"document number {i} " + "again and again " * (i % 9)) for i in range(60)]
    written = staging.keep(token_ids.write_shards(docs(rows), work_dir(spark, "ids"), 3), "w").collect()
    for doc_id, text in rows[::7]:
        found = [f for f in (token_ids.read_document(r.path, doc_id) for r in written if r.docs) if f is not None]
        assert found == [ids(text) + [token_ids.END_ID]]
    assert all(token_ids.read_document(r.path, 999) is None for r in written)
    whole = {r.doc_id: r.ids for r in token_ids.read_shards(staging.spark.createDataFrame(written), with_ids=True).collect()}
    assert whole == {i: ids(t) + [token_ids.END_ID] for i, t in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(1, 5))
def test_repair_round_trip(own, repeats):
    own = np.array(own * repeats * 20, np.int64)
    grammar, symbols = repair.compress(own, 8, 2)
    assert grammar.expand(symbols).tolist() == own.tolist()
    assert grammar.widths(symbols.astype(np.int64)).sum() == len(own)
    for pair, length in zip(grammar.rules, grammar.lengths, strict=True):
        assert 2 not in pair and len(grammar.expand(pair)) == length
    if len(set(own.tolist()) - {2}) == 1 and len(own) > 500 and 2 not in own:
        assert len(symbols) < len(own) / 4


class Counting:
    """A file that counts what is read."""

    def __init__(self, file):
        self.file, self.bytes = file, 0
        self.seek = file.seek

    def read(self, n=-1):
        data = self.file.read(n)
        self.bytes += len(data)
        return data


def test_random_access_reads_less_than_the_file(tmp_path):
    rng = np.random.default_rng(1)
    own = [np.append(rng.integers(5, 40_000, 300), token_ids.END_ID) for _ in range(200)]
    index, data = [], b""
    for i in range(0, 200, 20):
        index.append((len(data), i, i + 19, 20))
        data += repair.pack_block(np.arange(i, i + 20), np.ones(20, bool), np.full(20, 301), np.concatenate(own[i : i + 20]), token_ids.TERMINALS, token_ids.END_ID)
    data += repair.pack_index(index)
    (tmp_path / "s.ids").write_bytes(data)
    for doc_id in (0, 57, 199):
        with open(tmp_path / "s.ids", "rb") as file:
            counted = Counting(file)
            assert repair.find_document(counted, doc_id).tolist() == own[doc_id].tolist()
            assert counted.bytes < len(data) / 20
    with open(tmp_path / "s.ids", "rb") as file:
        assert repair.find_document(file, 200) is None
        file.seek(0)
        assert len(list(repair.read_blocks(file))) == 10


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(2)
    own = rng.choice(np.r_[5:400], 60_000, p=(w := 1 / np.arange(1, 396) ** 1.1) / w.sum())
    own[::50] = 2
    grammar, symbols = repair.compress(own, 400, 2)
    assert grammar.expand(symbols).tolist() == own.tolist() and len(symbols) < len(own) * 0.8
    symbols = symbols.astype(np.uint32)
    codes = (symbols[:-1] << 16 | symbols[1:])[(symbols[:-1] != 2) & (symbols[1:] != 2)]
    assert np.unique(codes, return_counts=True)[1].max() < repair.LEAST_PAIRS
    assert len({tuple(p) for p in grammar.rules.tolist()}) == len(grammar.rules)


def test_many_rows_of_one_id_are_spread(spark, docs, staging):
    rows = [(5, f"text {i}") for i in range(400)] + [(None, f"none {i}") for i in range(400)]
    written = staging.keep(token_ids.write_shards(docs(rows), work_dir(spark, "ids"), 4), "w").collect()
    assert sorted(r.docs > 100 for r in written) == [True] * 4 and sum(r.docs for r in written) == 800
