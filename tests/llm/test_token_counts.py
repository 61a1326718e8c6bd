from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hearthlake.llm import token_counts as T
from hearthlake.llm.pieces import TOKENIZER, PieceModel, pre_tokens
from tests.llm.conftest import rows_of

LIBRARY = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def length(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


TEXTS = [
    None, "", " \n\t", "Hello, it's THE end of they'll've!", "¿Qué pasó, señor? ciónñ", "<|endoftext|> a<|startoftext|>b <| x", "é é É'S",
    "ΣΑΣ İstanbul ǅ ẞ ⱥȺ", "日本語 テスト 𝔘𝔫𝔦 🙂🙂 a b　c", "x\x00y \x1c z\x85w", "1234 ½ ²³ 12.5%", "a" * 70_000, "näive " * 900, "word " * 2049, "!'s 'S 'LL",
]


def by_hand(rows):
    out = [(d, len((t or "").encode()), length(t), length(t) > 2048) for d, t in rows]
    return sorted(out, key=repr)


def test_counts_equal_the_library(docs, staging):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (3, TEXTS[5]), (None, TEXTS[4])]
    got = T.token_counts(staging, docs(rows, row="r", n_tokens="n", keys="k"))
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == by_hand(rows)


@pytest.mark.parametrize("entries", [0, 3])
def test_the_table_does_not_change_the_counts(docs, staging, entries):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = T.with_token_counts(staging, docs(rows, n_tokens="n"), entries=entries)
    assert got.columns == ["row", "text", "n_tokens"]
    assert rows_of(got.select("row.doc_id", "n_tokens")) == sorted([(d, length(t)) for d, t in rows], key=repr)
    assert "n_tokens" in got.schema["row"].dataType.names


def test_empty_table(docs, staging):
    assert T.token_counts(staging, docs([])).count() == 0


def test_every_character_is_cut_as_the_library_cuts_it():
    model = PieceModel()
    for c in [*range(1, 0x2F00), 0xFF21, 0xFFFD, 0x10400, 0x1F600]:
        text = f"aB{chr(c)}{chr(c).upper()} x{chr(c)}'s {chr(c)}"
        assert [i for p in pre_tokens(text) for i in model.ids(p)] == LIBRARY.encode(text, add_special_tokens=False).ids, hex(c)
        assert sum(map(model.length, pre_tokens(text))) == length(text)


def test_summaries_keep_what_is_frequent_in_any_order_of_merging():
    parts = [Counter({"hot": 50, **{f"r{i}-{j}": 1 for j in range(90)}}) for i in range(20)]
    total = Counter()
    for p in parts:
        total = T.reduced(total + T.reduced(p, 16), 16)
    assert len(total) <= 16 and total["hot"] > 0
    assert T.unpacked(*T.packed(Counter())) == {} and T.unpacked(*T.packed(Counter({"ñ": 2, "a": 1}))) == {"a": 1, "ñ": 2}


def test_frequent_pre_tokens_cover_all_tasks(docs, staging):
    rows = [(i, f"common thing{i} 'tis") for i in range(60)] + [(99, "y" * 500)]
    got = T.frequent_pre_tokens(staging, docs(rows).repartition(9), 8)
    assert 0 < len(got) <= 8 and "common" in got
    tiers = T.TwoTiers(T.FrequentLengths.of(got, TOKENIZER), PieceModel())
    assert tiers.count("common zebra zebra") == length("common zebra zebra") and set(tiers) == set(got) and "zebra" in tiers.rest


def test_the_cache_has_a_bound(monkeypatch):
    monkeypatch.setattr(T, "CACHED_CHARS", 1000)
    tiers = T.TwoTiers(T.FrequentLengths.of([], TOKENIZER), PieceModel())
    words = [f"w{'x' * (i % 7)}q{'z' * (i // 7)}" for i in range(60)]
    text = " ".join(words + ["y" * 500] + words)
    assert tiers.count(text) == length(text)
    assert tiers.rest.chars <= 1000 + 16 and "y" * 500 not in tiers.rest and not set(tiers)
