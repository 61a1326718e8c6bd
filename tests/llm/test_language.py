import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from hearthlake.llm import kneser_ney, language

SYLLABLES = {"en": "the and ing ion ter ed ha", "de": "der sch ung ich ei zu ü", "fr": "que eau ai ou é ment re"}


def corpus(n, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        word = lambda: "".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 3)))
        rows.append((i, " ".join(word() for _ in range(rng.randint(4, 60))).capitalize() + ".", lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_held_out_accuracy(spark):
    rows = corpus(300)
    got = {r.doc_id: r for r in language.identify(frame(spark, rows)).collect()}
    assert all(got[i].held_out == (crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    right = [got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]
    assert len(right) > 40 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in got.values()) and sum(r.accepted for r in got.values()) > 280


def test_odd_rows(spark):
    rows = corpus(60) + [(900, None, "en"), (901, "", "de"), (902, "123 !?", None), (None, "the and ing", None), (903, "der schung " * 20_000, None)]
    rows += [rows[0], (904, "x", "zz"), (905, "\U00010400\U00010401 ퟿", None)]
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    by_id = {g[0]: g for g in got}
    assert all(by_id[i][1:] == ("und", 0.0) for i in (900, 901, 902))
    assert by_id[None][1] == "en" and by_id[903][1] == "de"
    assert language.identify(frame(spark, [])).count() == 0
    assert {r.lang_pred for r in language.identify(frame(spark, [(1, "abc", None)])).collect()} == {"und"}


def test_other_columns_may_have_any_name(spark):
    rows = corpus(60)
    plain = frame(spark, rows)
    more = plain.selectExpr("*", "'x' score", "'y' lang_pred", "1 held_out", "2 entropy", "3 half", "'g' gram", "4 accepted")
    got = [sorted(map(tuple, language.identify(df).collect())) for df in (plain, more)]
    assert got[0] == got[1]


def test_lang_of_held_out_rows_is_not_looked_at(spark):
    rows = corpus(80)
    turned = [(i, t, "fr" if crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    same = [sorted(map(tuple, language.identify(frame(spark, r)).collect())) for r in (rows, turned)]
    assert same[0] == same[1]


def test_grams_against_brute_force():
    for text in ["Ab, c", "  x", "é!é", "a", "A\n\nb  ", "1a2"]:
        line = "   " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        want = [line[i : i + 4] for i in range(len(line) - 3)]
        got = ["".join(chr(int(g) >> s & 0xFFFF) for s in (48, 32, 16, 0)) for g in language.grams(text)]
        assert got == want, text


def test_a_rare_language_has_a_limit_of_its_own(spark, staging):
    """One language has nearly all documents; of the others one has few texts and one a single one."""
    rng = random.Random(5)
    text = lambda syllables: " ".join("".join(rng.choices(syllables.split(), k=2)) for _ in range(40))
    rows = [(i, text(SYLLABLES["en"]), "en") for i in range(2600)] + [(10_000 + i, text(SYLLABLES["de"]), "de") for i in range(24)]
    rows += [(20_001, text(SYLLABLES["fr"]), "fr")]
    noise = "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=600))
    rows += [(30_000 + i, f"{text(SYLLABLES['de'])} {noise}", None) for i in range(5)]
    known = frame(spark, [r for r in rows if r[2] and crc32(str(r[0]).encode()) % 4 != 2])
    names, models = language.learn(staging, known)
    found = language.limits(known, names, models)
    assert set(found) >= {"de", "en"} and all(np.isfinite(v) for v in found.values())
    got = {r.doc_id: r for r in language.identify(frame(spark, rows)).collect()}
    rare = [got[10_000 + i] for i in range(24)]
    assert all(r.accepted and r.lang_pred == "de" for r in rare) and any(r.held_out for r in rare)
    assert not any(got[30_000 + i].accepted for i in range(5))


def test_symbols_beyond_the_first_plane_are_no_letters(spark):
    emoji = "\U0001f600\U0001f680 \U0001f44d"
    assert len(language.grams(emoji)) == 0 and len(language.grams("\U00010400")) == 3
    assert language.grams(f"{emoji}ab\U0001f600c").tolist() == language.grams("ab c").tolist()
    rows = corpus(60) + [(900, emoji, None), (901, emoji, "de")]
    got = {r.doc_id: r for r in language.identify(frame(spark, rows)).collect()}
    assert all((got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False) for i in (900, 901))


def test_no_gram_is_dropped_whatever_the_size(spark, staging):
    """2.4 million characters of one language, and a word that occurs once."""
    texts = ["der schung " * 220_000, "xyzzy", *[t for _, t, lang in corpus(40) if lang == "de"]]
    rows = [(i, t, "de") for i, t in enumerate(texts)] + [(900, "the ingion ter", "en")]
    names, models = language.learn(staging, frame(spark, rows))
    assert names == ["de", "en"]
    for number, own in enumerate([texts, [rows[-1][1]]]):
        codes, counts = np.unique(np.concatenate([language.grams(t) for t in own]), return_counts=True)
        asked = np.concatenate([codes, language.grams("xyzq theb der")])
        want = kneser_ney.Model.of(codes, counts).logs(asked)
        assert models.logs(asked, [number * language.PARTS])[0] == pytest.approx(want, rel=1e-12)


def test_probabilities_are_those_of_the_formula_and_sum_to_one():
    text = "abracadabra cabra dacabra"
    codes, counts = np.unique(language.grams(text), return_counts=True)
    model = kneser_ney.Model.of(codes, counts)
    grams = {tuple(int(c) >> s & 0xFFFF for s in (48, 32, 16, 0)): int(n) for c, n in zip(codes, counts, strict=True)}

    def tables(order):
        """n-gram counts: of the text, or in how many ways they are continued to the left."""
        own = grams
        for _ in range(4 - order):
            own = Counter(g[1:] for g in own)
        once, twice = (sum(v == k for v in own.values()) for k in (1, 2))
        return own, once / (once + 2 * twice) if once and twice else 0.5

    def p(gram):
        if not gram:
            return 1 / 65536
        own, d = tables(len(gram))
        total = sum(v for g, v in own.items() if g[:-1] == gram[:-1])
        if not total:
            return p(gram[1:])
        kinds = sum(g[:-1] == gram[:-1] for g in own)
        return max(own.get(gram, 0) - d, 0) / total + d * kinds / total * p(gram[1:])

    for query in ["abra", "cabr", "zzzz", "brac", "  ab", "ra x"]:
        code = sum(ord(c) << s for c, s in zip(query, (48, 32, 16, 0), strict=True))
        assert np.exp(model.logs(np.array([code], np.uint64))[0]) == pytest.approx(p(tuple(map(ord, query))), rel=1e-9)
    context = sum(ord(c) << s for c, s in zip("abr", (48, 32, 16), strict=True))
    assert np.exp(model.logs(np.uint64(context) | np.arange(65536, dtype=np.uint64))).sum() == pytest.approx(1, abs=1e-6)
